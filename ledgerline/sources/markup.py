"""Rows of tables that nest: a tokenizer with a state machine, as a table function that is called laterally.

sources.html takes flat tables apart by patterns; these stop at the first inner end tag and at a > within an attribute. Here a
page is read sign by sign into tags and text, and open tables are a stack.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no markup; of the first two it is no text either.
RAW = ("script", "style", "title", "textarea")
#: Elements that do not part the words around them.
INLINE = frozenset("a abbr b bdi bdo big cite code dfn em font i kbd label mark q s samp small span strike strong sub sup tt u var".split())

_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"[^\s=/>]+")
_SPACE = re.compile(r"[\s/]*")
_BARE = re.compile(r"[^\s>]*")
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|([A-Za-z][A-Za-z0-9]*));")

ROW = "table_no int, depth int, inside_table int, inside_row int, inside_cell int, row_no int, cells array<struct<header: boolean, text: string, href: string>>"


def restored(text: str) -> str:
    """Character references restored where they end in a semicolon; others, such as those a cut text ends in or the parameters of a link, stay as written."""
    return _REFERENCE.sub(lambda m: html5.get(f"{m[1]};", m[0]) if m[1] else unescape(m[0]), text)


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from a place within a tag on, the first of each name, and the place after the tag. Quoted values may hold >."""
    found: dict[str, str] = {}
    while True:
        at = _SPACE.match(html, at).end()
        if at >= len(html):
            return found, at
        if html[at] == ">":
            return found, at + 1
        name = _ATTRIBUTE.match(html, at)
        if not name:  # a stray =
            at += 1
            continue
        at = name.end()
        value, after = "", re.compile(r"\s*=\s*").match(html, at)
        if after:
            at = after.end()
            quote = html[at : at + 1]
            if quote in ('"', "'"):
                end = html.find(quote, at + 1)
                end = len(html) if end < 0 else end
                value, at = html[at + 1 : end], end + 1
            else:
                bare = _BARE.match(html, at)
                value, at = bare[0], bare.end()
        found.setdefault(name[0].lower(), restored(value))


def tokens(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, value, attributes): text, or the name of a tag that opens or closes, in lower case. Comments and declarations are skipped."""
    at, raw = 0, ""
    while at < len(html):
        if raw:  # up to the end tag of the element
            end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else len(html)
            if raw in RAW[2:] and stop > at:
                yield "text", restored(html[at:stop]), {}
            at, raw = stop, ""
            continue
        start = html.find("<", at)
        if start < 0:
            yield "text", restored(html[at:]), {}
            return
        if start > at:
            yield "text", restored(html[at:start]), {}
        sign = html[start + 1 : start + 2]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = len(html) if end < 0 else end + 3
        elif sign in ("!", "?"):
            end = html.find(">", start)
            at = len(html) if end < 0 else end + 1
        elif sign.isascii() and sign.isalpha():
            name = _NAME.match(html, start + 1)
            value = name[0].lower()
            found, at = _attributes(html, name.end())
            yield "open", value, found
            raw = value if value in RAW else ""
        elif sign == "/" and html[start + 2 : start + 3].isascii() and html[start + 2 : start + 3].isalpha():
            name = _NAME.match(html, start + 2)
            _, at = _attributes(html, name.end())
            yield "close", name[0].lower(), {}
        else:  # a sign of its own
            yield "text", "<", {}
            at = start + 1


class _Table:
    """An open table: its number, how deep it lies, where in which table, and its row and cell so far."""

    def __init__(self, number: int, depth: int, inside: tuple[int, int, int] | None):
        self.number, self.depth, self.inside = number, depth, inside
        self.row_no, self.row, self.cell = -1, None, None

    def end_cell(self) -> None:
        if self.cell is not None:
            header, parts, href = self.cell
            self.row.append((header, " ".join("".join(parts).replace("\xa0", " ").split()), href))
            self.cell = None

    def end_row(self):
        self.end_cell()
        row, self.row = self.row, None
        return None if row is None else (self.number, self.depth, *(self.inside or (None, None, None)), self.row_no, row)


def rows(html: str | None) -> Iterator[tuple]:
    """Rows of all tables of a page as ROW, each where it ends.

    A cell ends at its end tag, at the next cell or row, or with its table; a row at the next one or with its table; what is
    still open ends with the page. A row without a table is one of a table of its own; a cell without a row begins one. The
    text of a table within a cell is that table's, not the cell's. href is the first link of a cell, its text trimmed with
    all space made one. Tables are numbered as they begin. Null and empty pages have no rows.
    """
    stack: list[_Table] = []
    tables = 0

    def begin() -> None:
        nonlocal tables
        outer = stack[-1] if stack else None
        inside = None
        if outer and outer.cell is not None:
            outer.cell[1].append(" ")
            inside = (outer.number, outer.row_no, len(outer.row))
        stack.append(_Table(tables, len(stack), inside))
        tables += 1

    for kind, value, found in tokens(html or ""):
        top = stack[-1] if stack else None
        if kind == "text":
            if top and top.cell is not None:
                top.cell[1].append(value)
            continue
        if value == "table" and kind == "open":
            begin()
        elif value == "table" and stack:
            done = stack.pop().end_row()
            if done:
                yield done
        elif value == "tr":
            if not stack and kind == "open":
                begin()
            if stack:
                done = stack[-1].end_row()
                if done:
                    yield done
                if kind == "open":
                    stack[-1].row, stack[-1].row_no = [], stack[-1].row_no + 1
        elif value in ("td", "th"):
            if not stack and kind == "open":
                begin()
            if stack:
                own = stack[-1]
                own.end_cell()
                if kind == "open":
                    if own.row is None:
                        own.row, own.row_no = [], own.row_no + 1
                    own.cell = [value == "th", [], None]
        elif top and top.cell is not None:
            if value not in INLINE:
                top.cell[1].append(" ")
            if value == "a" and kind == "open" and top.cell[2] is None:
                top.cell[2] = found.get("href")
    while stack:
        done = stack.pop().end_row()
        if done:
            yield done


class TableRows:
    """rows() as a table function."""

    def eval(self, html: str):
        for number, depth, a, b, c, row_no, cells in rows(html):
            yield number, depth, a, b, c, row_no, [{"header": h, "text": t, "href": x} for h, t, x in cells]


def table_rows(html: Column) -> DataFrame:
    """The table function for a lateral join: the argument is a column of the other side, as F.col(name).outer()."""
    return F.udtf(TableRows, returnType=ROW)(html)


def register(spark) -> None:
    """Makes the function known to SQL: SELECT ... FROM pages, LATERAL table_rows(html)."""
    spark.udtf.register("table_rows", F.udtf(TableRows, returnType=ROW))


def with_rows(pages: DataFrame, html: str) -> DataFrame:
    """A row a table row of each page; the page's other columns stay, the page itself goes. Columns named as those of ROW are replaced."""
    names = [c.split()[0] for c in ROW.split(", ")]
    kept = [c for c in pages.columns if c not in names]
    return pages.select(*kept).lateralJoin(table_rows(F.col(html).outer())).drop(html)


def by_header(pages: DataFrame, html: str, keys: list[str], wanted: list[str]) -> DataFrame:
    """Rows of cells under the wanted headers of their own table, empty where a row is short or the table lacks the header.

    A table's headers are its header cells, row by row, whatever tables lie within or around it. keys name a page.
    """
    own = with_rows(pages.select(*keys, html), html)
    heads = own.filter(F.exists("cells", lambda c: c["header"])).groupBy(*keys, "table_no").agg(F.array_sort(F.collect_list(F.struct("row_no", F.transform(F.filter("cells", lambda c: c["header"]), lambda c: F.lower(c["text"])).alias("h")))).alias("hs"))
    heads = heads.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("table_no").alias("__table_no"), F.flatten(F.transform("hs", lambda x: x["h"])).alias("__heads"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col("table_no") == F.col("__table_no")]
    data = own.withColumn("__texts", F.transform(F.filter("cells", lambda c: ~c["header"]), lambda c: c["text"])).filter(F.size("__texts") > 0)
    joined = data.join(heads, same, "left")
    at = lambda h: F.array_position("__heads", h.lower()).cast("int")
    named = {h: F.when(at(h) > 0, F.coalesce(F.get("__texts", at(h) - 1), F.lit(""))).otherwise("") for h in wanted}
    return joined.withColumns(named).select(*keys, "table_no", "depth", "row_no", *wanted)
