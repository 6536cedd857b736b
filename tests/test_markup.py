from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.sources import markup


class Plain(HTMLParser):
    """Cells of well formed tables by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.stack, self.out, self.n = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            top = self.stack[-1] if self.stack else None
            if top:
                top["text"][1] += " "
            self.stack.append({"no": self.n, "in": (top["no"], top["row"], len(top["cells"])) if top else (None,) * 3, "row": -1, "cells": None, "text": None})
            self.n += 1
        elif tag == "tr":
            self.stack[-1]["row"] += 1
            self.stack[-1]["cells"] = []
        elif tag in ("td", "th"):
            self.stack[-1]["text"] = [tag == "th", "", None]
        elif self.stack and self.stack[-1]["text"]:
            if tag not in markup.INLINE:
                self.stack[-1]["text"][1] += " "
            if tag == "a" and self.stack[-1]["text"][2] is None:
                self.stack[-1]["text"][2] = dict(attrs).get("href") if dict(attrs).get("href") is not None or "href" not in dict(attrs) else ""

    def handle_endtag(self, tag):
        top = self.stack[-1] if self.stack else None
        if tag == "table":
            self.stack.pop()
        elif tag == "tr":
            self.out.append((top["no"], len(self.stack) - 1, *top["in"], top["row"], top["cells"]))
            top["cells"] = None
        elif tag in ("td", "th"):
            h, t, x = top["text"]
            top["cells"].append((h, " ".join(t.replace("\xa0", " ").split()), x))
            top["text"] = None
        elif top and top["text"] and tag not in markup.INLINE:
            top["text"][1] += " "

    def handle_data(self, data):
        if self.stack and self.stack[-1]["text"] and self.cdata_elem is None:
            self.stack[-1]["text"][1] += data


def plain(html):
    p = Plain()
    p.feed(html)
    p.close()
    return p.out


words = st.text(alphabet="ab &;\n'\"=/é", max_size=6).map(lambda s: s.replace("&", "&amp;"))
quoted = st.text(alphabet="ab <>=/'", max_size=6).map(lambda s: f'"{s}"')
inner = st.one_of(words, st.builds(lambda v, t: f"<a href={v}>{t}</a>", quoted, words), st.builds(lambda t: f"<b>{t}</b>", words), st.builds(lambda v, t: f"<p title={v}>{t}</p>", quoted, words), st.just("<br>"), st.just("<!-- <td> -->"), st.just("<script>if (a < b) '<td>'</script>"))
tables = st.recursive(
    st.just(""),
    lambda below: st.lists(st.lists(st.tuples(st.sampled_from(["td", "th"]), quoted, st.lists(inner, max_size=3).map("".join), below), max_size=3), max_size=3).map(
        lambda trs: "<table>" + "".join("<tr>" + "".join(f"<{n} title={v}>{t}{b}</{n}>" for n, v, t, b in tr) + "</tr>" for tr in trs) + "</table>"
    ),
    max_leaves=6,
)


@settings(max_examples=300, deadline=None)
@given(tables)
def test_well_formed_tables_as_the_standard_parser(html):
    assert [r for r in sorted(markup.rows(html), key=lambda r: (r[0], r[5]))] == sorted(plain(html), key=lambda r: (r[0], r[5]))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/=\"' !-atbdrhe&;", max_size=60))
def test_any_text_ends(html):
    for r in markup.rows(html):
        assert len(r) == 7


def texts(html):
    return [[c[1] for c in r[6]] for r in sorted(markup.rows(html), key=lambda r: (r[0], r[5]))]


@pytest.mark.parametrize("html,want", [
    ("<table><tr><td>1<td>2<tr><td>3", [["1", "2"], ["3"]]),
    ("<tr><td>no table</td></tr>", [["no table"]]),
    ("<td>no row<td>either", [["no row", "either"]]),
    ("<table><tr><td>a<table><tr><td>in</table>b<td>c</table>", [["a b", "c"], ["in"]]),
    ("<table><tr><td title='x > y' data-a=\"</td>\">z</td></tr></table>", [["z"]]),
    ("<table><tr><td>x < y &lt;td&gt; &nbsp;&amp;amp;</td></tr></table>", [["x < y <td> &amp;"]]),
    ("<TABLE><TR><TH>A</TH><TD>bo<B>ld</B>er<br>x</TD></TR></TABLE>", [["A", "bolder x"]]),
    ("<table></table><table><tr></tr><tr><td></td></tr></table>", [[], [""]]),
    ("<table><tr><td>cut off <a href='x", [["cut off"]]),
    ("text </td></tr></table> more", []), ("", []), (None, []),
])
def test_tables_as_they_come(html, want):
    assert texts(html) == want


def test_lateral_join_and_sql(spark):
    pages = spark.createDataFrame([(1, "<table><tr><th>Case<th>Party</tr><tr><td>7<td><table><tr><th>Party<tr><td>inner</table>P</table>", "x"), (2, None, "y"), (3, "no rows", "z")], "id int, html string, depth string")
    got = {(r.id, r.table_no, r.row_no): (r.depth, r.inside_table, r.inside_row, r.inside_cell, [c.text for c in r.cells]) for r in markup.with_rows(pages, "html").collect()}
    assert got == {(1, 0, 0): (0, None, None, None, ["Case", "Party"]), (1, 0, 1): (0, None, None, None, ["7", "P"]), (1, 1, 0): (1, 0, 1, 1, ["Party"]), (1, 1, 1): (1, 0, 1, 1, ["inner"])}
    markup.register(spark)
    pages.createOrReplaceTempView("some_pages")
    assert spark.sql("SELECT id, t.row_no FROM some_pages, LATERAL table_rows(html) t").count() == 4
    heads = {(r.table_no, r.row_no): (r.Party, r.Other) for r in markup.by_header(pages, "html", ["id"], ["Party", "Other"]).collect()}
    assert heads == {(0, 1): ("P", ""), (1, 1): ("inner", "")}


def test_a_long_page_is_read_once(spark):
    html = "<table>" + "<tr><td>x</td><td><i>y</i></td></tr>" * 20000 + "</table>"
    assert markup.with_rows(spark.createDataFrame([(html,)], "html string"), "html").agg(F.count("*")).first()[0] == 20000


def test_only_references_that_end_in_a_semicolon_are_restored():
    page = '<table><tr><td>a&amp b &amp; c &copy d&notit; &notin; &#65 &#65;&#x42;&amp<td><a href="?a=1&copy=2&amp;b=3&lt=4">x</a></table>'
    (row,) = markup.rows(page)
    assert [(text, href) for _, text, href in row[-1]] == [("a&amp b & c &copy d&notit; ∉ &#65 AB&amp", None), ("x", "?a=1&copy=2&b=3&lt=4")]
