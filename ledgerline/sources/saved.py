"""Saved pages of scans as a data source: partitions by range of dates, date filters pushed down, stop rules in the reader.

A scan is the search of one range of dates; its pages are saved in order, in a folder for each range. Reading goes as a scan
went: page by page, until one begins like the page before, so many in a row are empty, or the most that a scan may have are
read. A filter on the date of records leaves out the ranges that it cannot meet before any file is opened.

    saved.register(spark)
    spark.read.format("saved_pages").option("columns", "Case,Party").option("date", "Filed").load(path)
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from . import markup

#: Pages of a scan at most, and empty pages in a row that end it.
PAGES, EMPTY = 20, 2
#: Bytes of files that one partition reads, but for one scan that has more.
BYTES = 16 << 20
# Fixed value: how the date of a record is written.
FORM = "%m/%d/%Y"


def write(pages: DataFrame, path: str, keys: tuple[str, ...] = ()) -> None:
    """Save pages (keys, first, last, page, html): a folder for each key's range, its pages in order in one file."""
    at = [*keys, "first", "last"]
    pages.select(*at, "page", "html").repartition(*at).sortWithinPartitions(*at, "page").write.partitionBy(*at).parquet(path)


@dataclass(frozen=True)
class Scan:
    """A range's folder: its dates, its keys as written, its files."""

    first: datetime.date
    last: datetime.date
    keys: tuple[tuple[str, str | None], ...]
    files: tuple[str, ...]


@dataclass
class Scans(InputPartition):
    scans: tuple[Scan, ...]


def scans(path: str) -> list[tuple[Scan, int]]:
    """The scans below a path, in order of their first days, and their bytes. Any store that pyarrow opens will do."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    held: dict = {}
    for f in store.get_file_info(fs.FileSelector(root, recursive=True)):
        if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")):
            parts = [p.split("=", 1) for p in f.path[len(root) :].strip("/").split("/")[:-1]]
            held.setdefault(tuple((k, None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v)) for k, v in parts), []).append(f)
    out = []
    for parts, found in held.items():
        named = dict(parts)
        keys = tuple(x for x in parts if x[0] not in ("first", "last"))
        own = Scan(datetime.date.fromisoformat(named["first"]), datetime.date.fromisoformat(named["last"]), keys, tuple(sorted(f.path for f in found)))
        out.append((own, sum(f.size for f in found)))
    return sorted(out, key=lambda x: (x[0].first, x[0].last, str(x[0].keys)))


def records(pages: Iterator[tuple[int, str | None]], columns: list[str], date: str, most: int, empty: int) -> Iterator[tuple]:
    """(page, row_no, day, cells under the columns) of the records that a scan reads before it stops. pages: (page, html), in order.

    A page's records are the rows of its tables that have data cells; what stands under a column goes by its own table's
    headers, empty where a row is short or the table lacks it. A date that cannot be read is null. A page that begins like
    the one before, by the first cell of its first record, is not read; an empty page gives nothing.
    """
    before, none = None, 0
    for nth, (page, html) in enumerate(pages):
        if nth == most or none == empty:
            return
        heads: dict[int, list[str]] = {}
        rows = []
        for table, *_, row_no, cells in sorted(markup.rows(html), key=lambda r: (r[0], r[5])):
            heads.setdefault(table, []).extend(t.lower() for header, t, _ in cells if header)
            texts = [t for header, t, _ in cells if not header]
            if texts:
                at = {h: texts[i] if i < len(texts) else "" for i, h in reversed(list(enumerate(heads[table])))}
                rows.append((row_no, texts[0], at))
        first = rows[0][1] if rows else None
        if rows and first == before:
            return
        before, none = first, 0 if rows else none + 1
        for row_no, _, at in rows:
            try:
                day = datetime.datetime.strptime(at.get(date.lower(), ""), FORM).date()
            except ValueError:
                day = None
            yield page, row_no, day, [at.get(c.lower(), "") for c in columns]


class SavedPages(DataSource):
    """Options: path; columns (headers, comma-separated); date (the header of a record's date); keys (key folders, comma-separated); pages, empty (stop rules); bytes."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def _names(self, option: str) -> list[str]:
        return [x.strip() for x in self.options.get(option, "").split(",") if x.strip()]

    def schema(self) -> str:
        fields = [*[f"`{k}` string" for k in self._names("keys")], "first date", "last date", "page int", "row_no int", "day date", *[f"`{c}` string" for c in self._names("columns")]]
        return ", ".join(fields)

    def reader(self, schema: StructType) -> SavedReader:
        get = lambda k, d: int(self.options.get(k, d))
        return SavedReader(self.options["path"], self._names("columns"), self._names("keys"), self.options.get("date", "Date"), get("pages", PAGES), get("empty", EMPTY), get("bytes", BYTES))


def register(spark) -> None:
    """Makes the source known to a session, and has that session push filters to sources written in Python."""
    spark.dataSource.register(SavedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


class SavedReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], keys: list[str], date: str, most: int, empty: int, size: int):
        self.path, self.columns, self.keys, self.date, self.most, self.empty, self.size = path, columns, keys, date, most, empty, size
        self.least: datetime.date | None = None
        self.greatest: datetime.date | None = None

    def pushFilters(self, filters):
        """Dates that records must lie between are noted, for partitions(); Spark goes on to test every row, as a range is wider than a filter."""
        for f in filters:
            if getattr(f, "attribute", None) == ("day",) and not isinstance(f, IsNotNull):
                low = high = None
                if isinstance(f, (EqualTo, EqualNullSafe)):
                    low = high = f.value
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    low = f.value
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    high = f.value
                elif isinstance(f, In) and all(v is not None for v in f.value) and f.value:
                    low, high = min(f.value), max(f.value)
                if low is not None:
                    self.least = max(self.least, low) if self.least else low
                if high is not None:
                    self.greatest = min(self.greatest, high) if self.greatest else high
            yield f

    def partitions(self) -> list[Scans]:
        """Scans whose ranges can hold records of the dates asked for, in order of date, put together up to the bytes of a partition."""
        out: list[Scans] = []
        held, size = [], 0
        for scan, n in scans(self.path):
            if (self.least and scan.last < self.least) or (self.greatest and scan.first > self.greatest):
                continue
            if held and size + n > self.size:
                out.append(Scans(tuple(held)))
                held, size = [], 0
            held.append(scan)
            size += n
        return [*out, Scans(tuple(held))] if held else out or [Scans(())]

    def read(self, partition: Scans):
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(self.path)

        def pages(scan: Scan):
            """Pages of a scan's files; as a file has them in order, the next one is the least that any of the files has next."""
            from heapq import merge

            def of(name):
                with store.open_input_file(name) as f:
                    for b in pq.ParquetFile(f).iter_batches(64, columns=["page", "html"]):
                        yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist())

            return merge(*map(of, scan.files), key=lambda p: p[0])

        for scan in partition.scans:
            own = dict(scan.keys)
            for page, row_no, day, cells in records(pages(scan), self.columns, self.date, self.most, self.empty):
                yield (*[own.get(k) for k in self.keys], scan.first, scan.last, page, row_no, day, *cells)


def pages_of(rows: DataFrame, at: list[str], order: str, columns: dict[str, str], size: int = 20, most: int = PAGES) -> DataFrame:
    """Pages (at, page, html) of so many rows each, a table with headers; columns: header -> column of text, trusted to hold no markup.

    After the last page of a range the same page comes once more, as a site does that ignores a page number that is too
    high. Of a range no more rows are laid out than a scan reads.
    """
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(*at).orderBy(order))
    some = rows.withColumn("__nth", nth).filter(F.col("__nth") <= size * (most + 1)).withColumn("page", F.floor((F.col("__nth") - 1) / size).cast("int") + 1)
    cell = F.concat(*[F.concat(F.lit("<td>"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns.values()])
    lines = F.transform(F.array_sort(F.collect_list(F.struct("__nth", cell.alias("c")))), lambda x: F.concat(F.lit("<tr>"), x["c"]))
    head = F.lit("<table><tr>" + "".join(f"<th>{h}" for h in columns))
    pages = some.groupBy(*at, "page").agg(F.concat(head, F.array_join(lines, ""), F.lit("</table>")).alias("html"))
    last = pages.groupBy(*at).agg(F.max(F.struct("page", "html")).alias("l")).select(*at, (F.col("l.page") + 1).alias("page"), "l.html")
    return pages.unionByName(last)
