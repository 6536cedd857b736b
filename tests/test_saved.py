import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual, StringContains

from ledgerline.operators import relational
from ledgerline.sources import saved

DAY = datetime.date(2021, 3, 1)


def day(n):
    return DAY + datetime.timedelta(n)


def page(cells):
    """cells: (case, day or text) rows."""
    rows = "".join(f"<tr><td>{c}<td>{d.strftime('%m/%d/%Y') if isinstance(d, datetime.date) else d}" for c, d in cells)
    return f"<table><tr><th>Case<th>Filed{rows}</table>"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("saved") / "scans")
    rows = []
    for k in range(12):  # ten days a scan, three pages, the last one again
        pages = [page([(f"{k}-{p}-{i}", day(10 * k + (3 * p + i) % 10)) for i in range(4)]) for p in range(3)]
        rows += [("court/a" if k % 2 else None, day(10 * k), day(10 * k + 9), n, h) for n, h in enumerate([*pages, pages[-1], page([("never", day(10 * k))])], 1)]
    saved.write(spark.createDataFrame(rows, "court string, first date, last date, page int, html string"), path, ("court",))
    saved.register(spark)
    return path


def reader(spark, path, **more):
    out = spark.read.format("saved_pages").option("columns", "Case,Filed,Missing").option("date", "filed").option("keys", "court")
    return out.options(**more).load(path)


def test_rows_and_stop(spark, folder):
    rows = reader(spark, folder).collect()
    assert len(rows) == 12 * 12 and not any(r.Case == "never" for r in rows)
    one = [r for r in rows if r.Case == "3-1-2"][0]
    assert (one.court, one["first"], one["last"], one.page, one.row_no, one.day, one.Filed, one.Missing) == ("court/a", day(30), day(39), 2, 3, day(35), "04/05/2021", "")
    assert {r.court for r in rows} == {None, "court/a"}
    assert reader(spark, folder, pages=2).count() == 12 * 8


def test_a_filter_on_dates_reads_fewer_partitions(spark, folder):
    whole = reader(spark, folder, bytes=0)
    assert whole.rdd.getNumPartitions() == 12
    for test, few in ((F.col("day") == day(35), 1), (F.col("day").between(day(38), day(41)), 2), (F.col("day") > day(200), 1), (F.col("day").isin(day(5), day(25)), 3)):
        some = whole.filter(test)
        assert some.rdd.getNumPartitions() == few
        unpushed = spark.createDataFrame(whole.collect(), whole.schema).filter(test)
        assert sorted(map(str, some.collect())) == sorted(map(str, unpushed.collect())) and some.count()


def test_all_filters_are_tested_again():
    r = saved.SavedReader("x", [], [], "Filed", 20, 2, 0)
    filters = [EqualTo(("case",), "1"), GreaterThan(("day",), day(3)), LessThanOrEqual(("day",), day(9)), In(("day",), (day(5), day(7))), IsNotNull(("day",)), StringContains(("case",), "x")]
    assert list(r.pushFilters(filters)) == filters
    assert (r.least, r.greatest) == (day(5), day(7))


def test_stop_rules_as_over_a_table(spark):
    rng = random.Random(4)
    rows, want = [], []
    for scan in range(60):
        keys = [rng.choice([None, None, "a", "b", "c", "d"]) for _ in range(12)]
        rows += [(scan, n, k, 0 if k is None else 2) for n, k in enumerate(keys)]
        pages = [(n, page([] if k is None else [(k, day(1)), (f"{n}", "bad date")])) for n, k in enumerate(keys)]
        got = list(saved.records(iter(pages), ["Case"], "Filed", 9, 2))
        want += [(scan, n) for n in dict.fromkeys(g[0] for g in got)]
        assert all((g[2] == day(1)) == (g[1] == 1) for g in got)
    table = spark.createDataFrame(rows, "scan int, page int, first_key string, n int")
    found = relational.pages_read(table, "scan", "page", "first_key", "n", 2, 9).filter("n > 0")
    assert sorted((r.scan, r.page) for r in found.collect()) == sorted(want)


def test_empty_folder_and_no_pages(spark, tmp_path):
    saved.register(spark)
    assert reader(spark, str(tmp_path)).collect() == []
    empty = spark.createDataFrame([], "court string, first date, last date, page int, html string")
    saved.write(empty, str(tmp_path / "none"), ("court",))
    assert reader(spark, str(tmp_path / "none")).collect() == []
