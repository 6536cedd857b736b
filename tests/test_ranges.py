import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import ranges

DAY = datetime.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY + datetime.timedelta(n)


def brute(days, first, last, most, level=0):
    n = sum(1 for d in days if d is not None and first <= d <= last)
    if n <= most or first == last:
        return [(first, last, n, level)]
    middle = first + (last - first) // 2
    return brute(days, first, middle, most, level + 1) + brute(days, middle + 1, last, most, level + 1)


@pytest.mark.parametrize("seed,most", [(1, 5), (2, 1), (3, 0)])
def test_as_a_search_that_splits(spark, seed, most):
    rng = random.Random(seed)
    rows = [("a", rng.randint(0, 90)) for _ in range(120)] + [("b", 7)] * 40 + [("b", None), (None, 3), (None, 80), ("c", None)]
    df = spark.createDataFrame([(k, day(d), 1, 2) for k, d in rows], "k string, d date, n int, level int")
    got = sorted(((r.k or "", (r["first"] - DAY).days, (r["last"] - DAY).days, r.n, r.level) for r in ranges.split(df, "d", ["k"], most=most).collect()))
    want = []
    for k in ("a", "b", None):
        days = [d for x, d in rows if x == k and d is not None]
        want += [(k or "", *r) for r in brute(days, min(days), max(days), most)]
    assert got == sorted(want)


def test_given_bounds_cover_every_day_once(spark):
    df = spark.createDataFrame([("a", day(d % 50)) for d in range(500)], "k string, d date")
    whole = spark.createDataFrame([("a", day(-30), day(45)), ("z", day(0), day(9))], "k string, first date, last date")
    found = ranges.split(df, "d", ["k"], whole, 20)
    days = found.select("k", F.explode(F.sequence("first", "last")).alias("d"))
    assert days.count() == days.distinct().count() == 76 + 10
    assert found.filter("n > 20 and first < last").isEmpty() and found.agg(F.sum("n")).first()[0] == 460


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(day(d),) for d in range(9)], "d date")
    assert sorted((r["first"] - DAY).days for r in ranges.split(df, "d", [], most=3).collect()) == [0, 3, 5, 7]
    assert ranges.split(df.filter("false"), "d", [], most=3).collect() == []
    none = spark.createDataFrame([], "k string, d date")
    assert ranges.split(none, "d", ["k"]).collect() == []
