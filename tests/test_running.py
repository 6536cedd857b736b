import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import relational
from ledgerline.operators.running import Before, Max, Sum, parts, running


def rows(seed, n, keys, hot):
    rng = random.Random(seed)
    return [(rng.choice(keys) if rng.random() > hot else keys[0], i, rng.choice([None, rng.randint(-9, 9)]), rng.choice([None, "a", "b"]), rng.random()) for i in rng.sample(range(n * 3), n)]


SCHEMA = "k string, at int, v int, s string, x double"


@pytest.mark.parametrize("seed,keys,hot,number", [(1, ["a", "b", None], 0.3, 5), (2, ["a"], 1.0, 7), (3, [str(i) for i in range(40)] + [None], 0.6, 3), (4, ["a", "b"], 0.9, 1), (5, ["a", "z"], 0.98, 16)])
def test_as_windows(spark, seed, keys, hot, number):
    df = spark.createDataFrame(rows(seed, 400, keys, hot), SCHEMA)
    got = running(df, ["k"], ["at"], {"n": Sum(F.lit(1)), "t": Sum(F.col("v")), "f": Sum(F.col("x"), whole=False), "m": Max(F.col("v")), "b": Before(F.col("s")), "v": Before(F.col("v"))}, number)
    order = Window.partitionBy("k").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("k", "at", "s", "x", F.count("*").over(upto).alias("n"), F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("t"), F.round(F.sum("x").over(upto), 6).alias("f"), F.max("v").over(upto).cast("long").alias("m"), F.lag("s").over(order).alias("b"), F.lag("v").over(order).alias("v"))
    got = got.withColumn("f", F.round("f", 6))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_small_batches_and_no_keys(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows(6, 300, ["a", "b", "c"], 0.5), SCHEMA)
        got = {r.at: (r.n, r.m, r.b) for r in running(df, [], ["at"], {"n": Sum(F.lit(1)), "m": Max(F.col("v")), "b": Before(F.col("at"))}, 6).collect()}
        by_key = running(df, ["k"], ["at"], {"n": Sum(F.lit(1)), "m": Max(F.col("v"))}, 6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    most, before, want = None, None, {}
    for n, r in enumerate(sorted(df.collect(), key=lambda r: r.at), 1):
        most = r.v if most is None else most if r.v is None else max(most, r.v)
        want[r.at] = (n, most, before)
        before = r.at
    assert got == want
    upto = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = {r.at: (r.n, r.m) for r in df.select("at", F.count("*").over(upto).alias("n"), F.max("v").over(upto).alias("m")).collect()}
    assert {r.at: (r.n, r.m) for r in by_key} == want


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = running(df, ["k"], ["at"], {"n": Sum(F.lit(1)), "b": Before(F.col("s"))})
    assert out.columns == ["k", "at", "v", "s", "x", "n", "b"] and out.collect() == []


def test_one_key_is_dealt_over_all_parts(spark):
    df = spark.range(40_000).select(F.lit("one page").alias("k"), "id")
    sizes = sorted(r["count"] for r in parts(df, ["k"], ["id"], 16).groupBy("__part").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]


def test_recipes_over_a_hot_page(spark):
    df = spark.range(3000).select(F.lit(1).alias("page"), "id", (F.col("id") % 7 == 3).alias("main"), F.floor(F.col("id") / 3).alias("key"))
    got = relational.groups_of_followers(df, "page", "id", F.col("main")).collect()
    assert all(r.group_no == (r.id + 4) // 7 for r in got) and len(got) == 3000
    assert sorted(r.id for r in relational.new_pages(df, "page", "id", "key").collect()) == list(range(0, 3000, 3))
