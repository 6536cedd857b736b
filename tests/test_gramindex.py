import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import gramindex
from ledgerline.plans import derive


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["LT", "BLK", "SEC", "TEST ACRES", "SAMPLE OAKS", "é😀x"]) + " " + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 4)))) for i in range(300)]
    return rows + [(1000, "A"), (1001, "AB"), (1002, None), (1003, ""), (1004, "LT LT LT LT"), (1005, "50%_x")]


@pytest.fixture(scope="module")
def index(spark, texts):
    out = gramindex.scratch(spark.createDataFrame(texts, "id int, text string"), "id", "text", buckets=3, part=40)
    yield out
    gramindex.drop(spark, out)


QUERIES = ["LT 1", "TEST ACRES 2", "BLK", "L", "AB", "A", " ", "é😀x", "nowhere", "LT LT", "%", "50%_", "", None, "LT 1", "EST ACRES 12 LT"]


@pytest.mark.parametrize("rarest", [1, 2, 3])
def test_as_a_scan_with_contains(spark, texts, index, rarest):
    asked = spark.createDataFrame([(q,) for q in QUERIES], "query string")
    got = sorted((r["query"], r.id) for r in gramindex.search(index, asked, rarest).collect())
    assert got == sorted((q, i) for q in {q for q in QUERIES if q} for i, t in texts if t and q in t)


def test_more_stretches_leave_fewer_candidates(spark, index):
    asked = spark.createDataFrame([("TEST ACRES 12",), ("LT 30 BLK 1",)], "query string")
    one, three = (gramindex.candidates(index, asked, k).count() for k in (1, 3))
    assert gramindex.search(index, asked).count() <= three < one


def test_the_index_is_not_moved(spark, index):
    asked = spark.createDataFrame([("TEST ACRES",), ("LT",)], "query string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = gramindex.candidates(index, asked)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    scans = [k for k, line in enumerate(lines) if f"{index.postings}[" in line]
    assert len(scans) == 2 and all("Bucketed: true" in lines[k] for k in scans)
    for k in scans:  # read, filtered, sorted, joined: nothing else stands between
        assert [line.split(")", 1)[-1].split()[0] for line in lines[k - 3 : k]] == ["Sort", "Filter", "ColumnarToRow"], plan


def test_large_stretches_are_dealt(spark, index):
    counts = spark.table(index.counts)
    assert counts.filter("parts > 1").count() > 3 and counts.filter("parts <> ceil(n / 40)").isEmpty()
    assert spark.table(index.postings).groupBy("gram", "part").count().agg(F.max("count")).first()[0] < 80


def test_no_texts(spark):
    out = gramindex.scratch(spark.createDataFrame([], "id int, text string"), "id", "text", buckets=2)
    assert gramindex.search(out, spark.createDataFrame([("abc",), ("a",)], "query string")).collect() == []


def test_what_is_kept_goes_with_its_files(spark, tmp_path):
    made = []
    build = lambda: made.append(1) or len(made)
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    assert [derive.once(spark, str(tmp_path), "x", build) for _ in range(2)] == [1, 1]
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "a.parquet"))
    assert derive.once(spark, str(tmp_path), "x", build) == 2
