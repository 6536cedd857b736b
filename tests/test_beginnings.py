import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import beginnings, relational

TERMS = ["", None, "a", "ab", "abc", "ab", "é", "ée", "😀", "b", "ba x", "zz", "￿", "a\x00"]


def names(seed, n=600):
    rng = random.Random(seed)
    out = ["".join(rng.choice("abcé😀 x\x00￿") for _ in range(rng.randint(0, 5))) for _ in range(n)]
    return [(i, t) for i, t in enumerate([*out, None, "", *["ab c"] * 200])]


@pytest.mark.parametrize("seed,number", [(1, 1), (2, 4), (3, 9)])
def test_as_a_test_of_all_pairs(spark, seed, number):
    rows = names(seed)
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "id int, name string, __asks string").withColumnRenamed("__asks", "more")
    got = sorted((r.term, r.id) for r in beginnings.matches(spark.createDataFrame([(t,) for t in TERMS], "term string"), df, "term", "name", number).collect())
    assert got == sorted((t, i) for t in {t for t in TERMS if t} for i, n in rows if n is not None and n.startswith(t))


def test_repeated_rows_and_empty_sides(spark):
    rows = spark.createDataFrame([("ann",), ("ann",), ("bo",)], "name string")
    terms = spark.createDataFrame([("an",), ("an",)], "term string")
    assert [r.name for r in beginnings.matches(terms, rows, "term", "name").collect()] == ["ann", "ann"]
    assert beginnings.matches(terms.filter("false"), rows, "term", "name").collect() == []
    assert beginnings.matches(terms, rows.filter("false"), "term", "name").collect() == []


def test_rows_are_dealt_once_and_evenly(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "DOE JOHN").otherwise(F.concat(F.lit("N"), F.sha2(F.col("id").cast("string"), 256))).alias("name"), "id").withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(beginnings.SALTS)).cast("int"))
    terms = spark.createDataFrame([("DOE",), ("NA",), ("N",)], "term string")
    asked, dealt = beginnings._dealt(terms, rows, "term", "name", 12)
    sizes = sorted(r["count"] for r in dealt.groupBy("__range").count().collect())
    assert sum(sizes) == 20_000 and len(sizes) == 12 and sizes[-1] <= 3 * sizes[6]
    assert asked.count() <= 3 * 12


def test_different_names_are_searched_not_deeds(spark, monkeypatch):
    seen = []
    matches = relational.beginnings.matches
    monkeypatch.setattr(relational.beginnings, "matches", lambda leads, rows, term, name: seen.append(rows.count()) or matches(leads, rows, term, name))
    leads = spark.sql("SELECT id AS filing, element_at(array('DOE', 'DOE J', ''), int(id % 3) + 1) AS term, date'2024-06-01' AS filed FROM range(9)")
    deeds = spark.sql("SELECT id AS no, element_at(array('DOE JANE', 'ROE ANN', NULL, 'DOE'), int(id % 4) + 1) AS name, date_add(date'2022-06-01', int(id) * 30) AS at FROM range(80)")
    got = sorted(map(tuple, relational.near_dates(leads, deeds, "term", "name", "filed", "at").select("filing", "no").collect()))
    want = sorted((q["filing"], d["no"]) for q in leads.collect() for d in deeds.collect() if q["term"] and d["name"] and d["name"].startswith(q["term"]) and abs((d["at"] - q["filed"]).days) <= 365)
    assert got == want and seen == [4]


@pytest.mark.parametrize("cell,days", [(4096, 365), (7, 365), (3, 2), (1, 0)])
def test_a_deed_meets_rows_of_leads_and_its_results_lie_together(spark, monkeypatch, cell, days):
    monkeypatch.setattr(relational, "CELL", cell, raising=False)
    leads = spark.sql("SELECT id AS filing, element_at(array('DOE', 'DOE J', '', NULL), int(id % 4) + 1) AS term, CASE WHEN id % 9 < 8 THEN date_add(date'1969-06-01', int(id * 37 % 800)) END AS filed FROM range(80)")
    deeds = spark.sql("SELECT id AS no, element_at(array('DOE JANE', 'ROE ANN', NULL, 'DOE'), int(id % 4) + 1) AS name, CASE WHEN id % 11 < 10 THEN date_add(date'1968-06-06', int(id) * 10) END AS at FROM range(160)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    rows = list(map(tuple, relational.near_dates(leads, deeds, "term", "name", "filed", "at", days).select("filing", "no", "term", "at").collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [(q["filing"], d["no"], q["term"], d["at"]) for q in leads.collect() for d in deeds.collect() if q["term"] and q["filed"] and d["name"] and d["at"] and d["name"].startswith(q["term"]) and abs((d["at"] - q["filed"]).days) <= days]
    assert sorted(rows) == sorted(want) and want
    if cell > 80:
        assert sum(a[1:3] != b[1:3] for a, b in zip(rows, rows[1:])) + 1 == len({r[1:3] for r in rows})
