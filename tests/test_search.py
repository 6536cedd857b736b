import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import candidates


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(i, f"T{i % 3}", *[("BLK 7 OAKS", None), ("BLK 7 OAKS", "DOE"), ("OAKS", "ROE")][i % 3], "READY") for i in range(60)]
    rows += [(100, "T0", "O", None, "READY"), (101, "T0", "NOWHERE", None, "READY"), (102, "T0", "OAKS", None, "NO_QUERY_FORMED"), (103, "T0", None, None, "NO_QUERY_FORMED"), (104, "T0", "OAKS", "", "READY")]
    return spark.createDataFrame(rows, "lead_id long, tier string, legal_query string, owner_query string, query_state string")


@pytest.fixture(scope="module")
def properties(spark):
    rows = [(i, ["Lt 1 Blk 7 Oaks", "LT 2 BLK 7 OAKS", "Lt 1 Blk 8 Oaks", None][i % 4], ["Doe Jane", "ROE JOHN", None][i % 3]) for i in range(240)]
    return spark.createDataFrame(rows, "property_id long, legal_text string, owner_name string")


def brute(asked, properties):
    up = lambda x: (x or "").upper()
    own = properties.collect()
    return sorted((q["lead_id"], q["tier"], p["property_id"], p["owner_name"]) for q in asked.collect() if q["query_state"] == "READY" for p in own if q["legal_query"] in up(p["legal_text"]) and (q["owner_query"] is None or q["owner_query"] in up(p["owner_name"])))


@pytest.mark.parametrize("cell", [7, 4096])
def test_what_is_alike_is_met_once_and_no_hit_is_lost(monkeypatch, asked, properties, cell):
    monkeypatch.setattr(candidates, "CELL", cell)
    want = brute(asked, properties)
    met = candidates.meetings(asked, properties)
    assert met.count() < 40 < len(want)
    got = candidates.hits(asked, properties, met).select("lead_id", "tier", "property_id", "owner_name").collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_outcomes_and_first_hits_are_those_of_all_hits(asked, properties):
    want = brute(asked, properties)
    met = candidates.meetings(asked, properties)
    out = {(r["lead_id"], r["tier"]): (r["n"], r["owner_name"]) for r in candidates.outcomes(asked, met).collect()}
    first = sorted(map(tuple, candidates.first_hits(asked, properties, met, 5).collect()))
    assert len(out) == asked.count()
    for lead, tier in out:
        own = [(p, o) for a, b, p, o in want if (a, b) == (lead, tier)]
        assert out[lead, tier] == (len(own), min((o for _, o in own if o), default=None))
        assert [p for a, b, p in first if (a, b) == (lead, tier)] == sorted(p for p, _ in own)[:5]


def test_properties_are_not_broadcast(spark, asked):
    many = spark.range(20000).select(F.col("id").alias("property_id"), F.format_string("LT %d BLK 7 OAKS", "id").alias("legal_text"), F.format_string("OWNER %d", "id").alias("owner_name"))
    found = candidates.search(asked, many)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"BroadcastHashJoin \[(?:property_id|legal|__legal|gram)#", plan)
    assert found.count() == 22 * 20000


def test_customers_of_searches_are_not_broadcast(spark):
    from ledgerline.plans.registry import queries

    found = queries()["tier_fallback"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[o_custkey#", plan) and not re.search(r"BroadcastHashJoin \[o_custkey#", plan)


def test_searches_go_by_number_and_leads_are_gathered_before_they_are_dealt(asked, properties):
    found = candidates.hits(asked, properties, candidates.meetings(asked, properties))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    cell = next(x for x in plan.split("\n") if "Join Inner" in x and "__asks" not in x and "__j" in x)
    assert "__f_s" in cell and "legal_query" not in cell and "owner_query" not in cell
    assert plan.index("explode(sequence(0, (__js") < plan.index("collect_list")
