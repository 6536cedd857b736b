import os

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import legal
from ledgerline.operators import candidates, linkage, owners, quality, relational, rules, staging
from ledgerline.plans import registry
from ledgerline.sources import files, html

C = F.col
SF = "/root/testdata/sf0.001"


def test_contract():
    assert len(schemas.STAGED) == len(set(schemas.STAGED)) == 114 and len(set(schemas.DETAIL)) == 32
    assert schemas.STAGED[:2] == ["account_status_text", "account_to_search"] and schemas.STAGED[-1] == "total_current_taxes_due"


def test_failures_are_recorded(spark):
    raw = [("{broken",), ('{"probate_lead_case_number":""}',), ('{"probate_lead_case_number":"1","hcad_bedrooms":"x","statement_date":"2025-13-01","hcad_garage_sqft":"2"}',), ('{"probate_lead_case_number":"2"}',), (None,)]
    got = [r["parsing_error"] for r in staging.failures(spark.createDataFrame(raw, "RAW_RECORD string").coalesce(1)).collect()]
    assert got == ["not JSON", "no case number", "hcad_bedrooms,statement_date", None, "not JSON"]


def test_tiers_of_names(spark):
    leads = spark.createDataFrame([(1, "DOE JR.", "BOB Q"), (2, "Lee", "Bob"), (3, "ZEBRA", "NOBODY"), (4, "SMITH", "NOBODY"), (5, "DOE  V", "JOHN")], "lead_id int, last string, first string")
    parties = spark.createDataFrame([("DOE", "BOBBY"), ("LEE", "ROBERT"), ("LEE", "ROB"), ("LEE", "ROBBIE"), ("LEE", "ROBBY"), ("ZEBRAS", "ANN"), ("SMITH", "ANN"), ("DOE", "JOHN Q")], "party_last string, party_first string")
    got = sorted((r["lead_id"], r["search_term"], r["tier"], r["party_last"], r["party_first"]) for r in relational.tiered_names(leads, parties, last_names=True).collect())
    assert got == [
        (1, "DOE BOB", "TIER_1_EXACT_STD", "DOE", "BOBBY"),
        (2, "LEE ROB", "TIER_2_NICK_ROB", "LEE", "ROB"), (2, "LEE ROB", "TIER_2_NICK_ROB", "LEE", "ROBBIE"), (2, "LEE ROB", "TIER_2_NICK_ROB", "LEE", "ROBBY"), (2, "LEE ROB", "TIER_2_NICK_ROB", "LEE", "ROBERT"),
        (2, "LEE ROBBIE", "TIER_2_NICK_ROBBIE", "LEE", "ROBBIE"),
        (3, "ZEBRA", "TIER_3_RARE_LN_ONLY", "ZEBRAS", "ANN"),
        (5, "DOE JOHN", "TIER_1_EXACT_STD", "DOE", "JOHN Q"),
    ]


def test_pages_read_until_a_scan_stops(spark):
    scans = {1: "aabb", 2: "ab--cd", 3: "ab-c--d", 4: "abcdefg", 5: "--a", 6: "a-a"}
    rows = [(s, p, None if c == "-" else c, 0 if c == "-" else 3) for s, text in scans.items() for p, c in enumerate(text)]
    kept = relational.pages_read(spark.createDataFrame(rows, "scan int, page int, k string, n int"), "scan", "page", "k", "n", 2, 5)
    got = {s: "" for s in scans}
    for r in kept.orderBy("scan", "page").collect():
        got[r["scan"]] += r["k"] or "-"
    assert got == {1: "a", 2: "ab--", 3: "ab-c-", 4: "abcde", 5: "--", 6: "a-a"}


def test_a_twin_tells_a_broken_operator(spark, monkeypatch):
    """Each is broken on purpose; its twin, which shares nothing with it, then gives other rows."""
    import duckdb
    from ledgerline.functions import names

    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "part"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    breaks = {
        "cleaned_names": (names, "SEARCH_SUFFIX", "(?U) (JR|SR)$"),
        "tiered_name_search": (names, "NICKNAMES", {"JOHN": ["JACK"]}),
        "caption_names": (names, "CAPTION_FILLERS", ["BO"]),
        "owner_scores": (names, "NOT_SURNAMES", ["JR"]),
    }
    for name, (module, what, value) in breaks.items():
        want = sorted(map(str, con.sql(registry.oracle_sql()[name]).fetchall()))
        with monkeypatch.context() as m:
            m.setattr(module, what, value)
            rel = con.sql(registry.oracle_sql()[name]).columns
            assert sorted(str(tuple(r)) for r in registry.queries()[name](spark, SF).select(*rel).collect()) != want, name


def lead(spark, **own):
    names = ["hcad_site_address", "hctax_owner_mailing_address", *rules_columns()]
    row = {n: None for n in names} | own
    kinds = {"probate_lead_filing_date": "date", **{c: "decimal(38,0)" for c in ("hcad_land_market_value", "hcad_garage_sqft", "hcad_lot_sqft_total", "hcad_land_line_count", "hcad_total_base_sqft", "hcad_bedrooms")}}
    df = spark.createDataFrame([tuple(None if v is None else str(v) for v in row.values())], ", ".join(f"{n} string" for n in row))
    df = df.select(*[C(n).cast(kinds.get(n, "string")).alias(n) for n in row])
    return rules.score(df, "2025-06-01").collect()[0]


def rules_columns():
    return ["probate_lead_filing_date", "probate_lead_status", "probate_lead_subtype", "probate_lead_decedent_last", "probate_lead_decedent_first", "prior_years_taxes_due", "exemption_code", "hcad_owner_full_name", "hcad_building_data_json", "hcad_physical_condition", "hcad_grade_adjustment", "hcad_land_market_value", "hcad_market_value_detail", "hcad_garage_sqft", "hcad_lot_sqft_total", "hcad_land_line_count", "rp_instrument_type", "hcad_total_base_sqft", "hcad_bedrooms", "hcad_exterior_wall", "hcad_foundation_type"]


@pytest.mark.parametrize(
    "own, score, tag",
    [
        ({}, 30, "DEED_NONE_FOUND"),
        ({"probate_lead_filing_date": "2025-03-03"}, 45, "PROBATE_TIMING"),
        ({"probate_lead_filing_date": "2025-03-04"}, 30, "DEED_NONE_FOUND"),
        ({"probate_lead_status": "OPEN"}, 55, "PROBATE_STATUS"),
        ({"probate_lead_decedent_last": "DOE"}, 40, "NAME_SIGNAL"),
        ({"probate_lead_decedent_last": "DOE", "probate_lead_decedent_first": "JANE"}, 50, "NAME_COMPLEXITY"),
        ({"probate_lead_decedent_last": "DOE", "hcad_owner_full_name": "Jane doe"}, 60, "NAME_MATCH"),
        ({"prior_years_taxes_due": "0.5"}, 55, "TAX_DISTRESS"),
        ({"prior_years_taxes_due": "0.4"}, 30, "DEED_NONE_FOUND"),
        ({"hctax_owner_mailing_address": "1 A ST, X, OK 77001", "exemption_code": "HS"}, 30, "OWNER_LOCATION"),
        ({"hctax_owner_mailing_address": "1 A ST, X, ZZ 77001"}, 60, "OWNER_LOCATION"),
        ({"hcad_building_data_json": '{"year_built":"1959"}'}, 40, "AGE_SIGNAL"),
        ({"hcad_building_data_json": '[{"year_built":"1959"}]'}, 30, "DEED_NONE_FOUND"),
        ({"hcad_land_market_value": 40, "hcad_market_value_detail": "100"}, 40, "LAND_RATIO"),
        ({"hcad_lot_sqft_total": 7500}, 30, "DEED_NONE_FOUND"),
        ({"hcad_lot_sqft_total": 7501}, 35, "LOT_SIZE"),
        ({"rp_instrument_type": "w/d"}, -20, "DEED_SALE"),
        ({"rp_instrument_type": "EXECUTOR'S DEED"}, 15, "DEED_HEIR_XFER"),
    ],
)
def test_rules(spark, own, score, tag):
    r = lead(spark, **own)
    assert r["r_score_acquisition"] == score and tag in [x["tag"] for x in r["confidence_summary_array"]]


def test_a_rule_that_scores_nothing_keeps_its_reason(spark):
    r = lead(spark, rp_instrument_type="TRUSTEE'S DEED")
    assert r["r_score_acquisition"] == 0 and r["confidence_summary_array"] == [] and r["reasoning_array"][0].startswith("DEED_NON_PROBATE")


@pytest.mark.parametrize(
    "own, wrong",
    [
        ({}, False),
        ({"exemption_code": "HS"}, True),
        ({"exemption_code": "HS", "hctax_owner_mailing_address": "1 A ST, X, TX 77001"}, False),
        ({"hcad_total_base_sqft": 0, "hcad_bedrooms": 2}, True),
        ({"hcad_lot_sqft_total": 8000, "hcad_land_market_value": 0}, True),
        ({"hcad_garage_sqft": 0, "hcad_foundation_type": "Garage slab"}, True),
        ({"hcad_physical_condition": "poor", "hcad_grade_adjustment": "b+"}, True),
    ],
)
def test_contradictions(spark, own, wrong):
    assert lead(spark, **own)["has_data_contradiction"] is wrong


def test_staging_reads_what_it_can(spark):
    raw = [('{"probate_lead_case_number":"1","probate_lead_filing_date":"2025-13-01","hcad_bedrooms":"2.5","hcad_grade_adjustment":"C-","needs_review_flag":1,"hcad_land_data_json":[1]}',), ('{"probate_lead_case_number":""}',), ("{broken",), (None,), ('{"hcad_bedrooms":1}',)]
    rows = staging.flatten(spark.createDataFrame(raw, "RAW_RECORD string")).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["probate_lead_filing_date"], int(r["hcad_bedrooms"]), r["hcad_grade_adjustment"], r["needs_review_flag"], r["hcad_land_data_json"]) == (None, 3, None, True, "[1]")


def test_choice(spark):
    rows = [
        (1, 1, "Low", 80.0, 10.0), (1, 2, "Low", 60.0, 99.0),  # a clear best summary
        (2, 1, "Low", 70.0, 10.0), (2, 2, "Low", 60.0, 90.0), (2, 3, "Low", 55.0, 95.0),  # the first that is sure
        (3, 1, "High", 50.0, 75.0), (3, 2, "High", 49.0, 60.0),  # best by detail, clear
        (4, 1, "High", 50.0, 75.0), (4, 2, "High", 49.0, 61.0),  # not clear
        (5, 1, "Low", 40.0, 75.0), (5, 2, "Low", 39.0, 65.0),
        (6, 1, "Low", 40.0, None),  # no detail, too low
        (7, 1, "Low", 50.0, None),
        (8, 1, "Low", 10.0, 20.0), (8, 2, "Low", 9.0, 21.0), (8, 3, "Low", 8.0, 22.0), (8, 4, "Low", 7.0, 99.0),  # the fourth gets no details
    ]
    got = {r["lead_id"]: (r["ord"], r["chosen_by"]) for r in candidates.choose(spark.createDataFrame(rows, "lead_id int, ord int, confidence string, summary double, detail double")).collect()}
    assert got == {1: (1, "summary"), 2: (2, "at_once"), 3: (1, "detail"), 5: (1, "detail"), 7: (1, "detail")}


def tiers(spark, lead_id, statuses, chosen=True, named=True, subdivision="S"):
    return [(lead_id, k, t, s, chosen, named, subdivision) for k, (t, s) in enumerate(zip(legal.TIERS, statuses))]


def test_fall_back(spark):
    no = "NO_HITS"
    cases = {
        1: (["UNIQUE_HIT"] + [no] * 6, True, True, ("SUCCESS", legal.TIERS[0])),
        2: (["UNIQUE_HIT"] + [no] * 6, True, False, (no, "N/A")),
        3: (["SINGLE_ITEM_IN_LIST"] + [no] * 6, True, False, ("SUCCESS_T0_NEEDS_NAME_CONFIRM", legal.TIERS[0])),
        4: ([no, "MULTIPLE_HITS"] + [no] * 5, True, True, ("SUCCESS", legal.TIERS[1])),
        5: ([no] * 6 + ["MULTIPLE_HITS"], False, True, (f"MULTIPLE_HITS_NO_WINNER_TIER_{legal.TIERS[6]}", "N/A")),
        6: ([no, "PAGINATION_TOO_LARGE", no, "UNIQUE_HIT", "UNIQUE_HIT", no, "UNIQUE_HIT"], True, True, ("SKIPPED_DUE_TO_BROAD_SEARCH", "N/A")),
        7: ([no, "ERROR", "UNIQUE_HIT"] + [no] * 4, True, True, (f"ERROR_IN_TIER_{legal.TIERS[1]}", "N/A")),
        8: ([no, "UNIQUE_HIT"] + [no] * 5, False, True, ("DETAIL_PARSE_FAILED", "N/A")),
        9: ([legal.TOO_BROAD] * 7, False, True, (legal.TOO_BROAD, "N/A")),
    }
    rows = [r for k, (s, c, n, _) in cases.items() for r in tiers(spark, k, s, c, n)]
    df = spark.createDataFrame(rows, "lead_id int, ord int, tier string, status string, chosen boolean, named boolean, subdivision string")
    got = {r["lead_id"]: (r["hcad_search_status"], r["hcad_final_tier_hit"]) for r in candidates.fall_back(df).collect()}
    assert got == {k: v[3] for k, v in cases.items()}


def test_search_is_containment(spark):
    q = spark.createDataFrame([(1, "t", "LT 5 BLK 2", None, "READY"), (2, "t", "OA", None, "READY"), (3, "t", "OAK", "DOE", "READY"), (4, "t", None, None, "NO_QUERY_FORMED")], "lead_id int, tier string, legal_query string, owner_query string, query_state string")
    p = spark.createDataFrame([(1, "lt 5 blk 22 oaks", "x DOE"), (2, "OAK", "LEE"), (3, "ROAD", None), (4, None, "DOE")], "property_id int, legal_text string, owner_name string")
    got = sorted((r["lead_id"], r["property_id"]) for r in candidates.search(q, p).collect())
    assert got == [(1, 1), (2, 1), (2, 2), (2, 3), (3, 1)]


@pytest.mark.parametrize("owner, dead, party, kind", [("DOE JANE", ("JANE", "DOE"), (None, None), owners.SAME), ("DOE JANE", ("JANE", "DOE"), ("JANE", "DOE"), owners.SAME), ("DOE JANE", ("JANE", "DOE"), ("XAVIER", "QUUX"), owners.DIFFERED), ("DOE JANE", ("XAVIER", "QUUX"), ("JANE", "DOE"), owners.DEVIATED), ("POE ANN", ("XAVIER", "QUUX"), (None, None), owners.GRANTEE), ("ACME LLC", ("JANE", "DOE"), (None, None), owners.UNRELATED), (None, ("JANE", "DOE"), (None, None), owners.MISSING)])
def test_owner_types(spark, owner, dead, party, kind):
    row = spark.createDataFrame([(owner, *dead, *party, ["ANN POE"], "SUCCESS", None)], "hcad_owner_full_name string, decedent_first string, decedent_last string, party_first string, party_last string, rp_grantee_full_names_list array<string>, hcad_search_status string, parsing_error string")
    r = owners.review(owners.match_type(owners.scores(row))).collect()[0]
    assert r["hcad_owner_match_type"] == kind and r["needs_review_flag"] == (kind not in (owners.SAME,))


def test_qa_sample_refills_from_low(spark):
    rows = [(i, "High" if i < 2 else "Low", 100.0 - i) for i in range(40)]
    got = linkage.qa_sample(spark.createDataFrame(rows, "k int, match_confidence_level string, match_score_total double"), "k").collect()
    assert sorted(r["k"] for r in got) == list(range(18))


def test_first_rows_and_defaults(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, None), (2, 1, "a")], "k int, o int, v string")
    assert sorted(map(tuple, relational.first_by(df, ["k"], [C("o")]).collect())) == [(1, 2, None), (2, 1, "a")]
    out = relational.ensure_columns(df, {"n": ("double", 0), "v": ("string", "never")})
    assert out.columns == ["k", "o", "v", "n"] and relational.ordered(out, ["n", "missing", "k"]).columns == ["n", "k", "o", "v"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a;b\nc", 'say "x"', None)], "p string, q string, r string")
    files.write(df, str(tmp_path / "one"), ";", quote_all=True)
    assert [tuple(r) for r in files.read(spark, str(tmp_path / "one"), ";", filled=True).collect()] == [("a;b\nc", 'say "x"', "")]
    assert files.newest(spark, str(tmp_path), "*.txt") is None
    assert quality.wrong_delimiter(files.read(spark, str(tmp_path / "one"), "|"))


def test_pages(spark):
    page = "<table><tr><th>Case</th><th>Party</th></tr><tr><td>1<td>A &amp; B</tr><tr><td>2</td></tr></table>"
    rows = html.rows_by_header(spark.createDataFrame([(1, page)], "id int, h string"), "h", ["Party", "Case", "Absent"]).collect()
    assert [(r["Case"], r["Party"], r["Absent"]) for r in rows] == [("1", "A & B", ""), ("2", "", "")]


def test_stream(spark, tmp_path):
    from ledgerline import streaming

    raw = spark.createDataFrame([('{"probate_lead_case_number":"1","probate_lead_status":"Open"}',)], "RAW_RECORD string")
    cols = "cast(null as string) PROBATE_CASE_NUMBER, cast(null as string) HCAD_ACCOUNT_ID, cast(null as timestamp) SCRAPE_TIMESTAMP, cast(null as string) SOURCE_FILENAME, cast(null as double) HCAD_LOT_SQFT_TOTAL, RAW_RECORD"
    for _ in range(2):
        raw.selectExpr(*cols.split(", ")).write.mode("append").parquet(str(tmp_path / "in"))
        streaming.score(streaming.records(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"), "2025-06-01").awaitTermination()
    assert [r["r_score_acquisition"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [55, 55]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["lead_scores", "report_rules", "qa_sample", "tier_fallback", "owner_types", "candidate_choice", "lots_and_parties", "merged_metadata", "deeds_near_filing", "property_search"])
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    rel = con.sql(registry.oracle_sql()[name])
    plain = lambda v: float(f"{float(v):.8g}") if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    key = lambda r: tuple((x is None, str(x)) for x in r)
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [list(rel.columns).index(c) for c in cols]
    a = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    b = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=key)
    assert a == b and (a or name in ())


def test_flagship(spark):
    if os.path.isdir(SF):
        rows = registry.flagship(spark, SF).collect()
        assert len(rows) == 20 and rows[0]["r_score_acquisition"] >= rows[-1]["r_score_acquisition"]


def test_staged_texts_are_those_of_a_variant(spark):
    import json

    own = ['5', '5.0', '-5.00', '1e3', '"5.0"', '"x: 5.0, y"', "true", "null", '{"b": [1, 2.50]}', "[5.0]", '""', "0.10", "123456789012345678901234567890", '"é\\n"']
    rows = [f'{{"{schemas.KEY}": "c{i}", "hcad_owner_full_name": {v}, "hcad_bedrooms": {v}, "hcad_land_data_json": {v}}}' for i, v in enumerate(own)]
    rows += [f'{{"{schemas.KEY}": "", "probate_name": "x"}}', f'{{"{schemas.KEY}": "a", "{schemas.KEY}": "b"}}', "not", "", None, "5", "[1]", "null", f"{{'{schemas.KEY}': 's'}}", json.dumps({schemas.KEY: None}), f'{{"{schemas.KEY}": "cut"']
    df = spark.createDataFrame([(r,) for r in rows], "RAW_RECORD string")
    got = staging.flatten(df)
    assert got.columns == schemas.STAGED
    value = F.try_parse_json("RAW_RECORD")
    text = lambda c: F.try_variant_get(value, f"$.{c}", "string")
    want = df.filter(F.coalesce(text(schemas.KEY), F.lit("")) != "").select(text(schemas.KEY), text("hcad_owner_full_name"), text("hcad_bedrooms").try_cast("decimal(38,0)"), text("hcad_land_data_json"))
    assert sorted(map(tuple, got.select(schemas.KEY, "hcad_owner_full_name", "hcad_bedrooms", "hcad_land_data_json").collect())) == sorted(map(tuple, want.collect())) and want.count() == len(own)
