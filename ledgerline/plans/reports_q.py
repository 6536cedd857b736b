"""Reports over scored leads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import numbers, text
from ledgerline.operators import rules

from .leads_q import SCORED_SQL, STREETS, scored  # noqa: F401
from .registry import query

S = f"WITH {SCORED_SQL} "
C = F.col


def rate(test) -> F.Column:
    return numbers.percent(F.count_if(test), F.count("*"))


@query("AGG01", S + "SELECT count(*) AS total_records, round(avg(r_score_acquisition), 2) AS avg_score, max(r_score_acquisition) AS max_score, count_if(r_score_acquisition > 50)::BIGINT AS high_value_leads FROM scored")
def report_kpi(spark, sf_dir):
    s = C("r_score_acquisition")
    return scored(spark, sf_dir).agg(F.count("*").alias("total_records"), F.round(F.avg(s), 2).alias("avg_score"), F.max(s).alias("max_score"), F.count_if(s > 50).alias("high_value_leads"))


@query("AGG02 AGG16 NUM06", S + """SELECT count(*) AS total_records, round(avg(r_score_acquisition), 2) AS avg_score, round(stddev_samp(r_score_acquisition), 2) AS score_stddev, min(r_score_acquisition) AS min_score,
    max(r_score_acquisition) AS max_score, round(median(r_score_acquisition), 2) AS median_score, count_if(r_score_acquisition > 50)::BIGINT AS high, count_if(r_score_acquisition > 75)::BIGINT AS very_high, count_if(has_data_contradiction)::BIGINT AS contradictions FROM scored""")  # fmt: skip
def report_statistics(spark, sf_dir):
    s = C("r_score_acquisition")
    return scored(spark, sf_dir).agg(
        F.count("*").alias("total_records"), F.round(F.avg(s), 2).alias("avg_score"), F.round(F.stddev_samp(s), 2).alias("score_stddev"), F.min(s).alias("min_score"), F.max(s).alias("max_score"),
        F.round(F.median(s), 2).alias("median_score"), F.count_if(s > 50).alias("high"), F.count_if(s > 75).alias("very_high"), F.count_if("has_data_contradiction").alias("contradictions"),
    )


# Ranges of scores, as a report names them.
RANGE = """CASE WHEN r_score_acquisition < 0 THEN 'Negative (< 0)' WHEN r_score_acquisition = 0 THEN 'Zero (0)' WHEN r_score_acquisition BETWEEN 1 AND 25 THEN 'Low (1-25)'
    WHEN r_score_acquisition BETWEEN 26 AND 50 THEN 'Medium (26-50)' WHEN r_score_acquisition BETWEEN 51 AND 75 THEN 'High (51-75)' WHEN r_score_acquisition > 75 THEN 'Very High (75+)' END"""


@query("AGG03 AGG17 WIN01 SRT08", S + f"SELECT {RANGE} AS score_range, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS percentage, min(r_score_acquisition) AS least FROM scored GROUP BY score_range")
def report_ranges(spark, sf_dir):
    """Shares are taken over the few grouped rows."""
    grouped = scored(spark, sf_dir).withColumn("score_range", F.expr(RANGE)).groupBy("score_range").agg(F.count("*").alias("n"), F.min("r_score_acquisition").alias("least"))
    share = F.round(C("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2).cast("double")
    return grouped.withColumn("percentage", share).orderBy("least")


SHOWN = ["lead_id", "hcad_account", "hcad_owner_full_name", "probate_lead_decedent_last", "r_score_acquisition", "property_state", "mailing_location_type", "has_data_contradiction"]


def _shown(df):
    return df.select(*SHOWN, F.array_join("reasoning_array", " | ").alias("reasons"))


@query("SRT03 FLT13", S + f"SELECT {', '.join(SHOWN)}, array_to_string(reasoning_array, ' | ') AS reasons FROM scored ORDER BY r_score_acquisition DESC, lead_id LIMIT 20")
def report_top(spark, sf_dir):
    return _shown(scored(spark, sf_dir).filter(C("r_score_acquisition").isNotNull()).orderBy(F.desc("r_score_acquisition"), "lead_id").limit(20))


@query("SRT03", S + f"SELECT {', '.join(SHOWN)}, array_to_string(reasoning_array, ' | ') AS reasons FROM scored ORDER BY r_score_acquisition, lead_id LIMIT 10")
def report_bottom(spark, sf_dir):
    return _shown(scored(spark, sf_dir).filter(C("r_score_acquisition").isNotNull()).orderBy("r_score_acquisition", "lead_id").limit(10))


# How reports name the rules.
RULE_NAMES = {
    "1": "R1 - Probate Old (90+ days)", "2": "R2 - Probate Still Open", "3": "R3 - Basic Probate Type", "4": "R4 - Decedent Last Name Present", "5": "R5 - Valid Full Name", "10": "R10 - Tax Delinquent",
    "11": "R11 - Homestead (Negative)", "12_5": "R12.5 - Out of State Owner", "13": "R13 - Owner Matches Decedent", "14": "R14 - Built Before 1960", "15": "R15 - Poor Condition",
    "16": "R16 - High Land Value Ratio", "16_5": "R16.5 - Has Garage", "17": "R17 - Large Lot", "17_5": "R17.5 - Multi-Segment Lot",
}


def _fired(r: str) -> str:
    return f"r{r}_score {'<' if r == '11' else '>'} 0"


@query("AGG06 SET03 SRT08", S + " UNION ALL ".join(
    f"SELECT '{n}' AS rule_name, count_if({_fired(r)})::BIGINT AS times_fired, round(count_if({_fired(r)}) * 100.0 / count(*), 2)::DOUBLE AS fire_rate_pct, avg(CASE WHEN {_fired(r)} THEN r{r}_score END) AS avg_score_when_fired FROM scored" for r, n in RULE_NAMES.items()))
def report_rules(spark, sf_dir):
    """All rules in one pass over the leads, instead of one each."""
    rows = scored(spark, sf_dir)
    each = F.array(*[F.struct(F.lit(n).alias("rule_name"), F.expr(_fired(r)).alias("fired"), C(f"r{r}_score").alias("score")) for r, n in RULE_NAMES.items()])
    flat = rows.select(F.explode(each).alias("r")).select("r.*")
    return flat.groupBy("rule_name").agg(F.count_if("fired").alias("times_fired"), rate(C("fired")).cast("double").alias("fire_rate_pct"), F.avg(F.when(C("fired"), C("score"))).alias("avg_score_when_fired")).orderBy(F.desc("times_fired"), "rule_name")


@query("AGG07 SET02", S + """SELECT 'Records with Contradictions' AS metric, count_if(has_data_contradiction)::BIGINT AS n, round(count_if(has_data_contradiction) * 100.0 / count(*), 2)::DOUBLE AS percentage FROM scored
    UNION ALL SELECT 'Records without Contradictions', count_if(NOT has_data_contradiction)::BIGINT, round(count_if(NOT has_data_contradiction) * 100.0 / count(*), 2)::DOUBLE FROM scored""")  # fmt: skip
def report_contradictions(spark, sf_dir):
    yes, no = C("has_data_contradiction"), ~C("has_data_contradiction")
    a = scored(spark, sf_dir).agg(F.count_if(yes).alias("y"), F.count_if(no).alias("n"), rate(yes).cast("double").alias("yp"), rate(no).cast("double").alias("np"))
    rows = F.array(F.struct(F.lit("Records with Contradictions").alias("metric"), C("y").alias("n"), C("yp").alias("percentage")), F.struct(F.lit("Records without Contradictions").alias("metric"), C("n").alias("n"), C("np").alias("percentage")))
    return a.select(F.explode(rows).alias("r")).select("r.*")


@query("SRT03 FLT13 JSN11", S + """SELECT lead_id, hcad_account, r_score_acquisition, array_to_string(reasoning_array, ' | ') AS reasons,
    CASE WHEN r11_score < 0 AND mailing_location_type <> 'SAME_STATE' THEN 'Homestead + Absentee Owner' END AS contradiction_1, CASE WHEN r15_score > 0 AND CAST(hcad_grade_adjustment AS VARCHAR) IN ('A', 'B', 'A+', 'B+') THEN 'Poor Condition + High Grade' END AS contradiction_2
    FROM scored WHERE has_data_contradiction ORDER BY lead_id LIMIT 20""")  # fmt: skip
def report_contradictory(spark, sf_dir):
    why = {"contradiction_1": F.when((C("r11_score") < 0) & (C("mailing_location_type") != "SAME_STATE"), "Homestead + Absentee Owner"), "contradiction_2": F.when((C("r15_score") > 0) & C("hcad_grade_adjustment").cast("string").isin("A", "B", "A+", "B+"), "Poor Condition + High Grade")}
    return scored(spark, sf_dir).filter("has_data_contradiction").orderBy("lead_id").limit(20).select("lead_id", "hcad_account", "r_score_acquisition", F.array_join("reasoning_array", " | ").alias("reasons"), *[v.alias(k) for k, v in why.items()])


@query("AGG04 FLT13", S + """SELECT property_state, mailing_location_type, count(*) AS property_count, round(avg(r_score_acquisition), 2) AS avg_score, count_if(r_score_acquisition > 50)::BIGINT AS high_scores,
    round(count_if(r_score_acquisition > 50) * 100.0 / count(*), 2)::DOUBLE AS high_score_pct FROM scored GROUP BY ALL HAVING count(*) >= 5""")  # fmt: skip
def report_geography(spark, sf_dir):
    s = C("r_score_acquisition")
    rows = scored(spark, sf_dir).filter(C("property_state").isNotNull() & C("mailing_location_type").isNotNull()).groupBy("property_state", "mailing_location_type")
    return rows.agg(F.count("*").alias("property_count"), F.round(F.avg(s), 2).alias("avg_score"), F.count_if(s > 50).alias("high_scores"), rate(s > 50).cast("double").alias("high_score_pct")).filter("property_count >= 5").orderBy(F.desc("avg_score"))


@query("AGG05 JSN07", S + """SELECT array_to_string(reasoning_array, ' | ') AS reasons, count(*) AS frequency, round(avg(r_score_acquisition), 2) AS avg_score, min(r_score_acquisition) AS min_score, max(r_score_acquisition) AS max_score
    FROM scored WHERE len(reasoning_array) > 0 GROUP BY reasoning_array HAVING count(*) >= 2 ORDER BY frequency DESC, reasons LIMIT 25""")  # fmt: skip
def report_reasons(spark, sf_dir):
    s = C("r_score_acquisition")
    # The size is tested after grouping: before it, the filter would be pushed through every rule.
    rows = scored(spark, sf_dir).select(F.array_join("reasoning_array", " | ").alias("reasons"), F.size("reasoning_array").alias("size"), "r_score_acquisition")
    grouped = rows.groupBy("reasons").agg(F.max("size").alias("size"), F.count("*").alias("frequency"), F.round(F.avg(s), 2).alias("avg_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"))
    return grouped.filter("frequency >= 2 and size > 0").drop("size").orderBy(F.desc("frequency"), "reasons").limit(25)


@query("SRT03 SRT09 STR20", S + """SELECT lead_id, hcad_account, hcad_owner_full_name, probate_lead_decedent_last || ', ' || probate_lead_decedent_first AS decedent_name, r_score_acquisition, property_state, mailing_location_type,
    has_data_contradiction, reasoning_array[1] AS top_reason FROM scored ORDER BY lead_id LIMIT 10""")  # fmt: skip
def report_sample(spark, sf_dir):
    name = F.expr("probate_lead_decedent_last || ', ' || probate_lead_decedent_first")
    return scored(spark, sf_dir).orderBy("lead_id").limit(10).select("lead_id", "hcad_account", "hcad_owner_full_name", name.alias("decedent_name"), "r_score_acquisition", "property_state", "mailing_location_type", "has_data_contradiction", F.get("reasoning_array", 0).alias("top_reason"))


# Street words that an address report looks for, in order.
WORDS = ["STREET", "ROAD", "LANE", "DRIVE", "AVENUE", "BOULEVARD", "CIRCLE", "COURT", "PLACE"]
A = "hcad_mailing_address"
# What reports call odd addresses, the first that fits.
EDGE = "CASE " + " ".join(f"WHEN {A} LIKE '%{w}%' THEN 'Has {w} word'" for w in WORDS) + f" WHEN {A} LIKE '%PKWY%' THEN 'Has PKWY' WHEN {A} LIKE '%BLVD%' THEN 'Has BLVD' WHEN #two# > 2 THEN 'Multiple 2-letter combos' WHEN {A} NOT LIKE '%TX%' THEN 'No TX in address' ELSE 'Standard format' END"
WEIRD = f"CASE WHEN #zip# > 1 THEN 'Multiple ZIP codes' WHEN {A} LIKE '%APT%' OR {A} LIKE '%UNIT%' THEN 'Has apartment/unit' WHEN {A} LIKE '%#%' THEN 'Has # symbol' WHEN {A} LIKE '%PO BOX%' OR {A} LIKE '%P.O.%' THEN 'PO Box format' WHEN length({A}) > 100 THEN 'Very long address' WHEN #comma# > 2 THEN 'Multiple commas' ELSE 'Other weird format' END"
ODD = f"(#zip# > 1 OR {A} LIKE '%APT%' OR {A} LIKE '%UNIT%' OR {A} LIKE '%#%' OR {A} LIKE '%PO BOX%' OR {A} LIKE '%P.O.%' OR length({A}) > 100 OR #comma# > 2)"
_PATTERNS = {"#two#": "[A-Z]{2}", "#zip#": "[0-9]{5}", "#comma#": ","}


def _counted(sql: str, form: str) -> str:
    for k, p in _PATTERNS.items():
        sql = sql.replace(k, form.replace("?", p))
    return sql


def _duck(sql: str) -> str:
    return _counted(sql, f"len(regexp_extract_all({A}, '?'))")


KNOWN = "(" + ", ".join(f"'{s}'" for s in [*text.US_STATES, "FOREIGN", "UNKNOWN"]) + ")"
_COLS = f"lead_id, {A}, mailing_state_raw, mailing_location_type, r12_5_score"


@query("SET05 SRT07 STR18 STR19 FLT09 FLT11 FLT13 SRT08", S + f"""
(SELECT 'Potential Edge Cases' AS analysis_type, {_COLS}, {_duck(EDGE)} AS edge_case_type FROM scored WHERE mailing_location_type = 'FOREIGN' ORDER BY lead_id LIMIT 25)
UNION ALL (SELECT 'Unknown States', {_COLS}, 'Regex failed to extract any state' FROM scored WHERE mailing_state_raw = 'UNKNOWN' AND {A} IS NOT NULL AND length({A}) > 10 ORDER BY lead_id LIMIT 15)
UNION ALL (SELECT 'Suspicious State Codes', {_COLS}, 'Extracted unusual 2-letter combo' FROM scored WHERE mailing_state_raw NOT IN {KNOWN} ORDER BY lead_id LIMIT 15)
UNION ALL (SELECT 'Weird Address Formats', {_COLS}, {_duck(WEIRD)} FROM scored WHERE {_duck(ODD)} ORDER BY lead_id LIMIT 20)""")  # fmt: skip
def report_edge_cases(spark, sf_dir):
    """Four labelled samples of addresses; each branch has a limit and an order of its own."""
    e = lambda sql: F.expr(_counted(sql, f"regexp_count({A}, '?')"))
    rows = scored(spark, sf_dir)

    def part(name, test, kind, n):
        return rows.filter(test).orderBy("lead_id").limit(n).select(F.lit(name).alias("analysis_type"), *_COLS.split(", "), kind.alias("edge_case_type"))

    raw, address = C("mailing_state_raw"), C(A)
    return (
        part("Potential Edge Cases", C("mailing_location_type") == "FOREIGN", e(EDGE), 25)
        .unionByName(part("Unknown States", (raw == "UNKNOWN") & address.isNotNull() & (F.length(address) > 10), F.lit("Regex failed to extract any state"), 15))
        .unionByName(part("Suspicious State Codes", ~raw.isin([*text.US_STATES, "FOREIGN", "UNKNOWN"]), F.lit("Extracted unusual 2-letter combo"), 15))
        .unionByName(part("Weird Address Formats", e(ODD), e(WEIRD), 20))
    )


@query("SET04 FLT08 SRT07 AGG17", S + f"""
SELECT 'Specific Address Check' AS query_type, lead_id::VARCHAR AS item, hcad_owner_full_name AS detail, {A} AS more, mailing_state, r12_5_score FROM scored WHERE hcad_owner_full_name IN ('DOE JANE', 'LEE BOB') OR {A} LIKE '%OAK DR HOUSTON TX%'
UNION ALL SELECT 'Location Type Distribution', mailing_location_type, count(*)::VARCHAR, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE::VARCHAR || '%', NULL, NULL FROM scored GROUP BY mailing_location_type
UNION ALL (SELECT 'Remaining Foreign Addresses', lead_id::VARCHAR, hcad_owner_full_name, {A}, mailing_state, r12_5_score FROM scored WHERE mailing_location_type = 'FOREIGN' ORDER BY lead_id LIMIT 10)""")  # fmt: skip
def report_validation(spark, sf_dir):
    rows = scored(spark, sf_dir)
    shown = lambda df, name: df.select(F.lit(name).alias("query_type"), C("lead_id").cast("string").alias("item"), C("hcad_owner_full_name").alias("detail"), C(A).alias("more"), "mailing_state", "r12_5_score")
    one = shown(rows.filter(C("hcad_owner_full_name").isin("DOE JANE", "LEE BOB") | C(A).like("%OAK DR HOUSTON TX%")), "Specific Address Check")
    grouped = rows.groupBy("mailing_location_type").count()
    share = F.concat(F.round(C("count") * 100.0 / F.sum("count").over(Window.partitionBy()), 2).cast("double").cast("string"), F.lit("%"))
    two = grouped.select(F.lit("Location Type Distribution").alias("query_type"), C("mailing_location_type").alias("item"), C("count").cast("string").alias("detail"), share.alias("more"), F.lit(None).cast("string").alias("mailing_state"), F.lit(None).cast("int").alias("r12_5_score"))
    three = shown(rows.filter(C("mailing_location_type") == "FOREIGN").orderBy("lead_id").limit(10), "Remaining Foreign Addresses")
    return one.unionByName(two).unionByName(three)


@query("AGG14 NUM06", S + "SELECT mailing_location_type, r100_score, count(*) AS n, count_if(has_data_contradiction)::BIGINT AS flagged FROM scored GROUP BY ALL")
def report_counts(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("mailing_location_type", "r100_score").agg(F.count("*").alias("n"), F.count_if("has_data_contradiction").alias("flagged"))


assert set(RULE_NAMES) | {"100"} == set(rules.RULES)
