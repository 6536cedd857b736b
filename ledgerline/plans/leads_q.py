"""Leads: packed, flattened, located, scored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import text
from ledgerline.operators import rules, staging

from . import derive
from .registry import query


def packed(spark, sf_dir) -> DataFrame:
    """Leads as records, packed once, as the load table."""
    return derive.saved(spark, sf_dir, "packed_leads", lambda: staging.pack(derive.relation(spark, sf_dir, derive.LEADS), "probate_lead_case_number", "hcad_account", "leads", "hcad_lot_sqft_total", "2025-06-01 00:00:00"))


def staged(spark, sf_dir) -> DataFrame:
    """The staging contract of all leads, flattened once, as a table."""
    return derive.saved(spark, sf_dir, "staged_leads", lambda: staging.flatten(packed(spark, sf_dir)).withColumn("lead_id", F.substr("probate_lead_case_number", F.lit(4)).cast("bigint")))


def scored(spark, sf_dir) -> DataFrame:
    """Scored once, as a table: reports read the columns that they need."""
    return derive.saved(spark, sf_dir, "scored_leads", lambda: rules.flat(rules.score(staged(spark, sf_dir), derive.AS_OF)))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NUMERIC = [c for c in schemas.NUMBERS if f" AS {c}" in derive.LEADS]
IN_US = "(" + ", ".join(map(quoted, text.US_STATES)) + ")"
STREETS = "(" + ", ".join(map(quoted, text.STREET_WORDS)) + ")"


def _state(a: str) -> str:
    g = lambda p: f"nullif(regexp_extract(upper({a}), '{p}', 1), '')"
    z, e = g(r"\s+([A-Z]{2})\s+\d{5}"), g(r"\s+([A-Z]{2})\s*$")
    comma = g(r",\s*([A-Z]{2})\s+\d{5}")
    return f"coalesce({comma}, CASE WHEN {z} NOT IN {STREETS} THEN {z} END, CASE WHEN {e} NOT IN {STREETS} THEN {e} END, 'UNKNOWN')"


# The same rules in the other dialect: conditions by rule and branch.
_WHEN = {
    "1": [f"probate_lead_filing_date IS NOT NULL AND date_diff('day', probate_lead_filing_date, DATE '{derive.AS_OF}') >= 90"],
    "2": ["lower(probate_lead_status) = 'open'"],
    "3": ["(lower(probate_lead_subtype) LIKE '%affidavit%' OR lower(probate_lead_subtype) LIKE '%administration%')"],
    "4": ["probate_lead_decedent_last IS NOT NULL"],
    "5": ["length(trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last)) - length(replace(trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last), ' ', '')) >= 1"],
    "10": ["TRY_CAST(prior_years_taxes_due AS DECIMAL(38,0)) > 0"],
    "11": ["contains(lower(exemption_code), 'hs')"],
    "12_5": ["mailing_location_type = 'NEARBY_STATE'", "mailing_location_type = 'US_OTHER'", "mailing_location_type = 'FOREIGN'"],
    "13": ["split_part(lower(hcad_owner_full_name), ' ', -1) = lower(probate_lead_decedent_last)"],
    "14": ["TRY_CAST(json_extract_string(TRY_CAST(hcad_building_data_json AS JSON), '$.year_built') AS DECIMAL(38,0)) < 1960"],
    "15": ["upper(hcad_physical_condition) IN ('POOR', 'VERY POOR', 'UNSOUND') OR CAST(hcad_grade_adjustment AS VARCHAR) IN ('C', 'C-', 'D', 'D-', 'E', 'F')"],
    "16": ["hcad_land_market_value > 0 AND market > 0 AND hcad_land_market_value::DOUBLE / nullif(market, 0)::DOUBLE >= 0.40"],
    "16_5": ["hcad_garage_sqft > 0"],
    "17": ["hcad_lot_sqft_total > 7500"],
    "17_5": ["hcad_land_line_count > 1"],
    "100": ["upper(rp_instrument_type) IN ('W/D', 'DEED', 'SPECIAL WARRANTY DEED')", "upper(rp_instrument_type) = 'EXECUTOR''S DEED'", "upper(rp_instrument_type) IN ('AFFT', 'QUITCLAIM DEED', 'GIFT DEED')", "upper(rp_instrument_type) = 'TRUSTEE''S DEED'", "true"],
}


def _case(rule: str, value) -> str:
    return "CASE " + " ".join(f"WHEN {w} THEN {value(b)}" for w, b in zip(_WHEN[rule], rules.RULES[rule], strict=True)) + " END"


_FIELDS = ",\n".join(
    f"coalesce({_case(r, lambda b: b.score)}, 0)::INTEGER AS r{r}_score, {_case(r, lambda b: quoted(b.reasoning))} AS r{r}_why, {_case(r, lambda b: quoted(f'{b.reasoning.split(":")[0]}:{b.confidence}:{b.confidence_reason}') if b.score else 'NULL')} AS r{r}_sure"
    for r in rules.RULES
)
SCORED_SQL = f"""
base AS ({derive.LEADS}),
typed AS (SELECT * REPLACE ({', '.join(f'TRY_CAST({c} AS DECIMAL(38,0)) AS {c}' for c in NUMERIC)}, TRY_CAST(probate_lead_filing_date AS DATE) AS probate_lead_filing_date),
    TRY_CAST(hcad_market_value_detail AS DECIMAL(38,0)) AS market FROM base WHERE probate_lead_case_number <> ''),
states AS (SELECT *, {_state('hcad_site_address')} AS property_state_raw, {_state('hctax_owner_mailing_address')} AS mailing_state_raw FROM typed),
located AS (SELECT *, CASE WHEN property_state_raw IN {IN_US} OR property_state_raw = 'UNKNOWN' THEN property_state_raw ELSE 'FOREIGN' END AS property_state,
    CASE WHEN mailing_state_raw IN {IN_US} OR mailing_state_raw = 'UNKNOWN' THEN mailing_state_raw ELSE 'FOREIGN' END AS mailing_state,
    CASE WHEN mailing_state_raw = 'TX' THEN 'SAME_STATE' WHEN mailing_state_raw IN ('OK', 'LA', 'NM', 'AR') THEN 'NEARBY_STATE' WHEN mailing_state_raw IN {IN_US} THEN 'US_OTHER'
        WHEN mailing_state_raw <> 'UNKNOWN' THEN 'FOREIGN' ELSE 'UNKNOWN' END AS mailing_location_type FROM states),
ruled AS (SELECT *, {_FIELDS} FROM located),
scored AS (SELECT *, ({' + '.join(f'r{r}_score' for r in rules.RULES)})::INTEGER AS r_score_acquisition,
    list_filter([{', '.join(f'r{r}_why' for r in rules.RULES)}], lambda x: x IS NOT NULL) AS reasoning_array,
    list_filter([{', '.join(f'r{r}_sure' for r in rules.RULES)}], lambda x: x IS NOT NULL) AS sure,
    coalesce(r11_score < 0 AND mailing_location_type <> 'SAME_STATE', false) OR coalesce(r15_score > 0 AND CAST(hcad_grade_adjustment AS VARCHAR) IN ('A', 'B', 'A+', 'B+'), false)
    OR coalesce(hcad_total_base_sqft = 0 AND hcad_bedrooms > 0, false) OR coalesce(hcad_lot_sqft_total > 7500 AND hcad_land_market_value = 0, false)
    OR coalesce(hcad_garage_sqft = 0 AND (lower(hcad_exterior_wall) LIKE '%garage%' OR lower(hcad_foundation_type) LIKE '%garage%'), false) AS has_data_contradiction FROM ruled)
"""


@query("JSN01 JSN02 JSN09 FLT01 NUM03 NUM04 PRJ06 UDF08 SRC11", f"""
WITH base AS ({derive.LEADS}) SELECT lead_id, probate_lead_case_number, TRY_CAST(probate_lead_filing_date AS DATE) AS filed,
    CASE needs_review_flag WHEN 'true' THEN true WHEN '0' THEN false WHEN 'False' THEN false END AS flagged,
    TRY_CAST(match_score_total AS DECIMAL(38,0))::BIGINT AS total, TRY_CAST(hcad_lot_sqft_total AS DECIMAL(38,0))::BIGINT AS lot, TRY_CAST(hcad_bedrooms AS DECIMAL(38,0))::BIGINT AS bedrooms,
    hcad_building_data_json AS building, prior_years_taxes_due, 114 AS n_columns FROM base WHERE probate_lead_case_number <> ''""")  # fmt: skip
def staged_leads(spark, sf_dir):
    """Packed records, flattened into the staging contract."""
    df = staged(spark, sf_dir)
    return df.select(
        "lead_id", "probate_lead_case_number", F.col("probate_lead_filing_date").alias("filed"), F.col("needs_review_flag").alias("flagged"), F.col("match_score_total").cast("bigint").alias("total"),
        F.col("hcad_lot_sqft_total").cast("bigint").alias("lot"), F.col("hcad_bedrooms").cast("bigint").alias("bedrooms"), F.col("hcad_building_data_json").alias("building"), "prior_years_taxes_due", F.lit(len(schemas.STAGED)).alias("n_columns"),
    )


@query("PRJ01", f"""WITH c AS (SELECT unnest(string_split('{" ".join([*schemas.TEXTS, *schemas.NUMBERS, *schemas.DOCUMENTS, *schemas.FLAGS, *schemas.DATES, schemas.KEY])}', ' ')) AS column_name)
SELECT row_number() OVER (ORDER BY column_name)::INTEGER AS place, column_name FROM c""")  # fmt: skip
def staged_columns(spark, sf_dir):
    """The staged table's columns as they come: the contract's order."""
    names = [c for c in staged(spark, sf_dir).columns if c != "lead_id"]
    return spark.createDataFrame(list(enumerate(names, 1)), "place int, column_name string")


@query("CTL05", f"""WITH base AS ({derive.LEADS}), f AS (SELECT lead_id, CASE WHEN lead_id % 83 = 0 THEN 'not JSON' WHEN coalesce(probate_lead_case_number, '') = '' THEN 'no case number' ELSE nullif(concat_ws(',',
    {', '.join(f"CASE WHEN {c} IS NOT NULL AND {t} IS NULL THEN '{c}' END" for c, t in sorted([(c, f'TRY_CAST({c} AS DECIMAL(38,0))') for c in NUMERIC] + [('probate_lead_filing_date', 'TRY_CAST(probate_lead_filing_date AS DATE)'), ('needs_review_flag', "CASE WHEN needs_review_flag IN ('true', '0', 'False') THEN 1 END")]))}), '') END AS parsing_error FROM base)
SELECT * FROM f WHERE parsing_error IS NOT NULL""")  # fmt: skip
def record_failures(spark, sf_dir):
    """What of each packed record cannot be read; every 83rd record is cut short."""
    raw = packed(spark, sf_dir).withColumn("lead_id", F.get_json_object("RAW_RECORD", "$.lead_id").cast("bigint"))
    cut = raw.withColumn("RAW_RECORD", F.when(F.col("lead_id") % 83 == 0, F.substring("RAW_RECORD", 1, 40)).otherwise(F.col("RAW_RECORD")))
    return staging.failures(cut).select("lead_id", "parsing_error").filter("parsing_error is not null")


@query("PRJ06 UDF08 SNK06", f"""
WITH base AS ({derive.LEADS}) SELECT probate_lead_case_number AS case_number, hcad_account AS account, 'leads' AS source, TRY_CAST(hcad_lot_sqft_total AS DOUBLE) AS lot, hcad_owner_full_name AS owner, hcad_site_address AS site FROM base""")  # fmt: skip
def packed_records(spark, sf_dir):
    df = packed(spark, sf_dir)
    return df.select(F.col("PROBATE_CASE_NUMBER").alias("case_number"), F.col("HCAD_ACCOUNT_ID").alias("account"), F.col("SOURCE_FILENAME").alias("source"), F.col("HCAD_LOT_SQFT_TOTAL").alias("lot"), F.get_json_object("RAW_RECORD", "$.hcad_owner_full_name").alias("owner"), F.get_json_object("RAW_RECORD", "$.hcad_site_address").alias("site"))


@query("STR15 SC18 SC19 FLT09 PRJ03 STR20", f"WITH {SCORED_SQL} SELECT lead_id, property_state_raw, mailing_state_raw, property_state, mailing_state, mailing_location_type FROM located")
def lead_states(spark, sf_dir):
    return rules.locate(staged(spark, sf_dir)).select("lead_id", "property_state_raw", "mailing_state_raw", "property_state", "mailing_state", "mailing_location_type")


@query("SC17 JSN03 JSN04 JSN11 NUM05 NUM10 NUM11 DAT01 STR16 STR17 FLT10 JOIN01 PRJ02", f"WITH {SCORED_SQL} SELECT lead_id, {', '.join(f'r{r}_score' for r in rules.RULES)} FROM scored")
def lead_rule_scores(spark, sf_dir):
    return scored(spark, sf_dir).select("lead_id", *[f"r{r}_score" for r in rules.RULES])


@query("SC17 SC20 SC21 SC22 SC23 AGG15 JSN04 JSN05 JSN06", f"""
WITH {SCORED_SQL} SELECT lead_id, r_score_acquisition, array_to_string(reasoning_array, ' | ') AS reasons, array_to_string(sure, ' | ') AS confidence, has_data_contradiction FROM scored""")  # fmt: skip
def lead_scores(spark, sf_dir):
    """Scores with their reasons, confidence and contradictions."""
    sure = F.array_join(F.transform("confidence_summary_array", lambda x: F.concat(x["tag"], F.lit(":"), x["confidence"].cast("string"), F.lit(":"), x["reason"])), " | ")
    return scored(spark, sf_dir).select("lead_id", "r_score_acquisition", F.array_join("reasoning_array", " | ").alias("reasons"), sure.alias("confidence"), "has_data_contradiction")
