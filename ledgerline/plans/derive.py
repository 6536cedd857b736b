"""Leads, deeds and properties derived from the benchmark tables, with awkward values at fixed steps.

The texts here are plain SQL that Spark and DuckDB read alike; operators and their SQL twins start from them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources import files

AS_OF = "1999-06-01"
LASTS = ["DOE", "SMITH", "O-TEST", "GARCIA", "EXAMPLE", "TEST-CASE", "LEE", "SAMPLE", "DOE JR.", "DOE  V", "PLACEHOLDER", "SPECIMEN", "ROBINSON"]
FIRSTS = ["JANE", "JOHN", "WILLIAM Q", "ELIZABETH", "BOB", "KATE", "ANY", "JON", "PAT"]
TYPES = ["APPLICATION FOR PROBATE", "INDEPENDENT ADMINISTRATION", "ANCILLARY ADMINISTRATION", "DEPENDENT ADMINISTRATION", "MUNIMENT OF TITLE", "PROBATE OF WILL (INDEPENDENT)", "OTHER", "WILL DEPOSIT"]
SUBTYPES = ["Small Estate Affidavit", "HEIRSHIP", "With Will Annexed", "", "Independent Administration", "Muniment", "Guardianship"]
INSTRUMENTS = ["W/D", "DEED", "SPECIAL WARRANTY DEED", "EXECUTOR~S DEED", "AFFT", "QUITCLAIM DEED", "GIFT DEED", "TRUSTEE~S DEED", "QCD", "d/t", "RELEASE OF LIEN", "MODIF", "NOTICE"]
STATES = ["TX", "OK", "LA", "CA", "NY", "ZZ", "CT", "TX", "NM", "BC"]
SUBDIVISIONS = ["TEST ACRES", "SAMPLE OAKS", "EXAMPLE PARK", "MOCK HILLS", "DUMMY CREEK"]


def pick(items: list[str], number: str) -> str:
    return f"replace(split_part('{'^'.join(items)}', '^', CAST(({number}) % {len(items)} AS int) + 1), '~', chr(39))"


def address(kind: str, number: str, state: str) -> str:
    no = f"CAST(1 + {number} % 900 AS string)"
    return f"""CASE CAST(({kind}) % 10 AS int)
        WHEN 0 THEN {no} || ' MAIN ST, HOUSTON, ' || {state} || ' 77001'
        WHEN 1 THEN {no} || ' OAK DR HOUSTON ' || {state} || ' 77002-1234'
        WHEN 2 THEN {no} || ' ELM STREET CITY ' || {state}
        WHEN 3 THEN {no} || ' MAIN ST 12345'
        WHEN 4 THEN {no} || ' A ST CITY CT 06001'
        WHEN 5 THEN {no} || ' A ST, CITY, CT 06001'
        WHEN 6 THEN 'P.O. BOX ' || {no} || ' CITY ' || {state} || ' 00000 99999'
        WHEN 7 THEN ''
        WHEN 8 THEN lower({no} || ' Pine Ln Apt 3, city, ' || {state} || ' 70001')
        ELSE NULL END"""


LEADS = f"""
SELECT k AS lead_id,
    CASE WHEN k % 97 = 0 THEN '' ELSE 'PC-' || lpad(CAST(k AS string), 9, '0') END AS probate_lead_case_number,
    CASE WHEN k % 41 = 0 THEN NULL WHEN k % 53 = 0 THEN '13/45/2020' ELSE CAST(CAST(o_orderdate AS date) AS string) END AS probate_lead_filing_date,
    CASE WHEN k % 37 = 0 THEN NULL ELSE {pick(LASTS, 'c')} END AS probate_lead_decedent_last,
    CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN '' ELSE {pick(FIRSTS, 'k')} END AS probate_lead_decedent_first,
    CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Closed' END AS probate_lead_status,
    {pick(TYPES, 'k')} AS probate_lead_type_desc,
    {pick(SUBTYPES, 'k * 7 + 3')} AS probate_lead_subtype,
    CASE WHEN k % 23 = 0 THEN NULL ELSE {pick(INSTRUMENTS, 'k + c')} END AS rp_instrument_type,
    CASE WHEN k % 5 = 0 THEN {pick(LASTS, 'c')} || ' ' || {pick(FIRSTS, 'k')} WHEN k % 5 = 1 THEN {pick(FIRSTS, 'k')} || ' ' || {pick(LASTS, 'c')}
        WHEN k % 5 = 2 THEN {pick(LASTS, 'k')} || ' ' || {pick(FIRSTS, 'c')} WHEN k % 5 = 3 THEN 'ACME HOLDINGS LLC' ELSE NULL END AS hcad_owner_full_name,
    CASE WHEN k % 61 = 0 THEN NULL ELSE lpad(CAST(k * 13 AS string), 13, '0') END AS hcad_account,
    {address('k', 'c', "'TX'")} AS hcad_site_address,
    {address('k + c', 'k', pick(STATES, 'n'))} AS hctax_owner_mailing_address,
    {address('k + n', 'k', pick(STATES, 'n + 1'))} AS hcad_mailing_address,
    CASE CAST(k % 5 AS int) WHEN 0 THEN 'HS' WHEN 1 THEN 'Homestead' WHEN 2 THEN 'ov65-hs' WHEN 3 THEN '' ELSE NULL END AS exemption_code,
    CASE CAST(k % 7 AS int) WHEN 0 THEN '0' WHEN 1 THEN '12.4' WHEN 2 THEN '0.4' WHEN 3 THEN '0.5' WHEN 4 THEN 'n/a' WHEN 5 THEN NULL ELSE '250' END AS prior_years_taxes_due,
    {pick(['GOOD', 'Poor', 'UNSOUND', 'AVERAGE'], 'k')} AS hcad_physical_condition,
    {pick(['A', 'C-', 'B+', 'D', '3'], 'c')} AS hcad_grade_adjustment,
    CASE WHEN k % 11 = 0 THEN '0' ELSE CAST(CAST(floor(o_totalprice / 10.0) AS bigint) AS string) END AS hcad_land_market_value,
    CASE WHEN k % 13 = 0 THEN '-' ELSE CAST(CAST(floor(o_totalprice / 5.0) - c * 7 AS bigint) AS string) END AS hcad_market_value_detail,
    CAST(k % 4 AS string) || '.5' AS hcad_bedrooms,
    CASE WHEN k % 6 = 0 THEN '0' ELSE CAST(900 + k % 2000 AS string) END AS hcad_total_base_sqft,
    CASE WHEN k % 9 = 0 THEN 'none' ELSE CAST(5000 + k % 5001 AS string) || '.5' END AS hcad_lot_sqft_total,
    CASE WHEN k % 3 = 0 THEN '0' ELSE CAST(k % 600 AS string) END AS hcad_garage_sqft,
    CAST(k % 3 AS string) AS hcad_land_line_count,
    {pick(['BRICK', 'Brick Garage', 'WOOD'], 'k')} AS hcad_exterior_wall,
    {pick(['SLAB', 'garage slab'], 'c')} AS hcad_foundation_type,
    CASE WHEN k % 3 = 0 THEN '{{"year_built":"' || CAST(1900 + k % 120 AS string) || '"}}' WHEN k % 3 = 1 THEN '[{{"type":"BASE AREA","area":100}}]' ELSE 'no document' END AS hcad_building_data_json,
    CASE WHEN k % 2 = 0 THEN 'true' WHEN k % 3 = 0 THEN '0' WHEN k % 5 = 0 THEN 'maybe' ELSE 'False' END AS needs_review_flag,
    CASE WHEN k % 4 = 0 THEN '85.5' WHEN k % 4 = 1 THEN '-2.5' WHEN k % 4 = 2 THEN 'C-' ELSE '61.49' END AS match_score_total,
    {pick(SUBDIVISIONS, 'k + c')} AS rp_legal_description_text,
    CASE WHEN (k + c) % 4 = 0 THEN '' ELSE CAST((k + c) % 30 AS string) END AS rp_legal_block,
    CASE CAST((k + c) % 6 AS int) WHEN 0 THEN '' WHEN 1 THEN '5.0' WHEN 2 THEN '6-8' WHEN 3 THEN '10A' WHEN 4 THEN '5,6,7' ELSE CAST(k % 40 AS string) END AS rp_legal_lot,
    CASE WHEN (k + c) % 5 = 0 THEN CAST(k % 9 AS string) WHEN k % 7 = 0 THEN 'nan' ELSE NULL END AS rp_legal_sec,
    CASE WHEN (k + c) % 8 = 0 THEN CAST(k % 12 AS string) ELSE '' END AS rp_legal_tract,
    k, c, n
FROM (SELECT o_orderkey AS k, o_custkey AS c, CAST(c_nationkey AS bigint) AS n, o_orderdate, o_orderstatus, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey) t
"""

DEEDS = f"""
SELECT l_orderkey AS lead_id, l_linenumber AS line, 'RP-' || CAST(l_orderkey AS string) || '-' || CAST(l_linenumber AS string) AS rp_file_number,
    CAST(l_shipdate AS date) AS rp_file_date,
    {pick(INSTRUMENTS, 'l_partkey')} AS rp_instrument_type,
    {pick(['Grantor', 'Grantee', 'Trustee', 'grantor '], 'l_partkey + l_linenumber')} AS rp_party_type,
    CASE WHEN l_partkey % 3 = 0 THEN {pick(LASTS, 'o_custkey')} WHEN l_partkey % 19 = 0 THEN NULL ELSE {pick(LASTS, 'l_suppkey')} END AS party_last,
    CASE WHEN l_partkey % 4 = 0 THEN {pick(FIRSTS, 'l_orderkey')} WHEN l_partkey % 17 = 0 THEN '' ELSE {pick(FIRSTS, 'l_suppkey')} END AS party_first,
    {pick(['TIER_1_EXACT_STD', 'TIER_2_NICK_BOB', 'TIER_3_RARE_LN_ONLY', 'MANUAL'], 'l_suppkey')} AS rp_search_tier,
    CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE {pick(SUBDIVISIONS, 'l_partkey')} END AS legal_text,
    CASE WHEN l_quantity < 10 THEN '' WHEN l_quantity < 20 THEN CAST(l_linenumber AS string) || '-' || CAST(l_linenumber + 2 AS string) WHEN l_quantity < 30 THEN '8-6' WHEN l_quantity < 40 THEN '5, 6,7' ELSE '5 & 6' END AS lot,
    CASE WHEN l_partkey % 2 = 0 THEN '' ELSE CAST(l_suppkey AS string) END AS block,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, o_custkey, CAST(o_orderdate AS date) AS filing_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

#: Deeds with the person of their lead: what is linked.
PAIRS = f"""
SELECT d.*, {pick(LASTS, 'o_custkey')} AS decedent_last, {pick(FIRSTS, 'd.lead_id')} AS decedent_first FROM ({DEEDS}) d
"""

PROPERTIES = f"""
SELECT p_partkey AS property_id, CAST(p_partkey * 7 AS string) AS account,
    'LT ' || CAST(p_size AS string) || ' BLK ' || CAST(p_partkey % 30 AS string) || ' ' || {pick(SUBDIVISIONS, 'p_partkey')} || CASE WHEN p_partkey % 3 = 0 THEN ' SEC ' || CAST(p_partkey % 9 AS string) ELSE '' END AS legal_text,
    CASE WHEN p_partkey % 4 = 0 THEN 'ACME HOLDINGS LLC' ELSE {pick(LASTS, 'p_partkey')} || ' ' || {pick(FIRSTS, 'p_size')} END AS owner_name
FROM part
"""


_ONCE: dict[tuple[str, str, str], tuple[int, object]] = {}


def stamp(spark: SparkSession, sf_dir: str) -> int:
    """A number for the files below a folder: their names, sizes and times."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    own = []
    while found.hasNext():
        f = found.next()
        own.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(own)))


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """What is made of a folder's tables, made once an application, and again where their files have changed since."""
    key, now = (spark.sparkContext.applicationId, sf_dir, name), stamp(spark, sf_dir)
    if key not in _ONCE or _ONCE[key][0] != now:
        _ONCE[key] = now, build()
    return _ONCE[key][1]


def saved(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A relation as a table: written once, as once(), read by all that builds on it."""

    def write() -> str:
        path = f"{files.scratch(spark)}/{name}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        files.goes(spark, path)
        return path

    return spark.read.parquet(once(spark, sf_dir, name, write))


def views(spark: SparkSession, sf_dir: str, merged: tuple[str, ...] = ()) -> None:
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (table.hint("merge") if name in merged else table).createOrReplaceTempView(name)


def relation(spark: SparkSession, sf_dir: str, sql: str, merged: tuple[str, ...] = ()) -> DataFrame:
    """merged: tables that are joined by merges, as the driver should not hold them to broadcast them."""
    views(spark, sf_dir, merged)
    return spark.sql(sql)
