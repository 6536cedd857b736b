"""Records, files, pages, metadata and checks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import catalog, discovery, quality, relational, running
from ledgerline.sources import files, html, markup

from . import derive
from .leads_q import SCORED_SQL, packed, scored
from .registry import query

C = F.col


@query("JSN08 JOIN09 AGG11 SRC10", f"WITH b AS ({derive.LEADS}) SELECT DISTINCT unnest(json_keys(to_json(b))) AS column_name FROM (SELECT * FROM b LIMIT 1) b")
def json_keys(spark, sf_dir):
    return discovery.keys(packed(spark, sf_dir))


@query("JSN08 AGG11", "SELECT DISTINCT unnest(json_keys(props)) AS column_name FROM events")
def event_keys(spark, sf_dir):
    return discovery.keys(spark.read.parquet(f"{sf_dir}/events.parquet"), "props")


@query("SET01", f"WITH b AS ({derive.LEADS}) SELECT DISTINCT unnest(json_keys(to_json(b))) AS column_name FROM (SELECT * FROM b LIMIT 1) b EXCEPT SELECT * FROM (VALUES {', '.join(f'({c!r})' for c in schemas.STAGED)}) t(column_name)")
def new_json_keys(spark, sf_dir):
    known = spark.createDataFrame([(c,) for c in schemas.STAGED], "column_name string")
    return discovery.new_keys(discovery.keys(packed(spark, sf_dir)), known)


SOURCE = "SELECT DISTINCT upper(p_type) AS column_name, CASE WHEN length(p_type) % 2 = 0 THEN '' ELSE 'kind ' || p_type END AS description, length(p_type) % 3 <> 0 AS is_nullable, CASE WHEN length(p_type) % 2 = 1 THEN '[''unique'']' END AS custom FROM part"
SOURCE = SOURCE.replace("'[''unique'']'", "'[' || chr(39) || 'unique' || chr(39) || ']'")
EXISTING = "SELECT DISTINCT lower(p_type) AS column_name, 'old ' || lower(p_type) AS description FROM part WHERE length(p_type) % 4 <> 1 UNION ALL SELECT 'only_old', 'kept text'"


@query("JOIN10 SET06 SRC12 DQ04 JSN12 SNK08", f"""WITH s AS ({SOURCE}), e AS ({EXISTING}), j AS (SELECT lower(coalesce(s.column_name, e.column_name)) AS k, s.column_name AS sn, e.column_name AS en, s.description AS sd, e.description AS ed, is_nullable, custom FROM s FULL JOIN e ON lower(s.column_name) = lower(e.column_name))
SELECT k, coalesce(en, sn) AS column_name, CASE WHEN sn IS NULL THEN ed ELSE coalesce(nullif(sd, ''), ed, '') END AS description, CASE WHEN sn IS NULL THEN 'old' ELSE array_to_string(list_filter([CASE WHEN NOT is_nullable THEN 'not_null' END, CASE WHEN custom IS NOT NULL THEN 'unique' END], lambda z: z IS NOT NULL), ',') END AS tests,
    CASE WHEN en IS NULL THEN 'added' WHEN sn IS NULL THEN 'kept' ELSE 'merged' END AS origin FROM j""")  # fmt: skip
def merged_metadata(spark, sf_dir):
    source = derive.relation(spark, sf_dir, SOURCE).withColumn("custom_tests", discovery.read_tests(C("custom")))
    existing = derive.relation(spark, sf_dir, EXISTING).withColumn("tests", F.array(F.lit("old")))
    return discovery.merge(source, existing).withColumn("tests", F.array_join("tests", ","))


CHECKED = ["has_data_contradiction", "reasoning_array", "r_score_acquisition"]


@query("DQ01", f"WITH {SCORED_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count_if({c} IS NULL)::BIGINT AS failures FROM scored" for c in CHECKED))
def check_not_null(spark, sf_dir):
    return quality.nulls(scored(spark, sf_dir), CHECKED)


@query("DQ02", f"WITH {SCORED_SQL} SELECT mailing_state_raw AS value, count(*) AS failures FROM scored WHERE mailing_state_raw NOT IN ({', '.join(repr(x) for x in derive.STATES)}) GROUP BY 1")
def check_accepted(spark, sf_dir):
    return quality.not_accepted(scored(spark, sf_dir), "mailing_state_raw", derive.STATES)


@query("DQ03 FLT12", f"WITH b AS ({derive.LEADS}) SELECT lead_id FROM b WHERE coalesce(probate_lead_case_number, '') = '' OR coalesce(hcad_account, '') = ''")
def check_required_keys(spark, sf_dir):
    raw = packed(spark, sf_dir)
    key = lambda k: F.get_json_object("RAW_RECORD", f"$.{k}")
    return quality.without(raw, [key("probate_lead_case_number"), key("hcad_account")]).select(key("lead_id").cast("bigint").alias("lead_id"))


@query("DQ04", "SELECT 'p_name' AS column_name, 'unique' AS test, count(p_name) - count(DISTINCT p_name) AS failures FROM part UNION ALL SELECT 'p_partkey', 'unique', count(p_partkey) - count(DISTINCT p_partkey) FROM part UNION ALL SELECT 'p_size', 'not_null', count_if(p_size IS NULL)::BIGINT FROM part")
def check_from_metadata(spark, sf_dir):
    return quality.run(spark.read.parquet(f"{sf_dir}/part.parquet"), [("p_name", "unique"), ("p_partkey", "unique"), ("p_size", "not_null")])


INCOMING = "SELECT CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'x-' || CAST(o_orderkey AS string) ELSE CAST(o_orderkey - o_orderkey % 5 AS string) END AS o_orderkey, CAST(o_custkey AS string) AS O_CUSTKEY, CASE WHEN o_orderkey % 31 = 0 THEN '?' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS string) END AS o_totalprice, o_orderpriority AS surplus FROM orders"
_COUNT = lambda column, test, n: f"SELECT '{column}' AS column_name, '{test}' AS test, {n}::BIGINT AS failures FROM i"


@query("SRC12 DQ04 DQ05", f"WITH i AS ({INCOMING}) " + " UNION ALL ".join([
    _COUNT("o_orderkey", "type", "count(*) FILTER (o_orderkey LIKE 'x%')"), _COUNT("o_orderkey", "not_null", "count(*) - count(o_orderkey)"), _COUNT("o_orderkey", "unique", "count(o_orderkey) - count(DISTINCT o_orderkey)"),
    _COUNT("O_CUSTKEY", "type", "0 * count(*)"), _COUNT("O_CUSTKEY", "not_null", "count(*) - count(O_CUSTKEY)"), _COUNT("o_orderstatus", "type", "0 * count(*)"), _COUNT("o_orderstatus", "accepted", "count(*) FILTER (o_orderstatus = '?')"),
    _COUNT("o_totalprice", "type", "count(*) FILTER (o_totalprice = 'n/a')"), _COUNT("o_clerk", "present", "count(*)"), _COUNT("surplus", "known", "count(*)"), "SELECT 'o_orderkey', 'loaded', count(*) FILTER (o_orderkey NOT LIKE 'x%') FROM i",
]))
def check_against_catalog(spark, sf_dir):
    """Texts are loaded into a table that the catalog describes; what breaks its description is counted by the load itself."""
    name = f"orders_{uuid.uuid4().hex}"
    path = f"{files.scratch(spark)}/{name}"
    files.goes(spark, path)
    tests = {"o_orderkey": ["not_null", "unique"], "o_custkey": ["not_null"], "o_orderstatus": ["accepted:F,O,P"]}
    listed = ", ".join(f"""'tests.{c}' = "{t}" """ for c, t in tests.items())
    spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT COMMENT 'number', o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_clerk STRING) USING parquet LOCATION '{path}' TBLPROPERTIES ({listed})")
    found = catalog.load(derive.relation(spark, sf_dir, INCOMING), name)
    loaded = spark.table(name).agg(F.count("o_orderkey").alias("failures")).select(F.lit("o_orderkey").alias("column_name"), F.lit("loaded").alias("test"), "failures")
    return found.unionByName(loaded)


ESSENTIAL = "(VALUES ('probate_lead_decedent_first'), ('probate_lead_decedent_last'), ('rp_party_type'), ('rp_file_number'), ('is_potential_decedent_match')) t(missing)"


@query("DQ05 DQ06", f"SELECT missing FROM {ESSENTIAL} WHERE missing NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM ({derive.LEADS}) z))")
def check_columns(spark, sf_dir):
    df = derive.relation(spark, sf_dir, derive.LEADS)
    assert not quality.wrong_delimiter(df)
    return spark.createDataFrame([(c,) for c in quality.missing_columns(df, schemas.ESSENTIAL)], "missing string")


_ZONES = ", ".join(f"('{z}', {k}, '{c}')" for z, cs in schemas.ZONES.items() for k, c in enumerate(cs))


@query("PRJ04 SNK05", f"""WITH d AS (SELECT column_name, row_number() OVER () AS pos FROM (DESCRIBE SELECT * FROM ({derive.LEADS}) y)), z AS (SELECT * FROM (VALUES {_ZONES}) t(zone, place, column_name))
SELECT zone, place::INTEGER AS place, column_name FROM z JOIN d USING (column_name) UNION ALL SELECT '7 Other', (row_number() OVER (ORDER BY pos) - 1)::INTEGER, column_name FROM d WHERE column_name NOT IN (SELECT column_name FROM z)""")  # fmt: skip
def column_zones(spark, sf_dir):
    """Zones of a report's columns; also the order that ordered() puts them in."""
    leads = derive.relation(spark, sf_dir, derive.LEADS)
    order = [c for cs in schemas.ZONES.values() for c in cs]
    assert relational.ordered(leads, order).columns == [c for _, _, c in relational.zones(leads.columns, schemas.ZONES)]
    return spark.createDataFrame(relational.zones(leads.columns, schemas.ZONES), "zone string, place int, column_name string")


@query("PRJ05 PRJ07 PRJ08 NUM09 FLT02 FLT03 FLT06 FLT07", f"""WITH b AS ({derive.LEADS}) SELECT lead_id, coalesce(TRY_CAST(match_score_total AS DOUBLE), 0) AS match_score_total, 0::DOUBLE AS rp_signal_strength, NULL::VARCHAR AS hcad_search_status FROM b
WHERE coalesce(TRY_CAST(match_score_total AS DOUBLE), 0) >= 3 AND coalesce(probate_lead_decedent_last, '') <> '' AND TRY_CAST(probate_lead_filing_date AS DATE) IS NOT NULL""")  # fmt: skip
def defaulted_leads(spark, sf_dir):
    df = relational.ensure_columns(derive.relation(spark, sf_dir, derive.LEADS), {"rp_signal_strength": ("double", 0), "hcad_search_status": ("string", None), "match_score_total": ("string", "9")})
    df = relational.zeroed(df, ["match_score_total", "rp_signal_strength"]).filter("match_score_total >= 3")
    dated = F.try_to_timestamp("probate_lead_filing_date", F.lit("yyyy-MM-dd")).isNotNull()
    return df.filter((F.coalesce("probate_lead_decedent_last", F.lit("")) != "") & dated).select("lead_id", "match_score_total", "rp_signal_strength", "hcad_search_status")


LAND = "SELECT l_orderkey AS id, l_linenumber AS ord, CASE WHEN l_partkey % 3 = 0 THEN 'AC' ELSE 'SF' END AS unit_type, l_quantity AS units, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE floor(l_extendedprice) END AS market_value, CASE CAST(l_suppkey % 3 AS int) WHEN 0 THEN 'BASE AREA PRI' WHEN 1 THEN 'Garage, detached' ELSE 'PORCH' END AS kind, CAST(l_quantity AS int) AS area FROM lineitem"


@query("AGG09 SRC19 SRC20 SRC22", f"""WITH l AS ({LAND}) SELECT id, coalesce(sum(units) FILTER (unit_type = 'SF'), 0)::DOUBLE AS lot_sqft, coalesce(sum(market_value), 0)::DOUBLE AS land_value, count(*)::INTEGER AS lines, coalesce(sum(area) FILTER (kind LIKE 'BASE%'), 0)::BIGINT AS base, sum(area)::BIGINT AS structure, coalesce(sum(area) FILTER (kind LIKE 'Garage%'), 0)::BIGINT AS garage FROM l GROUP BY id""")
def nested_totals(spark, sf_dir):
    """Totals over arrays of rows within a record."""
    rows = derive.relation(spark, sf_dir, LAND)
    own = rows.groupBy("id").agg(F.collect_list(F.struct("unit_type", "units", "market_value")).alias("land"), F.collect_list(F.struct(C("kind").alias("type"), "area")).alias("building"))
    land, area = relational.land_totals(C("land")), relational.area_totals(C("building"))
    return own.select("id", land["lot_sqft"].alias("lot_sqft"), land["land_value"].alias("land_value"), land["lines"].alias("lines"), area["base"].alias("base"), area["structure"].alias("structure"), area["garage"].alias("garage"))


# Pages are built here; their twins take them apart again, with lists and patterns of their own.
KEYED = "SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '<tr><td>Grade Adjustment</td><td>' || p_brand || '</td></tr>' END || '<tr><td>Room Count:</td><td>' || CAST(p_size AS string) || '</td></tr>' || CASE WHEN p_partkey % 3 = 0 THEN '<tr><td>Heating / AC</td><td>' || p_type || '</td></tr>' WHEN p_partkey % 3 = 1 THEN '<tr><td> room  count </td><td>last</td></tr>' ELSE '' END AS h FROM part"
_KEY = "regexp_replace(regexp_replace(trim(regexp_replace(lower({x}), '[:()]', '', 'g')), '[\\s/\\-]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query("SRC21", f"""WITH r AS ({KEYED}), k AS (SELECT id, list_transform(regexp_extract_all(h, '<td>([^<]*)</td><td>([^<]*)</td>', 1), lambda x: {_KEY.replace('{x}', 'x')}) AS ks, regexp_extract_all(h, '<td>([^<]*)</td><td>([^<]*)</td>', 2) AS vs FROM r),
p AS (SELECT id, i, ks[i] AS k, vs[i] AS v FROM k, unnest(range(1, len(ks) + 1)) t(i)), f AS (SELECT id, k, min(i) AS pos, arg_max(trim(v), i) AS v FROM p GROUP BY id, k)
SELECT id, max(v) FILTER (k = 'grade_adjustment') AS grade, '{{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY pos) FILTER (k <> 'grade_adjustment') || '}}' AS other FROM f GROUP BY id""")  # fmt: skip
def known_and_other(spark, sf_dir):
    s = relational.split_known(html.characteristics(C("h")), ["grade_adjustment"])
    return derive.relation(spark, sf_dir, KEYED).select("id", s["known"]["grade_adjustment"].alias("grade"), s["other"].alias("other"))


YEARS = "SELECT p_partkey AS id, '<tr><th>' || CASE WHEN p_partkey % 2 = 0 THEN 'Building</th><th>Year Built' WHEN p_partkey % 5 = 1 THEN 'Kind</th><th>Size' ELSE ' YEAR BUILT </th><th>Kind' END || '</th></tr><tr><td>' || CAST(p_partkey % 9 AS string) || '</td><td>' || CAST(p_size AS string) || '</td></tr><tr><td>' || p_brand || '</td><td>' || p_name || '</td></tr>' AS h FROM part"


@query("SRC20", f"""WITH r AS ({YEARS}), s AS (SELECT id, coalesce(list_position(list_transform(regexp_extract_all(h, '<th>([^<]*)</th>', 1), lambda x: lower(trim(x))), 'year built'), 0) AS pos, list_filter(string_split(h, '<tr>'), lambda x: contains(x, '<td>')) AS trs FROM r)
SELECT id, CASE WHEN pos = 0 THEN '' ELSE array_to_string(list_transform(trs, lambda x: trim(regexp_extract_all(x, '<td>([^<]*)</td>', 1)[pos])), ',') END AS years FROM s""")  # fmt: skip
def column_under_header(spark, sf_dir):
    return derive.relation(spark, sf_dir, YEARS).select("id", F.array_join(html.column_under(C("h"), "year built"), ",").alias("years"))


GRID = "SELECT l_orderkey AS page, l_linenumber * 1000 + l_suppkey AS place, l_linenumber % 3 = 1 AS is_main, l_partkey AS cell FROM lineitem"


@query("SRC15 WIN04", f"WITH g AS (SELECT DISTINCT * FROM ({GRID}) z) SELECT page, place, cell, sum(CASE WHEN is_main THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY place, cell ROWS UNBOUNDED PRECEDING)::BIGINT AS group_no FROM g")
def grid_groups(spark, sf_dir):
    g = derive.relation(spark, sf_dir, GRID).distinct().withColumn("at", F.struct("place", "cell"))
    return relational.groups_of_followers(g, "page", "at", C("is_main")).select("page", "place", "cell", "group_no")


@query("SRC15 WIN04", "SELECT l_orderkey AS id, l_linenumber AS line, sum(CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END) OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey ROWS UNBOUNDED PRECEDING)::BIGINT AS group_no, lag(l_suppkey) OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) AS before FROM lineitem")
def one_page_groups(spark, sf_dir):
    """All lines on one page: groups and the row before, no task with more than its part of the page."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.lit(1).alias("page"), C("l_orderkey").alias("id"), C("l_linenumber").alias("line"), "l_partkey", "l_suppkey")
    out = running.running(rows, ["page"], ["id", "line", "l_suppkey", "l_partkey"], {"group_no": running.Sum(F.when(C("l_partkey") % 11 == 0, 1).otherwise(0)), "before": running.Before(C("l_suppkey"))})
    return out.select("id", "line", "group_no", "before")


GRID_PAGES = "SELECT p_partkey AS id, '<table><tr><td>' || CASE WHEN p_partkey % 3 = 0 THEN 'RP-1</td><td>2<td>3' WHEN p_partkey % 3 = 1 THEN 'x</td><td>RM-' || CAST(p_size AS string) || '</td><td>3' ELSE 'x</td><td>2</td><td>XRP-3' END || '</td><td>4</td>' || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '<td>' || p_brand || '</td>' END || '</tr><tr><td>' || p_name || '</td></tr></table>' AS h FROM part"


@query("SRC15 UDF10", f"""WITH r AS ({GRID_PAGES}), t AS (SELECT id, regexp_extract_all(h, '<tr>(.*?)</tr>', 1) AS trs FROM r), c AS (SELECT id, i - 1 AS row_no, list_transform(string_split(trs[i], '<td>')[2:], lambda x: trim(replace(x, '</td>', ''))) AS cs FROM t, unnest(range(1, len(trs) + 1)) u(i))
SELECT id, row_no::INTEGER AS row_no, cs[1] AS first_cell, len(cs) >= 5 AND len(list_filter(cs[1:3], lambda x: regexp_matches(x, '^(RP-|RM-|RT-)'))) > 0 AS is_main, len(cs)::INTEGER AS n FROM c""")  # fmt: skip
def grid_rows(spark, sf_dir):
    g = html.grid_rows(derive.relation(spark, sf_dir, GRID_PAGES), "h")
    return g.select("id", "row_no", F.get("cells", 0).alias("first_cell"), "is_main", F.size("cells").alias("n"))


RESULT_PAGES = "SELECT p_partkey AS id, '<tr><td><a href=\"/d?' || CASE WHEN p_partkey % 5 = 0 THEN 'q=' ELSE 'acct=' END || CAST(p_partkey * 3 AS string) || '\">' || CAST(p_partkey AS string) || '</a></td><td>' || p_name || '</td><td>a</td><td>z</td><td>1,200</td><td>' || CASE WHEN p_partkey % 4 = 0 THEN 'Pending' ELSE '$' || CAST(p_retailprice AS string) END || '</td>' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '<td>Pending</td>' END || '</tr>' AS h FROM part"


@query("SRC17 STR26", f"""WITH r AS ({RESULT_PAGES}), c AS (SELECT id, h, list_transform(string_split(h, '<td>')[2:], lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'))) AS cs FROM r)
SELECT id, cs[1] AS account, cs[2] AS owner, TRY_CAST(translate(cs[6], '$,', '') AS DOUBLE) AS value, nullif(regexp_extract(h, 'acct=(\\d+)', 1), '') AS linked FROM c WHERE len(cs) >= 7""")  # fmt: skip
def candidate_pages(spark, sf_dir):
    c = html.candidates(derive.relation(spark, sf_dir, RESULT_PAGES), "h")
    return c.select("id", C("hcad_account_summary").alias("account"), C("hcad_owner_summary").alias("owner"), C("hcad_market_value_summary").alias("value"), C("hcad_account_url").alias("linked"))


HEADED = "SELECT p_partkey AS id, '<table><tr>' || CASE WHEN p_partkey % 3 = 0 THEN '<th>Case</th><th>Party</th><th>Status</th>' WHEN p_partkey % 3 = 1 THEN '<th>STATUS</th><th>Case</th><th>party</th>' ELSE '<th>Case</th><th>Party</th>' END || '</tr><tr><td>' || CAST(p_size AS string) || '</td><td>' || p_name || '</td>' || CASE WHEN p_partkey % 2 = 0 THEN '<td>' || p_brand || '</td>' ELSE '' END || '</tr></table>' AS h FROM part"
_AT = lambda name: f"coalesce(cs[nullif(coalesce(list_position(hs, '{name}'), 0), 0)], '')"


@query("SRC14", f"""WITH r AS ({HEADED}), c AS (SELECT id, list_transform(regexp_extract_all(h, '<th>([^<]*)</th>', 1), lambda x: lower(x)) AS hs, regexp_extract_all(h, '<td>([^<]*)</td>', 1) AS cs FROM r)
SELECT id, {_AT('party')} AS party, {_AT('status')} AS status FROM c""")  # fmt: skip
def table_rows(spark, sf_dir):
    """Cells under the headers asked for, short rows filled."""
    return html.rows_by_header(derive.relation(spark, sf_dir, HEADED), "h", ["Party", "Status"]).select("id", C("Party").alias("party"), C("Status").alias("status"))


_TEXT = r"regexp_replace(regexp_replace({x}, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _name, _c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
    _TEXT = f"replace({_TEXT}, '{_name}', '{_c}')"
_TEXT = f"trim(regexp_replace({_TEXT}, '\\s+', ' ', 'g'))"
_LINK = r"""'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'"""


@query("SRC14 UDF10", f"""WITH l AS (SELECT page_id, regexp_extract_all(html, {_LINK}, 1) AS hs, regexp_extract_all(html, {_LINK}, 2) AS ts FROM pages)
SELECT page_id, (i - 1)::INTEGER AS place, hs[i] AS href, {_TEXT.replace('{x}', 'ts[i]')} AS text FROM l, unnest(range(1, len(hs) + 1)) u(i)""")  # fmt: skip
def page_links(spark, sf_dir):
    """Links of saved pages, which are not well formed."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.posexplode(html.links(C("html"))).alias("place", "l")).select("page_id", "place", "l.href", "l.text")


# Every page is put into a cell of an inner table, its cells not closed and a > in an attribute; the twin knows the cells, and takes the page's text with patterns.
_ASK = "'<table border=\"0\" title=\"a > b\"><tr><th>Page</th><th>Link</th></tr><tr><td>' || CAST(page_id AS string) || '<td data-x=\"</td>\"><a href=\"' || url || '\">here</a> <TABLE><tr><td>Url<td>' || replace(url, '/', ' / ') || '<tr><td colspan=2>' || coalesce(html, '') || '</table>after</tr><tr><td>last</table>'"
_OWN = r"regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'), '(?i)</?(a|b|i)(\s[^>]*)?>', '', 'g')"
NESTED = f"SELECT page_id, {_ASK} AS h FROM pages"


@query("SRC14 SRC15 UDF10", f"""WITH r AS (SELECT page_id, url, replace(replace({_TEXT.replace('{x}', _OWN)}, '&copy;', '©'), '&middot;', '·') AS own FROM pages)
SELECT page_id, table_no, depth, inside_cell, row_no, n, texts, href FROM (
    SELECT page_id, 0 AS table_no, 0 AS depth, NULL::INTEGER AS inside_cell, 0 AS row_no, 2 AS n, 'Page|Link' AS texts, NULL AS href FROM r
    UNION ALL SELECT page_id, 0, 0, NULL, 1, 2, page_id::VARCHAR || '|here after', url FROM r
    UNION ALL SELECT page_id, 0, 0, NULL, 2, 1, 'last', NULL FROM r
    UNION ALL SELECT page_id, 1, 1, 1, 0, 2, 'Url|' || trim(regexp_replace(replace(url, '/', ' / '), '\\s+', ' ', 'g')), NULL FROM r
    UNION ALL SELECT page_id, 1, 1, 1, 1, 1, own, (SELECT regexp_extract(html, '<a\\s[^>]*href="([^"]*)"', 1) FROM pages p WHERE p.page_id = r.page_id) FROM r) z""")  # fmt: skip
def nested_tables(spark, sf_dir):
    """Rows of tables within tables, by the table function; all pages, whole."""
    spark.read.parquet(f"{sf_dir}/pages.parquet").createOrReplaceTempView("pages")
    rows = markup.with_rows(spark.sql(NESTED), "h")
    links = F.filter(F.transform("cells", lambda c: c["href"]), lambda x: x.isNotNull())
    return rows.select("page_id", "table_no", "depth", "inside_cell", "row_no", F.size("cells").alias("n"), F.array_join(F.transform("cells", lambda c: c["text"]), "|").alias("texts"), F.get(links, 0).alias("href"))


DETAILS = "SELECT p_partkey AS id, 'http://x/d?acct=' || CAST(p_partkey AS string) AS url, CASE WHEN p_partkey % 6 = 0 THEN '<p>no such account</p>' ELSE '<table><tr><td>Owner Full Name:</td><td>' || p_name || '</td></tr><tr><td>Bedrooms</td><td>' || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_size AS string) END || '</td></tr><tr><td>Foundation Type (main)</td><td>' || p_brand || '</td></tr><tr><td>Colour</td><td>blue</td></tr></table>' END AS h FROM part"


@query("SRC18 CTL05", f"""WITH r AS ({DETAILS}), k AS (SELECT id, url, regexp_extract_all(h, '<td>([^<]*)</td><td>([^<]*)</td>', 1) AS ks, regexp_extract_all(h, '<td>([^<]*)</td><td>([^<]*)</td>', 2) AS vs FROM r),
v AS (SELECT id, url, len(ks) AS n, list_filter(list_zip(ks, vs), lambda x: starts_with(x[1], 'Owner')) AS o, list_filter(list_zip(ks, vs), lambda x: starts_with(x[1], 'Bed')) AS b, list_filter(list_zip(ks, vs), lambda x: starts_with(x[1], 'Found')) AS f FROM k)
SELECT id, nullif(o[1][2], '') AS owner, nullif(b[1][2], '') AS bedrooms, nullif(f[1][2], '') AS foundation, url AS visited, CASE WHEN n = 0 THEN 'no labelled rows' END AS parsing_error, 32 AS n_keys,
    (CASE WHEN nullif(o[1][2], '') IS NULL THEN 0 ELSE 1 END + CASE WHEN nullif(b[1][2], '') IS NULL THEN 0 ELSE 1 END + CASE WHEN nullif(f[1][2], '') IS NULL THEN 0 ELSE 1 END + 1 + CASE WHEN n = 0 THEN 1 ELSE 0 END)::INTEGER AS n_there FROM v""")  # fmt: skip
def detail_records(spark, sf_dir):
    """Records of fixed keys from detail pages, some of which have nothing to read."""
    r = html.detail(derive.relation(spark, sf_dir, DETAILS), "h", "url")
    there = sum((F.when(C(f"record.{c}").isNotNull(), 1).otherwise(0) for c in schemas.DETAIL), F.lit(0))
    return r.select("id", C("record.hcad_owner_full_name").alias("owner"), C("record.hcad_bedrooms").alias("bedrooms"), C("record.hcad_foundation_type").alias("foundation"), C("record.hcad_detail_url_visited").alias("visited"), "record.parsing_error", F.lit(len(schemas.DETAIL)).alias("n_keys"), there.alias("n_there"))


PAGES = "SELECT o_custkey AS scan, o_orderkey AS page, o_orderkey % 3 AS first_key FROM orders"


@query("SRC16 WIN05", f"WITH p AS ({PAGES}) SELECT * FROM p QUALIFY lag(first_key) OVER (PARTITION BY scan ORDER BY page) IS DISTINCT FROM first_key")
def repeated_pages(spark, sf_dir):
    return relational.new_pages(derive.relation(spark, sf_dir, PAGES), "scan", "page", "first_key")


SCANS = "SELECT o_custkey % 500 AS scan, o_orderkey AS page, o_orderkey % 7 AS first_key, CASE WHEN o_orderkey % 5 < 2 THEN 0 ELSE CAST(o_orderkey % 9 AS int) END AS n FROM orders"


@query("SRC16", f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY page) AS nth FROM ({SCANS}) z),
w AS (SELECT scan, page, first_key, n, nth, CASE WHEN n = 0 THEN 1 ELSE 0 END AS run FROM p WHERE nth = 1
UNION ALL SELECT p.scan, p.page, p.first_key, p.n, p.nth, CASE WHEN p.n = 0 THEN w.run + 1 ELSE 0 END FROM w JOIN p ON p.scan = w.scan AND p.nth = w.nth + 1 WHERE p.nth <= 20 AND w.run < 2 AND NOT (p.n > 0 AND p.first_key = w.first_key))
SELECT scan, page, n FROM w""")  # fmt: skip
def pages_until_stop(spark, sf_dir):
    """Pages of scans that stop at a repeated page, at two empty ones in a row, or after twenty; the twin walks from page to page."""
    return relational.pages_read(derive.relation(spark, sf_dir, SCANS), "scan", "page", "first_key", "n", 2, 20).select("scan", "page", "n")


@query("SNK08", f"""WITH s AS ({SOURCE}), e AS ({EXISTING}), j AS (SELECT coalesce(e.column_name, s.column_name) AS name, CASE WHEN s.column_name IS NULL THEN e.description ELSE coalesce(nullif(s.description, ''), e.description, '') END AS description,
    CASE WHEN s.column_name IS NULL THEN ['old'] ELSE list_filter([CASE WHEN NOT is_nullable THEN 'not_null' END, CASE WHEN custom IS NOT NULL THEN 'unique' END], lambda z: z IS NOT NULL) END AS tests FROM s FULL JOIN e ON lower(s.column_name) = lower(e.column_name)),
l AS (SELECT name, list_concat(['      - name: "' || name || '"', '        description: "' || description || '"'], CASE WHEN len(tests) = 0 THEN [] ELSE list_concat(['        tests:'], list_transform(tests, lambda x: '          - ' || x)) END) AS ls FROM j)
SELECT unnest(list_concat(['version: 2', 'models:', '  - name: "leads"', '    columns:'], flatten(list(ls ORDER BY name)))) AS line FROM l""")  # fmt: skip
def schema_file(spark, sf_dir):
    """Lines of the schema file that a dry run would write."""
    source = derive.relation(spark, sf_dir, SOURCE).withColumn("custom_tests", discovery.read_tests(C("custom")))
    merged = discovery.merge(source, derive.relation(spark, sf_dir, EXISTING).withColumn("tests", F.array(F.lit("old"))))
    content = discovery.write_yml(discovery.yml("leads", merged), "schema.yml", dry_run=True)
    return spark.createDataFrame([(x,) for x in content.splitlines()], "line string")


def _folder(spark) -> str:
    return f"{files.scratch(spark)}/files-{uuid.uuid4().hex}"


@query("SRC01 SRC02 SRC03 SRC04 SRC05 SNK01 SNK02 SNK03 SNK04", "SELECT o_orderkey AS id, 'a;b' || chr(10) || o_orderpriority || '\"q' AS t, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'x' END AS filled, o_custkey AS n FROM orders")
def delimited_files(spark, sf_dir):
    """Fields with the delimiter, quotes and line ends in them, written and read back, both ways of quoting."""
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(C("o_orderkey").alias("id"), F.concat(F.lit("a;b\n"), "o_orderpriority", F.lit('"q')).alias("t"), F.when(C("o_orderkey") % 2 == 0, None).otherwise("x").alias("filled"), C("o_custkey").alias("n"))
    at = _folder(spark)
    files.write(df.filter("id % 2 = 0"), f"{at}/a", ";", quote_all=True)
    files.write(df.filter("id % 2 = 1"), f"{at}/b", ",")
    one = files.read(spark, f"{at}/a", ";", filled=True).select(C("id").cast("bigint").alias("id"), "t", "filled", C("n").cast("bigint").alias("n"))
    two = files.read(spark, f"{at}/b", ",", schema="id bigint, t string, filled string, n bigint")
    return one.union(two)


@query("SRC06 SRC07 SRC08 SRC09", "SELECT lower(arg_max(r_name, r_regionkey)) AS newest, count(*)::INTEGER AS n FROM region")
def newest_file(spark, sf_dir):
    """The file changed last of one a region, written in their order, samples and files of other kinds left aside."""
    at = _folder(spark)
    for r in spark.read.parquet(f"{sf_dir}/region.parquet").orderBy("r_regionkey").collect():
        files.write(spark.range(1).coalesce(1), f"{at}/{r['r_name'].lower().replace(' ', '_')}")
        time.sleep(0.05)
    spark.range(1).coalesce(1).write.json(f"{at}/later")
    path = files.newest(spark, at, "*.csv", but="_QA_SAMPLE.csv")
    n = files.listing(spark, at).count()
    return spark.createDataFrame([(path.rsplit("/", 2)[-2].replace("_", " "), n)], "newest string, n int")


@query("SRC10 SRC11 SNK06 SNK07", "SELECT n_regionkey AS region, 2 * count(*) AS n FROM nation GROUP BY 1")
def warehouse_tables(spark, sf_dir):
    """A table that is rebuilt, then appended to."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    name = f"nation_{uuid.uuid4().hex}"
    files.rebuild(nation, name)
    files.append(nation, name)
    return spark.table(name).groupBy(C("n_regionkey").alias("region")).agg(F.count("*").alias("n"))

