"""Property search, candidates, owners, contacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import legal, names
from ledgerline.functions.text import account_in
from ledgerline.operators import candidates, gramindex, owners, relational
from ledgerline.operators.pairs import Pairs
from ledgerline.sources import files

from . import derive
from .linkage_q import ratio_sql, token_set_sql
from .registry import query

C = F.col
#: Leads that search for a property, with the last name of a grantee.
SEARCHES = f"""SELECT lead_id, rp_legal_tract, rp_legal_block, rp_legal_description_text, rp_legal_sec, rp_legal_lot, {derive.pick(derive.LASTS, 'k * 3')} AS grantee_last, probate_lead_decedent_last FROM ({derive.LEADS}) z"""

N = lambda x: f"CASE WHEN upper(trim(coalesce({x}, ''))) = 'NAN' THEN '' ELSE upper(trim(coalesce({x}, ''))) END"
COMMON = "(" + ", ".join(f"'{x}'" for x in names.COMMON_SURNAMES) + ")"
_J = lambda *p: "array_to_string(list_filter([" + ", ".join(p) + "], lambda z: z IS NOT NULL), ' ')"
_L = lambda name, v: f"CASE WHEN {v} <> '' THEN '{name} ' || {v} END"
_OWNED = lambda who, text: f"CASE WHEN {who} <> '' AND s <> '' THEN CASE WHEN {who} IN {COMMON} AND b = '' AND t = '' THEN '{legal.TOO_BROAD}' ELSE {text} END END"
_COMBO = _J(_L("BLK", "b"), "s", _L("TR", "t"))
_LEGAL = [
    f"CASE WHEN x <> '' AND b <> '' AND s <> '' AND NOT contains(x, '-') AND NOT contains(x, '/') THEN 'LT ' || x || ' BLK ' || b || ' ' || s END",
    _OWNED("g", _COMBO), _OWNED("d", _COMBO),
    f"nullif({_J(_L('TR', 't'), _L('BLK', 'b'), 'CASE WHEN length(s) > 0 THEN s END', _L('SEC', 'c'))}, '')",
    f"nullif({_J(_L('TR', 't'), _L('BLK', 'b'), 'CASE WHEN length(s) > 0 THEN s END')}, '')",
    _OWNED("d", _J("s", f"coalesce({_L('BLK', 'b')}, {_L('TR', 't')})")),
    f"nullif({_J(_L('BLK', 'b'), 'CASE WHEN length(s) > 0 THEN s END')}, '')",
]
_OWNER = {1: "g", 2: "d", 5: "d"}
_UNION = " UNION ALL ".join(
    f"SELECT lead_id, {k} AS ord, '{t}' AS tier, substr({_LEGAL[k]}, 1, 100) AS legal_query, "
    + (f"CASE WHEN {_OWNER[k]} <> '' AND s <> '' AND NOT ({_OWNER[k]} IN {COMMON} AND b = '' AND t = '') THEN substr({_OWNER[k]}, 1, 26) END" if k in _OWNER else "NULL")
    + " AS owner_query, s FROM no"
    for k, t in enumerate(legal.TIERS)
)
QUERIED = f"""se AS ({SEARCHES}),
no AS (SELECT lead_id, {N('rp_legal_tract')} AS t, {N('rp_legal_block')} AS b, {N('rp_legal_description_text')} AS s, {N('rp_legal_sec')} AS c,
    CASE WHEN trim(coalesce(rp_legal_lot, '')) = '' THEN '' WHEN TRY_CAST(rp_legal_lot AS DOUBLE) = floor(TRY_CAST(rp_legal_lot AS DOUBLE)) THEN TRY_CAST(rp_legal_lot AS DOUBLE)::BIGINT::VARCHAR ELSE {N('rp_legal_lot')} END AS x, {N('grantee_last')} AS g, {N('probate_lead_decedent_last')} AS d FROM se),
qu AS ({_UNION}),
qs AS (SELECT *, CASE WHEN legal_query = '{legal.TOO_BROAD}' THEN legal_query WHEN legal_query IS NULL AND owner_query IS NULL THEN 'NO_QUERY_FORMED' ELSE 'READY' END AS query_state FROM qu)"""


def queried(spark, sf_dir, some: str = "true"):
    # Few of the leads meet all customers: by a merge, a broadcast would hold every customer at the driver.
    merged = () if some == "true" else ("customer",)
    return candidates.queries(derive.relation(spark, sf_dir, f"SELECT * FROM ({SEARCHES}) y WHERE {some}", merged))


@query("STR22 STR23 STR25 FLT15 STR29 JSN06", f"WITH {QUERIED} SELECT lead_id, ord::INTEGER AS ord, tier, legal_query, owner_query, query_state FROM qs")
def search_queries(spark, sf_dir):
    return queried(spark, sf_dir).select("lead_id", "ord", "tier", "legal_query", "owner_query", "query_state")


@query("FLT16", f"WITH {QUERIED} SELECT lead_id, bool_or(query_state = 'READY') AS eligible FROM qs GROUP BY lead_id")
def search_eligibility(spark, sf_dir):
    return candidates.eligible(queried(spark, sf_dir))


@query("STR24 STR25", f"WITH {QUERIED} SELECT lead_id, {_J(_L('TR', 't'), _L('BLK', 'b'), 'CASE WHEN length(s) > 0 THEN s END', _L('LOT', 'r'), _L('SEC', 'c'))} AS full_text FROM (SELECT no.*, {N('rp_legal_lot')} AS r FROM no JOIN se USING (lead_id)) z")
def full_legal_texts(spark, sf_dir):
    df = derive.relation(spark, sf_dir, SEARCHES)
    return df.select("lead_id", legal.full_text(C("rp_legal_tract"), C("rp_legal_block"), C("rp_legal_description_text"), C("rp_legal_lot"), C("rp_legal_sec")).alias("full_text"))


#: The stated set of searches: leads whose id is divisible by 50, against all properties.
SOME = "lead_id % 50 = 0"
#: What a search needs of them.
ASKED = ("lead_id", "tier", "query_state", "legal_query", "owner_query")
HITS = f"""{QUERIED}, pr AS ({derive.PROPERTIES}),
hi AS (SELECT q.lead_id, q.ord, q.tier, p.property_id, p.account, p.legal_text, p.owner_name FROM qs q JOIN pr p ON contains(upper(p.legal_text), q.legal_query) AND (q.owner_query IS NULL OR contains(upper(p.owner_name), q.owner_query)) WHERE q.query_state = 'READY' AND {SOME})"""


@query("JOIN05 SRC17 SIM05", f"WITH {HITS} SELECT lead_id, tier, property_id FROM hi")
def property_search(spark, sf_dir):
    """Containment joins meet on the rarest stretch of three letters, not on every pair."""
    found = candidates.search(queried(spark, sf_dir, SOME).select(*ASKED), derive.relation(spark, sf_dir, derive.PROPERTIES).select("property_id", "legal_text", "owner_name"))
    return found.select("lead_id", "tier", "property_id")


@query("JOIN05", f"WITH {HITS} SELECT lead_id, tier, property_id FROM hi")
def indexed_search(spark, sf_dir):
    """The same search over a stored index of the different texts, written once for the tables."""
    properties = derive.relation(spark, sf_dir, derive.PROPERTIES).select("property_id", "legal_text", "owner_name")
    return candidates.search(queried(spark, sf_dir, SOME).select(*ASKED), properties, by_index(spark, sf_dir, properties)).select("lead_id", "tier", "property_id")


def by_index(spark, sf_dir, properties):
    """What meets by the stored index: a text is known by the least property that has it."""
    texts = candidates.described(properties).groupBy("legal").agg(F.min("property_id").alias("id"))
    index = derive.once(spark, sf_dir, "gram_index", lambda: gramindex.scratch(texts, "id", "legal"))
    return lambda asked, _: gramindex.search(index, asked.select(C("legal_query").alias("query"))).select(C("query").alias("legal_query"), C("text").alias("legal"))


STATUS = f"""{HITS}, cn AS (SELECT q.lead_id, q.ord, q.tier, q.query_state, q.s, count(h.property_id) AS n, min(h.owner_name) AS owner_name FROM qs q LEFT JOIN hi h ON q.lead_id = h.lead_id AND q.tier = h.tier WHERE {SOME.replace('lead_id', 'q.lead_id')} GROUP BY ALL),
sa AS (SELECT *, CASE WHEN query_state <> 'READY' THEN query_state WHEN lead_id % 101 = 0 THEN 'ERROR' WHEN n = 0 THEN 'NO_HITS' WHEN n = 1 THEN CASE WHEN lead_id % 4 = 0 THEN 'SINGLE_ITEM_IN_LIST' ELSE 'UNIQUE_HIT' END WHEN n > 20 THEN 'PAGINATION_TOO_LARGE' ELSE 'MULTIPLE_HITS' END AS status FROM cn)"""


def statuses(spark, sf_dir):
    q = queried(spark, sf_dir, SOME)
    rows = candidates.outcomes(q, candidates.meetings(q, derive.relation(spark, sf_dir, derive.PROPERTIES)))
    status = candidates.status(C("n"), C("lead_id") % 101 == 0)
    status = F.when(C("query_state") != "READY", C("query_state")).when((status == "UNIQUE_HIT") & (C("lead_id") % 4 == 0), "SINGLE_ITEM_IN_LIST").otherwise(status)
    return rows.withColumn("status", status)


@query("AGG13", f"WITH {STATUS} SELECT lead_id, tier, n, status FROM sa")
def search_status(spark, sf_dir):
    return statuses(spark, sf_dir).select("lead_id", "tier", "n", "status")


def _fold_sql() -> str:
    """The fall-back as a recursive step from tier to tier."""
    later = "('T2_ExactLegal', 'T3_DropSec', 'T4_Subdivision_Block')"
    skip = f"(x.tier IN {later} AND a.broad AND x.s <> '')"
    hit = "x.status IN ('UNIQUE_HIT', 'SINGLE_ITEM_IN_LIST')"
    won = f"(({hit} OR x.status = 'MULTIPLE_HITS') AND x.chosen)"
    weak = f"({hit} AND x.chosen AND x.ord = 0 AND NOT x.named)"
    return f"""ti AS (SELECT lead_id, ord, tier, status, s, lead_id % 3 <> 0 AS chosen, contains(coalesce(owner_name, ''), coalesce(d, '#')) AND coalesce(d, '') <> '' AS named FROM sa JOIN (SELECT lead_id, d FROM no) z USING (lead_id)),
fo AS (SELECT DISTINCT lead_id, -1 AS ord, 'NO_HCAD_MATCH_FOUND_ALL_TIERS' AS st, 'N/A' AS hit_tier, false AS ended, false AS broad, false AS found FROM ti
UNION ALL SELECT a.lead_id, x.ord, CASE WHEN a.ended THEN a.st WHEN {skip} THEN 'SKIPPED_DUE_TO_BROAD_SEARCH' WHEN {weak} THEN 'SUCCESS_T0_NEEDS_NAME_CONFIRM' WHEN {won} THEN 'SUCCESS' WHEN {hit} THEN 'DETAIL_PARSE_FAILED' WHEN x.status = 'MULTIPLE_HITS' THEN 'MULTIPLE_HITS_NO_WINNER_TIER_' || x.tier
        WHEN x.status = 'ERROR' THEN 'ERROR_IN_TIER_' || x.tier ELSE x.status END, CASE WHEN NOT a.ended AND {won} AND NOT {skip} THEN x.tier ELSE a.hit_tier END,
    a.ended OR (NOT {skip} AND (({won} AND NOT {weak}) OR ({hit} AND NOT x.chosen) OR x.status IN ('ERROR', 'SINGLE_ITEM_IN_LIST'))), a.broad OR (NOT a.ended AND NOT {skip} AND x.status = 'PAGINATION_TOO_LARGE' AND x.s <> ''), a.found OR (NOT a.ended AND {won} AND NOT {skip})
    FROM fo a JOIN ti x ON a.lead_id = x.lead_id AND x.ord = a.ord + 1)"""


@query("CTL02 CTL03 SRT05 FLT14", f"""WITH RECURSIVE {STATUS}, {_fold_sql()} SELECT lead_id, st AS hcad_search_status, CASE WHEN st IN ('SUCCESS', 'PAGINATION_TOO_LARGE') THEN hit_tier WHEN st = 'SUCCESS_T0_NEEDS_NAME_CONFIRM' AND found THEN 'T0_ExactLotBlockSubdivision' ELSE 'N/A' END AS hcad_final_tier_hit FROM fo WHERE ord = 6""")
def tier_fallback(spark, sf_dir):
    rows = statuses(spark, sf_dir)
    named = candidates.name_confirms(C("owner_name"), C("probate_lead_decedent_last"), F.lit(None).cast("string"))
    tiers = rows.select("lead_id", "ord", "tier", "status", (C("lead_id") % 3 != 0).alias("chosen"), named.alias("named"), F.upper(F.trim(F.coalesce("rp_legal_description_text", F.lit("")))).alias("subdivision"))
    return candidates.fall_back(tiers)


#: What a search of one tier finds, as a page of a site lists it: the first twenty hits. Each search has candidates of its own.
CANDIDATES = f"""SELECT CAST(l.lead_id AS string) || '/' || f.tier AS search, f.tier, f.property_id AS ord, l.rp_legal_tract, l.rp_legal_block, l.rp_legal_lot, l.rp_legal_sec, l.rp_legal_description_text,
    l.grantee_last, l.probate_lead_decedent_last, CASE WHEN l.lead_id % 4 = 0 THEN 'High' ELSE 'Medium' END AS confidence, CASE WHEN p.property_id % 7 = 0 THEN NULL ELSE p.owner_name END AS owner,
    p.legal_text AS detail_legal, p.account || ' ' || p.legal_text || ' DR' AS address, p.property_id % 5 <> 4 AS has_detail
    FROM (SELECT lead_id, tier, property_id, row_number() OVER (PARTITION BY lead_id, tier ORDER BY property_id) AS nth FROM found) f JOIN ({SEARCHES}) l ON l.lead_id = f.lead_id JOIN ({derive.PROPERTIES}) p ON p.property_id = f.property_id WHERE nth <= 20"""
_HAS = lambda name, v, n: f"CASE WHEN {v} <> '' AND contains(cb.dl, '{name} ' || {v}) THEN {n} ELSE 0 END"
_WHOLE = _J(_L("TR", "t"), _L("BLK", "b"), "CASE WHEN length(s) > 0 THEN s END", _L("LOT", "x"), _L("SEC", "c"))
SCORES = f"""{HITS}, found AS (SELECT lead_id, tier, property_id FROM hi), ca AS ({CANDIDATES}),
cc AS (SELECT *, {N('rp_legal_tract')} AS t, {N('rp_legal_block')} AS b, {N('rp_legal_lot')} AS x, {N('rp_legal_sec')} AS c, {N('rp_legal_description_text')} AS s, upper(trim(coalesce(owner, ''))) AS o, upper(trim(detail_legal)) AS dl, upper(trim(address)) AS ad,
    CASE WHEN tier LIKE '%GranteeLastName%' THEN upper(trim(coalesce(grantee_last, ''))) WHEN tier LIKE 'Fallback%' THEN upper(trim(coalesce(probate_lead_decedent_last, ''))) ELSE '' END AS who,
    CASE WHEN tier LIKE '%GranteeLastName%' THEN nullif(upper(trim(coalesce(grantee_last, ''))), '') ELSE nullif(upper(trim(coalesce(probate_lead_decedent_last, ''))), '') END AS tgt FROM ca),
cb AS (SELECT *, {_WHOLE} AS whole FROM cc), wr AS (SELECT whole, dl, {ratio_sql('whole', 'dl')} AS r FROM (SELECT DISTINCT whole, dl FROM cb WHERE tier = 'T4_Subdivision_Block' AND whole <> '' AND dl <> '') y),
al AS (SELECT who AS p, o AS q FROM cb UNION SELECT s, ad FROM cb UNION SELECT s, dl FROM cb UNION SELECT tgt, o FROM cb),
{token_set_sql('p', 'q', 'al')},
su AS (SELECT search, ord, CASE WHEN who <> '' AND o <> '' THEN w.ts ELSE 0 END * 0.5::DOUBLE + CASE WHEN s <> '' AND ad <> '' THEN u.ts ELSE 0 END * 0.5::DOUBLE AS part FROM cb LEFT JOIN ts w ON w.a = who AND w.b = o LEFT JOIN ts u ON u.a = s AND u.b = ad),
de AS (SELECT search, ord, least(100.0, (CASE WHEN tier = 'T4_Subdivision_Block' THEN coalesce(wr.r, 0.0) ELSE ({_HAS('TR', 'cb.t', 40.0)} + {_HAS('BLK', 'cb.b', 30.0)} + CASE WHEN x <> '' AND (contains(cb.dl, 'LT ' || x) OR contains(cb.dl, 'LOT ' || x)) THEN 20.0 ELSE 0 END + {_HAS('SEC', 'c', 10.0)} + CASE WHEN s <> '' THEN d.ts / 100.0 * 30 ELSE 0 END)::DOUBLE END)::DOUBLE / 130.0 * 100.0) AS lp,
    CASE WHEN o <> '' AND tgt IS NOT NULL THEN CASE WHEN n.ts < 60 AND (tier LIKE 'T1%' OR tier LIKE 'Fallback%') THEN greatest(0.0, n.ts - 20) ELSE n.ts END WHEN tgt IS NOT NULL THEN 20.0 WHEN o <> '' THEN 30.0 ELSE 50.0 END AS op FROM cb LEFT JOIN ts d ON d.a = s AND d.b = cb.dl LEFT JOIN ts n ON n.a = tgt AND n.b = o LEFT JOIN wr ON wr.whole = cb.whole AND wr.dl = cb.dl),
sc AS (SELECT cb.search, cb.ord, cb.confidence, cb.tier, su.part AS summary, CASE WHEN has_detail THEN greatest(0.0, least(100.0, lp * 0.70::DOUBLE + op * 0.30::DOUBLE)) END AS detail FROM cb JOIN su USING (search, ord) JOIN de USING (search, ord))"""


def candidate_rows(spark, sf_dir):
    """Candidates as the search of each tier finds them, up to twenty; texts that are compared are compared once for each two of them."""
    c, by = C, Pairs()
    asked, properties = queried(spark, sf_dir, SOME), derive.relation(spark, sf_dir, derive.PROPERTIES)
    met = candidates.meetings(asked, properties, by_index(spark, sf_dir, properties))
    candidates.first_hits(asked, properties, met, candidates.PAGE).createOrReplaceTempView("found")
    df = files.kept(derive.relation(spark, sf_dir, CANDIDATES), "candidates")
    summary = candidates.summary_score(c("tier"), c("grantee_last"), c("probate_lead_decedent_last"), c("owner"), c("rp_legal_description_text"), c("address"), F.lit(""), by)
    none = F.lit(None).cast("string")
    who = candidates.target(c("tier"), c("grantee_last"), none, c("probate_lead_decedent_last"), none, none)
    detail = candidates.detail_score(c("tier"), c("rp_legal_tract"), c("rp_legal_block"), c("rp_legal_lot"), c("rp_legal_sec"), c("rp_legal_description_text"), who, c("detail_legal"), c("owner"), by)
    return by.compared(df).select("search", "ord", "confidence", "tier", summary.alias("summary"), F.when(c("has_detail"), detail).alias("detail"))


@query("SC10 SC11 SIM03", f"WITH {SCORES} SELECT search, ord, tier, round(summary, 6) AS summary, round(detail, 6) AS detail FROM sc")
def candidate_scores(spark, sf_dir):
    return candidate_rows(spark, sf_dir).select("search", "ord", "tier", F.round("summary", 6).alias("summary"), F.round("detail", 6).alias("detail"))


@query("SC12 WIN02 SRT02 SRT06", f"""WITH {SCORES},
rk AS (SELECT *, coalesce(detail, summary) AS score, row_number() OVER (PARTITION BY search ORDER BY summary DESC, ord) AS rn, lead(summary) OVER (PARTITION BY search ORDER BY summary DESC, ord) AS next_summary FROM (SELECT search, ord, confidence, round(summary, 6) AS summary, round(detail, 6) AS detail FROM sc)),
cl AS (SELECT search, ord, 'summary' AS chosen_by, score FROM rk WHERE rn = 1 AND summary >= 60 AND (next_summary IS NULL OR summary - next_summary >= 20)),
t3 AS (SELECT *, row_number() OVER (PARTITION BY search ORDER BY score DESC, rn) AS sn, lead(score) OVER (PARTITION BY search ORDER BY score DESC, rn) AS next_score FROM rk WHERE rn <= 3 AND search NOT IN (SELECT search FROM cl)),
ao AS (SELECT search, ord, 'at_once' AS chosen_by, score FROM t3 WHERE detail >= 90 QUALIFY rn = min(rn) OVER (PARTITION BY search)),
ds AS (SELECT search, ord, 'detail' AS chosen_by, score FROM t3 WHERE sn = 1 AND search NOT IN (SELECT search FROM ao) AND score >= CASE WHEN confidence = 'High' THEN 70 ELSE 50 END AND (next_score IS NULL OR score - next_score >= CASE WHEN confidence = 'High' THEN 15 ELSE 10 END))
SELECT * FROM cl UNION ALL SELECT * FROM ao UNION ALL SELECT * FROM ds""")  # fmt: skip
def candidate_choice(spark, sf_dir):
    rows = candidate_rows(spark, sf_dir).withColumns({k: F.round(k, 6) for k in ("summary", "detail")})
    return candidates.choose(rows, "search")


@query("JOIN04 STR26", f"""WITH h AS (SELECT p_partkey AS hit, CASE WHEN p_partkey % 3 = 0 THEN 'http://x/d?Acct=' || CAST(p_partkey % 500 AS string) || '&y=1' WHEN p_partkey % 3 = 1 THEN 'http://x/d?acct=' ELSE NULL END AS url, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_partkey % 700 AS string) END AS listed FROM part)
SELECT hit, coalesce(nullif(regexp_extract(url, '(?i)acct=(\\d+)', 1), ''), listed) AS account, s_name AS owner FROM h LEFT JOIN supplier ON CAST(s_suppkey AS string) = coalesce(nullif(regexp_extract(url, '(?i)acct=(\\d+)', 1), ''), listed)""")  # fmt: skip
def detail_lookup(spark, sf_dir):
    hits = derive.relation(spark, sf_dir, "SELECT p_partkey AS hit, CASE WHEN p_partkey % 3 = 0 THEN 'http://x/d?Acct=' || CAST(p_partkey % 500 AS string) || '&y=1' WHEN p_partkey % 3 = 1 THEN 'http://x/d?acct=' ELSE NULL END AS hcad_detail_url, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_partkey % 700 AS string) END AS hcad_account_summary FROM part")
    details = spark.table("supplier").select(C("s_suppkey").cast("string").alias("hcad_account"), C("s_name").alias("owner"))
    return candidates.with_details(hits, details).select("hit", C("detail_key").alias("account"), "owner")


ACCOUNT_LINKS = "SELECT page_id, url || CASE WHEN page_id % 3 = 0 THEN '?Acct=' || CAST(page_id * 7 AS string) || '&x=1' WHEN page_id % 3 = 1 THEN '?acct=&y=2' ELSE '' END AS link FROM pages"


@query("STR26", f"WITH l AS ({ACCOUNT_LINKS}) SELECT page_id, nullif(regexp_extract(link, '(?i)acct=(\\d+)', 1), '') AS account FROM l")
def accounts_in_links(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/pages.parquet").createOrReplaceTempView("pages")
    return spark.sql(ACCOUNT_LINKS).select("page_id", account_in(C("link")).alias("account"))


OWNERS = f"""SELECT lead_id, CASE WHEN k % 31 = 0 THEN '' ELSE hcad_owner_full_name END AS hcad_owner_full_name, probate_lead_decedent_first AS decedent_first, probate_lead_decedent_last AS decedent_last,
    CASE WHEN k % 6 = 0 THEN NULL ELSE {derive.pick(derive.FIRSTS, 'k + k % 2')} END AS party_first, CASE WHEN k % 6 = 0 THEN NULL ELSE {derive.pick(derive.LASTS, 'c + k % 3')} END AS party_last, {derive.pick(derive.FIRSTS, 'c')} || ' ' || {derive.pick(derive.LASTS, 'k')} AS grantee, k % 4 <> 0 AS has_grantee,
    CASE WHEN k % 17 = 0 THEN 'NO_HITS' WHEN k % 19 = 0 THEN 'SUCCESS_T0_NEEDS_NAME_CONFIRM' WHEN k % 23 = 0 THEN 'ERROR_IN_TIER_X' ELSE 'SUCCESS' END AS hcad_search_status, CASE WHEN k % 29 = 0 THEN 'timeout' ELSE NULL END AS parsing_error,
    CASE WHEN k % 2 = 0 THEN 'Grantor' ELSE 'Grantee' END AS rp_party_type FROM ({derive.LEADS}) z"""


def owner_rows(spark, sf_dir):
    df = derive.relation(spark, sf_dir, OWNERS).withColumn("rp_grantee_full_names_list", F.when(C("has_grantee"), F.array("grantee", F.lit("TEST CO"))))
    return owners.scores(df)


# Fixed values, written out again: what is no surname.
NOT_LAST = "('JR', 'SR', 'II', 'III', 'IV', 'V', 'TRUST', 'ESTATE', 'EST', 'LLC', 'INC', 'LP', 'LTD', 'CO', 'BANK')"
_W = lambda x: f"list_filter(regexp_split_to_array(upper(trim({x})), '\\s+'), lambda z: z <> '')"
_SUR = lambda x: f"coalesce(list_filter({_W(x)}, lambda z: z NOT IN {NOT_LAST})[-1], {_W(x)}[-1], '')"
FIRM = "['LLC', 'INC', 'LP', 'LTD', 'CO', 'BANK', 'TRUST', 'ESTATE', 'EST']"
OWNER_SCORES = f"""oa AS ({OWNERS}), ob AS (SELECT *, upper(trim(coalesce(hcad_owner_full_name, ''))) AS o, nullif(trim(upper(trim(coalesce(decedent_first, ''))) || ' ' || upper(trim(coalesce(decedent_last, '')))), '') AS dn, nullif(trim(upper(trim(coalesce(party_first, ''))) || ' ' || upper(trim(coalesce(party_last, '')))), '') AS pn FROM oa),
oc AS (SELECT *, CASE WHEN NOT list_has_any({_W('o')}, {FIRM}) AND len({_W('o')}) > 0 THEN {_W('o')}[1] ELSE {_SUR('o')} END AS og, {_SUR('dn')} AS ds, {_SUR('pn')} AS ps, {_SUR('grantee')} AS gs FROM ob),
al AS (SELECT dn AS p, o AS q FROM oc UNION SELECT pn, o FROM oc UNION SELECT grantee, o FROM oc UNION SELECT ds, og FROM oc UNION SELECT ps, og FROM oc UNION SELECT gs, og FROM oc UNION SELECT dn, pn FROM oc UNION SELECT 'TEST CO', o FROM oc UNION SELECT 'TEST', og FROM oc),
{token_set_sql('p', 'q', 'al')},
od AS (SELECT oc.*, o <> '' AND hcad_search_status IN ('SUCCESS', 'SUCCESS_T0_NEEDS_NAME_CONFIRM') AS there, CASE WHEN ds <> '' AND og <> '' THEN t1.ts ELSE 0 END AS a1, t2.ts AS a2, CASE WHEN ps <> '' AND og <> '' THEN t3.ts ELSE 0 END AS b1, t4.ts AS b2, CASE WHEN gs <> '' AND og <> '' THEN t5.ts ELSE 0 END AS c1, t6.ts AS c2, t7.ts AS d1, CASE WHEN og <> '' THEN t8.ts ELSE 0 END AS e1, t9.ts AS e2 FROM oc
    LEFT JOIN ts t1 ON t1.a = ds AND t1.b = og LEFT JOIN ts t2 ON t2.a = dn AND t2.b = o LEFT JOIN ts t3 ON t3.a = ps AND t3.b = og LEFT JOIN ts t4 ON t4.a = pn AND t4.b = o LEFT JOIN ts t5 ON t5.a = gs AND t5.b = og LEFT JOIN ts t6 ON t6.a = grantee AND t6.b = o LEFT JOIN ts t7 ON t7.a = dn AND t7.b = pn LEFT JOIN ts t8 ON t8.a = 'TEST' AND t8.b = og LEFT JOIN ts t9 ON t9.a = 'TEST CO' AND t9.b = o),
oe AS (SELECT *, CASE WHEN there AND dn IS NOT NULL THEN round_even(a1 * 0.3::DOUBLE + a2 * (1 - 0.3)::DOUBLE, 0) ELSE 0.0 END AS s1, CASE WHEN there AND pn IS NOT NULL THEN round_even(b1 * 0.3::DOUBLE + b2 * (1 - 0.3)::DOUBLE, 0) ELSE 0.0 END AS s2,
    CASE WHEN there AND has_grantee THEN greatest(0.0, round_even(c1 * 0.6::DOUBLE + c2 * (1 - 0.6)::DOUBLE, 0), round_even(e1 * 0.6::DOUBLE + e2 * (1 - 0.6)::DOUBLE, 0)) ELSE 0.0 END AS s3, CASE WHEN there THEN coalesce(d1, 0.0) ELSE 0.0 END AS s4 FROM od),
og AS (SELECT *, CASE WHEN hcad_search_status NOT IN ('SUCCESS', 'SUCCESS_T0_NEEDS_NAME_CONFIRM') THEN hcad_search_status WHEN o = '' THEN 'HCAD_OWNER_NAME_MISSING' WHEN s1 >= 80 AND ((pn IS NULL AND dn IS NOT NULL) OR s4 >= 80) THEN 'MATCH_PROBATE_DECEDENT_AS_RP_PARTY'
    WHEN s1 >= 80 THEN 'MATCH_PROBATE_DECEDENT_RP_PARTY_DIFFERED' WHEN NOT (pn IS NULL AND dn IS NOT NULL) AND s2 >= 80 THEN 'MATCH_RP_PARTY_PROBATE_DEVIATED' WHEN s3 >= 80 THEN 'MATCH_RP_GRANTEE' ELSE 'HCAD_OWNER_IS_UNRELATED_THIRD_PARTY' END AS kind FROM oe)"""


@query("SC13 STR05 STR06 NUM08 AGG10 JOIN11 SIM03", f"WITH {OWNER_SCORES} SELECT lead_id, s1, s2, s3, round(s4, 6) AS s4 FROM oe")
def owner_scores(spark, sf_dir):
    return owner_rows(spark, sf_dir).select("lead_id", C("score_hcad_vs_probate").alias("s1"), C("score_hcad_vs_rp_party").alias("s2"), C("score_hcad_vs_best_rp_grantee").alias("s3"), F.round("score_probate_vs_rp_party", 6).alias("s4"))


@query("SC14", f"WITH {OWNER_SCORES} SELECT lead_id, kind, CASE WHEN kind IN ('MATCH_PROBATE_DECEDENT_AS_RP_PARTY', 'MATCH_PROBATE_DECEDENT_RP_PARTY_DIFFERED', 'MATCH_RP_PARTY_PROBATE_DEVIATED') THEN 1 ELSE 0 END AS is_owner_grantor, CASE WHEN kind = 'MATCH_RP_GRANTEE' THEN 1 ELSE 0 END AS is_owner_grantee FROM og")
def owner_types(spark, sf_dir):
    return owners.match_type(owner_rows(spark, sf_dir)).select("lead_id", C("hcad_owner_match_type").alias("kind"), "is_owner_grantor", "is_owner_grantee")


@query("SC15", f"""WITH {OWNER_SCORES}, re AS (SELECT lead_id, CASE WHEN hcad_search_status NOT IN ('SUCCESS', 'SKIPPED_INSUFFICIENT_DATA', 'NO_HITS', 'COMMON_SURNAME_TOO_BROAD', 'NO_QUERY_FORMED') THEN 'HCAD Search Status: ' || hcad_search_status WHEN parsing_error IS NOT NULL THEN 'HCAD Detail Page Parsing Error: ' || parsing_error
    WHEN kind = 'MATCH_RP_PARTY_PROBATE_DEVIATED' THEN 'Review: HCAD Owner matches RP Party, which differs from Probate Lead' WHEN kind = 'MATCH_PROBATE_DECEDENT_RP_PARTY_DIFFERED' THEN 'Review: HCAD Owner matches Probate Lead, but RP Party was different' WHEN kind = 'HCAD_OWNER_IS_UNRELATED_THIRD_PARTY' THEN 'Review: HCAD Owner appears to be an unrelated third party'
    WHEN kind = 'MATCH_RP_GRANTEE' AND NOT coalesce(a2 >= 80, false) THEN 'Review: HCAD Owner matches RP Grantee (who is not Probate Lead)' WHEN kind = 'HCAD_OWNER_NAME_MISSING' THEN 'HCAD Owner Name Missing After Successful Scrape' END AS review_reason FROM og)
SELECT lead_id, CASE WHEN review_reason IS NULL THEN 0 ELSE 1 END AS needs_review_flag, review_reason FROM re""")  # fmt: skip
def owner_reviews(spark, sf_dir):
    return owners.review(owners.match_type(owner_rows(spark, sf_dir))).select("lead_id", "needs_review_flag", "review_reason")


KINDS = [owners.SAME, owners.DIFFERED, owners.DEVIATED, owners.GRANTEE, owners.UNRELATED]
CONTACTS = f"""SELECT lead_id, CASE WHEN k % 3 = 0 THEN 'TEST CO' WHEN k % 7 = 0 THEN 'SAMPLE CO LIMITED' WHEN k % 11 = 0 THEN 'EST OF DOE' ELSE hcad_owner_full_name END AS hcad_owner_full_name, {derive.pick(KINDS, 'k * 3 + c')} AS hcad_owner_match_type,
    CASE WHEN k % 5 = 0 THEN 'TEST HOLDINGS' WHEN k % 13 = 0 THEN NULL ELSE {derive.pick(derive.FIRSTS, 'k')} || ' ' || {derive.pick(derive.LASTS, 'c')} END AS rp_party_full_name, CASE WHEN k % 2 = 0 THEN 'Grantor' WHEN k % 9 = 0 THEN NULL ELSE 'Grantee' END AS rp_party_type, hcad_site_address FROM ({derive.LEADS}) z"""
PERSON = lambda x: f"(coalesce(trim({x}), '') <> '' AND NOT regexp_matches(upper({x}), '\\b(LLC|INC|LP|LTD|CORP|CO |TRUST|BANK|ESTATE|EST |PROPERTIES|INVESTMENTS|FUND|GROUP|REALTY|HOLDINGS|ASSOCIATION|ASSN|VENTURES|LLP)\\b'))"
CONTACT_SQL = f"""co AS ({CONTACTS}), cp AS (SELECT *, {PERSON('hcad_owner_full_name')} AS op, {PERSON('rp_party_full_name')} AS pp, coalesce(rp_party_type = 'Grantor', false) AS gr FROM co),
cq AS (SELECT *, CASE WHEN op AND hcad_owner_match_type IN ('{owners.SAME}', '{owners.DIFFERED}') THEN 'MATCHED_HCAD_DECEDENT' WHEN op AND hcad_owner_match_type IN ('{owners.DEVIATED}', '{owners.GRANTEE}') AND gr AND pp THEN 'FALLBACK_RP_GRANTOR' WHEN NOT op AND gr AND pp THEN 'FALLBACK_RP_GRANTOR_VS_ENTITY' WHEN op THEN 'MANUAL_REVIEW_UNMATCHED_HUMAN' ELSE 'ENTITY_SUPPRESS' END AS why FROM cp),
cr AS (SELECT *, CASE WHEN why IN ('MATCHED_HCAD_DECEDENT', 'MANUAL_REVIEW_UNMATCHED_HUMAN') THEN hcad_owner_full_name WHEN why LIKE 'FALLBACK%' THEN rp_party_full_name END AS name, CASE why WHEN 'MATCHED_HCAD_DECEDENT' THEN 'A' WHEN 'MANUAL_REVIEW_UNMATCHED_HUMAN' THEN 'C' WHEN 'ENTITY_SUPPRESS' THEN 'DROP' ELSE 'B' END AS tier FROM cq)"""


@query("SC16 STR07 UDF06 JOIN08", f"WITH {CONTACT_SQL} SELECT lead_id, name, why, tier FROM cr")
def contact_targets(spark, sf_dir):
    df = owners.contact(derive.relation(spark, sf_dir, CONTACTS))
    return df.select("lead_id", C("owner_contact_name").alias("name"), C("owner_contact_rationale").alias("why"), C("contact_target_tier").alias("tier"))


@query("SRC24 JOIN03", f"WITH {CONTACT_SQL}, kn AS (SELECT DISTINCT name AS n, '+1' || length(name)::VARCHAR AS phone, lower(replace(name, ' ', '.')) || '@example.org' AS email FROM cr WHERE name LIKE 'DOE%') SELECT lead_id, tier, phone AS contact_phone, email AS contact_email FROM cr LEFT JOIN kn ON n = name AND tier IN ('A', 'B')")
def contact_lookup(spark, sf_dir):
    contacts = owners.contact(derive.relation(spark, sf_dir, CONTACTS))
    known = contacts.select(C("owner_contact_name").alias("name")).filter("name like 'DOE%'").distinct().select("name", F.concat(F.lit("+1"), F.length("name").cast("string")).alias("contact_phone"), F.concat(F.lower(F.replace("name", F.lit(" "), F.lit("."))), F.lit("@example.org")).alias("contact_email"))
    return owners.reach(contacts, known).select("lead_id", C("contact_target_tier").alias("tier"), "contact_phone", "contact_email")


@query("JOIN03 SRC23", "SELECT c_custkey AS account, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS name, s_acctbal AS due FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def tax_lookup(spark, sf_dir):
    left = spark.read.parquet(f"{sf_dir}/customer.parquet").select(C("c_custkey").alias("account"), C("c_name").alias("name"))
    right = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(C("s_suppkey").alias("account"), C("s_name").alias("name"), C("s_acctbal").alias("due"))
    return relational.right_wins(left, right, "account").select("account", "name", "due")

