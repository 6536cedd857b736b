"""Linkage of filings and deeds, names and parties."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import dates, legal, names, similarity
from ledgerline.operators import linkage, relational

from . import derive
from .registry import query

C = F.col


def codes(x: str) -> str:
    return f"list_transform(string_split({x}, ''), lambda ch: [ord(ch)])"


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence, row by row, in DuckDB; one-element lists keep the types of both folds alike."""
    n = f"length({a})::INTEGER"
    inner = f"list_reduce(list_transform(range(1, {n} + 1), lambda i: [i::INTEGER]), lambda r, i: list_append(r, CASE WHEN ord(substr({a}, i[1], 1)) = y[1] THEN w[i[1]] + 1 ELSE greatest(w[i[1] + 1], r[-1]) END), [0::INTEGER])"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE list_reduce(list_transform(string_split({b}, ''), lambda ch: [ord(ch)::INTEGER]), lambda w, y: {inner}, list_transform(range(0, {n} + 1), lambda z: 0::INTEGER))[-1] END"


def ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 ELSE 200.0 * ({lcs_sql(a, b)}) / (length({a}) + length({b})) END::DOUBLE"


CLEAN = r"trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(upper(coalesce({x}, '')), '\s*\b(JR|SR|II|III|IV)\.?$', '')), '[^\w\s-]', '', 'g')), '\s+', ' ', 'g'))"


def clean_sql(x: str) -> str:
    return CLEAN.replace("{x}", x)


FEATURES = f"""
pairs AS ({derive.PAIRS}),
cleaned AS (SELECT *, {clean_sql('decedent_last')} AS dl, {clean_sql('decedent_first')} AS df, {clean_sql('party_last')} AS pl, {clean_sql('party_first')} AS pf, abs(date_diff('day', filing_date, rp_file_date)) AS days FROM pairs),
lasts AS (SELECT dl, pl, {ratio_sql('dl', 'pl')} AS last_score FROM (SELECT DISTINCT dl, pl FROM cleaned)), firsts AS (SELECT df, pf, {ratio_sql('df', 'pf')} AS first_score FROM (SELECT DISTINCT df, pf FROM cleaned)),
featured AS (SELECT *, CASE WHEN days < 180 THEN 100 WHEN days < 365 THEN 50 ELSE 0 END AS near, CASE WHEN upper(trim(rp_party_type)) = 'GRANTOR' THEN 100 ELSE 0 END AS role,
    CASE upper(trim(rp_instrument_type)) WHEN 'W/D' THEN 100 WHEN 'DEED' THEN 95 WHEN 'GIFT DEED' THEN 90 WHEN 'QUIT CLAIM DEED' THEN 80 WHEN 'D/T' THEN 30 WHEN 'RELEASE OF LIEN' THEN 20 WHEN 'MODIF' THEN 15 WHEN 'NOTICE' THEN 10 ELSE 25 END AS instrument,
    CASE WHEN rp_search_tier LIKE 'TIER_1%' THEN 100 WHEN rp_search_tier LIKE 'TIER_2%' THEN 75 WHEN rp_search_tier LIKE 'TIER_3%' THEN 50 ELSE 25 END AS tier FROM cleaned JOIN lasts USING (dl, pl) JOIN firsts USING (df, pf)),
linked AS (SELECT *, round(greatest(0.0, least(100.0, last_score * 0.25 + first_score * 0.10 + near * 0.20::DOUBLE + role * 0.10::DOUBLE + instrument * 0.15::DOUBLE + tier * 0.10::DOUBLE)), 2) AS total FROM featured),
levelled AS (SELECT *, CASE WHEN total >= 80 THEN 'High' WHEN total >= 60 THEN 'Medium' ELSE 'Low' END AS level FROM linked)
"""


def linked(spark, sf_dir):
    """Names are alike over and over, so similarities are taken once for each pair of names."""
    pairs = derive.relation(spark, sf_dir, derive.PAIRS)
    return linkage.link(pairs)


@query("SC03 SC04 SC05 SC06 SC07 STR02 DAT02 SIM02 UDF02 UDF03 UDF04 UDF05", f"WITH {FEATURES} SELECT rp_file_number, dl, df, pl, pf, round(last_score, 6) AS last_score, round(first_score, 6) AS first_score, days::INTEGER AS days_apart, near, role, instrument, tier FROM featured")
def linkage_features(spark, sf_dir):
    df = linkage.features(derive.relation(spark, sf_dir, derive.PAIRS))
    return df.select(
        "rp_file_number", C("cleaned_decedent_last").alias("dl"), C("cleaned_decedent_first").alias("df"), C("cleaned_party_last").alias("pl"), C("cleaned_party_first").alias("pf"), F.round("name_last_score", 6).alias("last_score"),
        F.round("name_first_score", 6).alias("first_score"), "days_apart", C("date_proximity_score").alias("near"), C("party_role_score").alias("role"), C("instrument_weight").alias("instrument"), C("search_tier_weight").alias("tier"),
    )


@query("SC08 SC09 NUM07 NUM09 AGG16", f"WITH {FEATURES} SELECT rp_file_number, total, level, level <> 'Low' AS potential FROM levelled")
def linkage_scores(spark, sf_dir):
    return linked(spark, sf_dir).select("rp_file_number", C("match_score_total").alias("total"), C("match_confidence_level").alias("level"), C("is_potential_decedent_match").alias("potential"))


@query("SRT01 SRT04 SET07 SET08", f"""WITH {FEATURES},
r AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY total DESC, rp_file_number) AS rn FROM levelled),
b AS (SELECT least(count_if(level = 'High'), 10) AS h, count_if(level = 'Medium') AS m, count_if(level = 'Low') AS l FROM levelled),
q AS (SELECT h, least(m, 8, 25 - h) AS m, l FROM b), s AS (SELECT h, m, least(l, 7, 25 - h - m) AS w FROM q), z AS (SELECT h, m, greatest(w, 25 - h - m - w) AS w FROM s)
SELECT rp_file_number, level, total, rn::INTEGER AS level_rank FROM r, z WHERE (level = 'High' AND rn <= h) OR (level = 'Medium' AND rn <= m) OR (level = 'Low' AND rn <= w)""")  # fmt: skip
def qa_sample(spark, sf_dir):
    return linkage.qa_sample(linked(spark, sf_dir), "rp_file_number").select("rp_file_number", C("match_confidence_level").alias("level"), C("match_score_total").alias("total"), "level_rank")


@query("SC01", f"""WITH b AS ({derive.LEADS}), t AS (SELECT lead_id, lower(trim(probate_lead_type_desc || ' ' || probate_lead_subtype)) AS x FROM b)
SELECT lead_id, CASE WHEN contains(x, 'probate of will') OR contains(x, 'letters testamentary') OR contains(x, 'application for probate') THEN 5 WHEN contains(x, 'independent administration') AND (contains(x, 'with will annexed') OR contains(x, 'heirship')) THEN 4
    WHEN contains(x, 'ancillary administration') THEN 3 WHEN contains(x, 'dependent administration') OR contains(x, 'will deposit') THEN 2 WHEN contains(x, 'muniment of title') THEN 1 ELSE 0 END AS signal FROM t""")  # fmt: skip
def filing_signal(spark, sf_dir):
    return derive.relation(spark, sf_dir, derive.LEADS).select("lead_id", linkage.filing_signal(C("probate_lead_type_desc"), C("probate_lead_subtype")).alias("signal"))


@query("SC02", f"""WITH d AS ({derive.DEEDS}) SELECT rp_file_number, CASE WHEN trim(legal_text) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(lot) <> '' OR trim(block) <> '' THEN 1 ELSE 0 END
    + CASE WHEN abs(date_diff('day', filing_date, rp_file_date)) <= 180 THEN 2 WHEN abs(date_diff('day', filing_date, rp_file_date)) <= 365 THEN 1 ELSE 0 END AS signal FROM d""")  # fmt: skip
def deed_signal(spark, sf_dir):
    d = derive.relation(spark, sf_dir, derive.DEEDS)
    return d.select("rp_file_number", linkage.deed_signal(C("legal_text"), C("lot"), C("block"), C("filing_date"), C("rp_file_date")).alias("signal"))


_DIGITS = "translate(t, 'BFPVCGJKQSXZDTLMNRAEIOUYHW', '111122222222334556000000')"
_RUNS = "z"
for _d in "123456":
    _RUNS = f"regexp_replace({_RUNS}, '{_d}+', '{_d}', 'g')"


@query("SIM01 UDF01 STR02", f"""WITH d AS ({derive.PAIRS}), w AS (SELECT DISTINCT {clean_sql('party_last')} AS name FROM d UNION SELECT DISTINCT {clean_sql('decedent_last')} FROM d),
c AS (SELECT name, t, {_DIGITS} AS z FROM (SELECT name, regexp_replace(name, '[^A-Z]', 'A', 'g') AS t FROM w))
SELECT name, CASE WHEN name = '' THEN '' ELSE substr(t, 1, 1) || rpad(substr(replace(substr({_RUNS}, 2), '0', ''), 1, 3), 3, '0') END AS sound FROM c""")  # fmt: skip
def phonetic_keys(spark, sf_dir):
    """Soundex of all names; what is no letter parts like letters as a vowel does."""
    d = derive.relation(spark, sf_dir, derive.PAIRS)
    names_ = d.select(names.cleaned(C("party_last")).alias("name")).union(d.select(names.cleaned(C("decedent_last")).alias("name"))).distinct()
    return names_.select("name", similarity.sounds(C("name")).alias("sound"))


#: The stated set of names, of parts whose number is divisible by 50, against all names that begin alike.
NAME_PAIRS = "SELECT a.name AS a, b.name AS b FROM (SELECT DISTINCT p_name AS name FROM part WHERE p_partkey % 50 = 0) a JOIN (SELECT DISTINCT p_name AS name FROM part) b ON substr(a.name, 1, 1) = substr(b.name, 1, 1) AND a.name <> b.name"


@query("SIM02", f"WITH p AS ({NAME_PAIRS}) SELECT a, b, round({ratio_sql('a', 'b')}, 6) AS score FROM p")
def similar_texts(spark, sf_dir):
    return derive.relation(spark, sf_dir, NAME_PAIRS).select("a", "b", F.round(similarity.ratio(C("a"), C("b")), 6).alias("score"))


def token_set_sql(a: str, b: str, rel: str) -> str:
    """CTEs that end in ts(a, b, ts)."""
    return f"""tk AS (SELECT DISTINCT {a} AS a, {b} AS b, list_distinct(list_filter(regexp_split_to_array(trim({a}), '\\s+'), lambda z: z <> '')) AS x, list_distinct(list_filter(regexp_split_to_array(trim({b}), '\\s+'), lambda z: z <> '')) AS y FROM {rel}),
tj AS (SELECT a, b, x, y, array_to_string(list_sort(list_filter(x, lambda z: NOT list_contains(y, z))), ' ') AS s1, array_to_string(list_sort(list_filter(y, lambda z: NOT list_contains(x, z))), ' ') AS s2, array_to_string(list_filter(x, lambda z: list_contains(y, z)), ' ') AS i FROM tk),
tl AS (SELECT *, length(i) AS li, CASE WHEN i <> '' THEN 1 ELSE 0 END AS g, {lcs_sql('s1', 's2')} AS lcs FROM tj),
ts AS (SELECT a, b, CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN i <> '' AND (s1 = '' OR s2 = '') THEN 100.0
    WHEN i <> '' THEN greatest(100.0 * (1 - (length(s1) + length(s2) - 2 * lcs)::DOUBLE / (2 * (li + g) + length(s1) + length(s2))), 100.0 * (1 - (g + length(s1))::DOUBLE / (2 * li + g + length(s1))), 100.0 * (1 - (g + length(s2))::DOUBLE / (2 * li + g + length(s2))))
    ELSE 100.0 * (1 - (length(s1) + length(s2) - 2 * lcs)::DOUBLE / (length(s1) + length(s2))) END AS ts FROM tl)"""


OWNER_PAIRS = f"SELECT DISTINCT hcad_owner_full_name AS a, probate_lead_decedent_first || ' ' || probate_lead_decedent_last AS b FROM ({derive.LEADS}) z WHERE hcad_owner_full_name IS NOT NULL AND probate_lead_decedent_first || ' ' || probate_lead_decedent_last IS NOT NULL"


@query("SIM03", f"WITH p AS ({OWNER_PAIRS}), {token_set_sql('a', 'b', 'p')} SELECT a, b, round(ts, 6) AS score FROM ts")
def similar_names(spark, sf_dir):
    return derive.relation(spark, sf_dir, OWNER_PAIRS).select("a", "b", F.round(similarity.token_set_ratio(C("a"), C("b")), 6).alias("score"))


@query("SIM04", f"""WITH p AS ({NAME_PAIRS}), o AS (SELECT a AS l, b AS r, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS t FROM p UNION ALL SELECT a, b, b, a FROM p WHERE length(a) = length(b)),
w AS (SELECT l, r, s, substr(t, greatest(i, 1)::INTEGER, (length(s) - greatest(1 - i, 0))::INTEGER) AS u FROM o, unnest(range(2 - length(s), length(t) + 1)) x(i)),
d AS (SELECT s, u, {ratio_sql('s', 'u')} AS q FROM (SELECT DISTINCT s, u FROM w)) SELECT l AS a, r AS b, round(max(q), 6) AS score FROM w JOIN d USING (s, u) GROUP BY ALL""")  # fmt: skip
def similar_parts(spark, sf_dir):
    return derive.relation(spark, sf_dir, NAME_PAIRS).select("a", "b", F.round(similarity.partial_ratio(C("a"), C("b")), 6).alias("score"))


STD = r"trim(regexp_replace(trim(upper(regexp_replace(coalesce({l}, ''), '[^\w\s''-]', '', 'g'))), '\s+(JR|SR|I|II|III|IV|V|VI|VII|VIII|IX|X)$', '') || ' ' || regexp_extract(trim(upper(regexp_replace(coalesce({f}, ''), '[^\w\s''-]', '', 'g'))), '^\S+'))"


def std_sql(last: str, first: str) -> str:
    """A name to search for, written out again."""
    return STD.replace("{l}", last).replace("{f}", first)


GRANTORS = f"SELECT rp_file_number, rp_file_date, upper(trim(coalesce(party_last, '') || ' ' || coalesce(party_first, ''))) AS party_name FROM ({derive.DEEDS}) z WHERE upper(trim(rp_party_type)) = 'GRANTOR'"


@query("JOIN06 DAT04", f"""WITH l AS ({derive.LEADS}), g AS ({GRANTORS}),
f AS (SELECT lead_id AS filing, {std_sql('probate_lead_decedent_last', 'probate_lead_decedent_first')} AS term, TRY_CAST(probate_lead_filing_date AS DATE) AS filed FROM l WHERE lead_id % 50 = 0)
SELECT filing, rp_file_number, abs(date_diff('day', filed, rp_file_date))::INTEGER AS days FROM f JOIN g ON term <> '' AND starts_with(party_name, term) AND rp_file_date BETWEEN filed - INTERVAL 365 DAY AND filed + INTERVAL 365 DAY""")  # fmt: skip
def deeds_near_filing(spark, sf_dir):
    """Filings whose id is divisible by 50 against all grantors."""
    term = names.searched(C("probate_lead_decedent_last"), C("probate_lead_decedent_first"))
    leads = derive.relation(spark, sf_dir, derive.LEADS).filter("lead_id % 50 = 0").select(C("lead_id").alias("filing"), term.alias("term"), F.try_to_timestamp("probate_lead_filing_date", F.lit("yyyy-MM-dd")).cast("date").alias("filed"))
    deeds = derive.relation(spark, sf_dir, GRANTORS)
    return relational.near_dates(leads, deeds, "term", "party_name", "filed", "rp_file_date").select("filing", "rp_file_number", dates.apart(C("rp_file_date"), C("filed")).alias("days"))


def _variants_sql(first: str) -> str:
    pairs: dict[str, set] = {}
    for n, short in names.NICKNAMES.items():
        for x in {n, *short}:
            pairs.setdefault(x, set()).update({n, *short} - {x})
    return f"CASE upper(trim({first})) " + " ".join(f"WHEN '{x}' THEN [{', '.join(repr(o) for o in sorted(v))}]" for x, v in sorted(pairs.items())) + " ELSE [] END"


FIRSTS = "SELECT DISTINCT split_part(probate_lead_decedent_first, ' ', 1) AS first FROM (" + derive.LEADS + ") z WHERE probate_lead_decedent_first IS NOT NULL"


@query("STR14 JOIN07", f"WITH f AS ({FIRSTS}) SELECT first, array_to_string({_variants_sql('first')}, ',') AS variants FROM f")
def nickname_variants(spark, sf_dir):
    return derive.relation(spark, sf_dir, FIRSTS).select("first", F.array_join(names.nickname_variants(C("first")), ",").alias("variants"))


PEOPLE = f"SELECT DISTINCT probate_lead_decedent_last AS last, probate_lead_decedent_first AS first FROM ({derive.LEADS}) z WHERE probate_lead_decedent_last IS NOT NULL AND probate_lead_decedent_first <> ''"
SIGNERS = f"SELECT DISTINCT party_last, party_first FROM ({derive.DEEDS}) z WHERE party_last IS NOT NULL"


@query("CTL01 JOIN07 FLT15 STR29 SET08", f"""WITH p AS ({PEOPLE}), d AS (SELECT *, upper(trim(party_last || ' ' || coalesce(party_first, ''))) AS party_name FROM ({SIGNERS}) y),
s AS (SELECT *, {std_sql('last', 'first')} AS t1 FROM p), n AS (SELECT last, first, t1, nick, {std_sql('last', 'nick')} AS term, row_number() OVER (PARTITION BY last, first ORDER BY nick) AS nth FROM s, unnest({_variants_sql('first')}) t(nick) WHERE {std_sql('last', 'nick')} <> t1),
v AS (SELECT last, first, t1 AS term, 'TIER_1_EXACT_STD' AS tier FROM s UNION ALL SELECT last, first, term, 'TIER_2_NICK_' || nick FROM n WHERE nth <= 3),
f AS (SELECT v.last, v.first, term, tier, party_last, party_first FROM v JOIN d ON starts_with(party_name, term) WHERE term <> ''),
r AS (SELECT last, first, {std_sql('last', "''")} AS term, t1 FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.last = s.last AND f.first = s.first) AND upper(trim(last)) NOT IN ('SMITH', 'TAYLOR', 'JOHNSON', 'WILLIAMS', 'JONES', 'BROWN', 'DAVIS', 'MILLER', 'WILSON', 'MOORE', 'ANDERSON', 'THOMAS', 'JACKSON', 'WHITE', 'HARRIS', 'MARTIN', 'THOMPSON', 'GARCIA', 'MARTINEZ', 'ROBINSON'))
SELECT * FROM f UNION ALL SELECT r.last, r.first, term, 'TIER_3_RARE_LN_ONLY', party_last, party_first FROM r JOIN d ON starts_with(party_name, term) WHERE term <> t1 AND term <> ''""")  # fmt: skip
def tiered_name_search(spark, sf_dir):
    people = derive.relation(spark, sf_dir, PEOPLE).withColumn("lead_id", F.concat("last", F.lit("/"), "first"))
    found = relational.tiered_names(people, derive.relation(spark, sf_dir, SIGNERS), last_names=True)
    return found.select("last", "first", C("search_term").alias("term"), "tier", "party_last", "party_first")


FIRST_WORDS = f"SELECT DISTINCT last, split_part(first, ' ', 1) AS first FROM ({PEOPLE}) y"


@query("CTL01", f"""WITH p AS ({FIRST_WORDS}), d AS ({SIGNERS}), j AS (SELECT p.*, d.*, CASE WHEN first = party_first THEN 1 WHEN substr(first, 1, 1) = substr(party_first, 1, 1) THEN 2 WHEN last NOT IN ('SMITH', 'GARCIA', 'ROBINSON') THEN 3 END AS tier_no FROM p JOIN d ON last = party_last)
SELECT * FROM j WHERE tier_no IS NOT NULL QUALIFY tier_no = min(tier_no) OVER (PARTITION BY last, first)""")  # fmt: skip
def name_search_by_initial(spark, sf_dir):
    people = derive.relation(spark, sf_dir, FIRST_WORDS).withColumn("lead_id", F.concat("last", F.lit("/"), "first"))
    return relational.by_initial(people, derive.relation(spark, sf_dir, SIGNERS)).select("last", "first", "party_last", "party_first", "tier_no")


def _lots_sql(x: str) -> str:
    items = lambda sep: f"list_filter(list_transform(string_split({x}, '{sep}'), lambda q: trim(q)), lambda q: q <> '')"
    return f"CASE WHEN regexp_matches({x}, '^[0-9]+-[0-9]+$') THEN CASE WHEN split_part({x}, '-', 1)::INT <= split_part({x}, '-', 2)::INT THEN list_transform(range(split_part({x}, '-', 1)::INT, split_part({x}, '-', 2)::INT + 1), lambda q: q::VARCHAR) ELSE [{x}] END WHEN contains({x}, ',') THEN {items(',')} WHEN contains({x}, '&') THEN {items('&')} ELSE [{x}] END"


#: Names of a deed's parties under their labels, in changing order.
LABELLED = f"""SELECT rp_file_number, lot, CASE WHEN l_partkey % 5 = 0 THEN '' WHEN l_partkey % 3 = 0 THEN 'Grantor: DOE JANE Q Grantee: ' || who || ' Grantor: LEE' WHEN l_partkey % 3 = 1 THEN 'Grantee: ' || who || ' ANN Grantor: ' || CAST(l_suppkey AS string) || ' CO' ELSE 'Grantee: X Grantee: ' || who END AS names_text
    FROM (SELECT d.*, coalesce(party_last, 'X') || ' ' || coalesce(party_first, '') AS who FROM ({derive.DEEDS}) d) z"""


@query("STR10 STR11 STR12 STR04 UDF10", f"""WITH d AS ({LABELLED}), s AS (SELECT rp_file_number, lot, list_filter(string_split(regexp_replace(names_text, '(Grantor|Grantee): ', '^\\1: ', 'g'), '^'), lambda x: trim(x) <> '') AS ps FROM d),
p AS (SELECT rp_file_number, lot, CASE WHEN len(ps) = 0 THEN ['N/A: '] ELSE ps END AS ps FROM s), q AS (SELECT rp_file_number, lot, split_part(x, ': ', 1) AS role, trim(substr(x, length(split_part(x, ': ', 1)) + 3)) AS who FROM p, unnest(ps) u(x))
SELECT rp_file_number, lo AS lot_no, role AS party_role, regexp_extract(who, '^\\S*') AS party_last, trim(regexp_replace(substr(who, 1 + length(regexp_extract(who, '^\\S*'))), '\\s+', ' ', 'g')) AS party_first FROM q, unnest({_lots_sql('lot')}) l(lo)""")  # fmt: skip
def lots_and_parties(spark, sf_dir):
    """A row a deed, lot and party, from lot texts and columns of labelled names."""
    rows = derive.relation(spark, sf_dir, LABELLED)
    return relational.exploded(rows, legal.lots(C("lot")), legal.parties(C("names_text"))).select("rp_file_number", "lot_no", "party_role", "party_last", "party_first")


@query("FLT04 FLT05 AGG08 JOIN02 UDF07 UDF09 STR28 SRT10", f"""WITH d AS ({derive.DEEDS}), g AS (SELECT lead_id, list(trim(coalesce(party_first, '') || ' ' || coalesce(party_last, '')) ORDER BY line, trim(coalesce(party_first, '') || ' ' || coalesce(party_last, ''))) FILTER (trim(coalesce(party_first, '') || ' ' || coalesce(party_last, '')) <> '') AS l FROM d WHERE rp_party_type = 'Grantee' GROUP BY lead_id)
SELECT rp_file_number, array_to_string(coalesce(l, []), ';') AS grantees, array_to_string(coalesce(l, [])[1:3], ';') AS first_three FROM d LEFT JOIN g USING (lead_id) WHERE rp_party_type = 'Grantor'""")  # fmt: skip
def grantee_lists(spark, sf_dir):
    d = derive.relation(spark, sf_dir, derive.DEEDS).withColumn("full_name", names.full(C("party_first"), C("party_last")))
    lists = relational.listed(d.filter(C("rp_party_type") == "Grantee"), "lead_id", "line", "full_name", "rp_grantee_full_names_list")
    rows = relational.with_lists(d.filter(C("rp_party_type") == "Grantor"), lists, "lead_id", "rp_grantee_full_names_list")
    return rows.select("rp_file_number", F.array_join("rp_grantee_full_names_list", ";").alias("grantees"), F.array_join(F.slice("rp_grantee_full_names_list", 1, 3), ";").alias("first_three"))


@query("AGG12 WIN03", f"WITH d AS ({derive.DEEDS}) SELECT lead_id, rp_instrument_type, rp_file_number, line FROM d QUALIFY row_number() OVER (PARTITION BY lead_id, rp_instrument_type ORDER BY line) = 1")
def first_deeds(spark, sf_dir):
    d = derive.relation(spark, sf_dir, derive.DEEDS).select("lead_id", "rp_instrument_type", "rp_file_number", "line")
    return relational.first_by(d, ["lead_id", "rp_instrument_type"], [C("line")])


@query("AGG12 SET07", f"WITH d AS ({derive.DEEDS}) SELECT DISTINCT party_last, party_first, rp_party_type FROM d")
def distinct_parties(spark, sf_dir):
    return derive.relation(spark, sf_dir, derive.DEEDS).select("party_last", "party_first", "rp_party_type").dropDuplicates()
