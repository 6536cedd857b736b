"""Scalar functions over texts, numbers and dates of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import dates, legal, names, numbers, text
from ledgerline.operators import relational, tagger
from ledgerline.sources import files, html

from . import derive
from .linkage_q import clean_sql, std_sql
from .registry import query

C = F.col
RAW_NAMES = f"SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN '  o''' || lower(party_last) || '   (x) ' ELSE party_last END AS last, CASE WHEN l_partkey % 5 = 0 THEN ' ' || party_first || ' III' WHEN l_partkey % 11 = 0 THEN 'MARY, ANN' ELSE party_first END AS first FROM (SELECT d.*, lead_id AS l_orderkey, line AS l_linenumber FROM ({derive.DEEDS}) d) z"
# An apostrophe that both dialects read: built from its number.
RAW_NAMES = RAW_NAMES.replace("'  o'''", "'  o' || chr(39)")


@query("STR01 STR02 STR03 STR04 STR13", f"""WITH r AS ({RAW_NAMES}), s AS (SELECT *, trim(regexp_replace(coalesce(last, ''), '\\s+', ' ', 'g')) AS t FROM r)
SELECT id, t AS squeezed, {clean_sql('last')} AS cleaned, {std_sql('last', 'first')} AS searched, split_part(t, ' ', 1) AS party_last, trim(substr(t, 1 + length(split_part(t, ' ', 1)))) AS party_first, split_part(t, ' ', 1) AS first_word FROM s""")  # fmt: skip
def cleaned_names(spark, sf_dir):
    df = derive.relation(spark, sf_dir, RAW_NAMES)
    p = names.party(C("last"))
    return df.select("id", text.squeeze(C("last")).alias("squeezed"), names.cleaned(C("last")).alias("cleaned"), names.searched(C("last"), C("first")).alias("searched"), p["last"].alias("party_last"), p["first"].alias("party_first"), F.split_part(text.squeeze(C("last")), F.lit(" "), F.lit(1)).alias("first_word"))


@query("STR16 STR17 STR28 STR29", f"""WITH l AS ({derive.LEADS}) SELECT lead_id, nullif(trim(coalesce(probate_lead_decedent_first, '') || ' ' || coalesce(probate_lead_decedent_last, '')), '') AS full_name, split_part(hcad_owner_full_name, ' ', -1) AS last_token,
    length(trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last)) - length(replace(trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last), ' ', '')) >= 1 AS two_words, probate_lead_decedent_last IN ({', '.join(repr(x) for x in names.COMMON_SURNAMES)}) AS common FROM l""")  # fmt: skip
def name_parts(spark, sf_dir):
    df = derive.relation(spark, sf_dir, derive.LEADS)
    both = "trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last)"
    return df.select("lead_id", names.full(C("probate_lead_decedent_first"), C("probate_lead_decedent_last")).alias("full_name"), F.split_part("hcad_owner_full_name", F.lit(" "), F.lit(-1)).alias("last_token"), F.expr(f"length({both}) - length(replace({both}, ' ', '')) >= 1").alias("two_words"), C("probate_lead_decedent_last").isin(names.COMMON_SURNAMES).alias("common"))


MONEY = "SELECT o_orderkey AS id, CASE CAST(o_orderkey % 7 AS int) WHEN 0 THEN '$' || CAST(o_custkey AS string) || ',234.50' WHEN 1 THEN 'Pending' WHEN 2 THEN '' WHEN 3 THEN 'n/a' WHEN 4 THEN '-5' WHEN 5 THEN NULL ELSE ' 12' END AS money, CASE WHEN o_orderkey % 3 = 0 THEN 'due: 1,' || CAST(100 + o_custkey % 900 AS string) || '.25 now 7' WHEN o_orderkey % 3 = 1 THEN 'none' ELSE '-.5x' END AS words, o_custkey AS n FROM orders"


@query("NUM01 NUM02", f"""WITH m AS ({MONEY}) SELECT id, CASE WHEN lower(trim(translate(money, '$,', ''))) IN ('', 'pending') THEN NULL ELSE TRY_CAST(trim(translate(money, '$,', '')) AS DOUBLE) END AS money, TRY_CAST(replace(regexp_extract(words, '(-?[\\d,]*\\.?\\d+)', 1), ',', '') AS DOUBLE) AS first FROM m""")
def money_texts(spark, sf_dir):
    return derive.relation(spark, sf_dir, MONEY).select("id", numbers.currency(C("money")).alias("money"), numbers.first_number(C("words")).alias("first"))


@query("NUM05 NUM06 NUM07 NUM08 NUM09", f"""WITH m AS ({MONEY}) SELECT id, n::DOUBLE / nullif(id % 4, 0) AS ratio, round(n * 100.0 / 7, 2)::DOUBLE AS pct, round(greatest(0.0, least(100.0, n / 8.0 - 3)), 2)::DOUBLE AS clipped, round_even(n / 2.0::DOUBLE, 0) AS even, coalesce(TRY_CAST(money AS DOUBLE), 0) AS zeroed FROM m""")
def rounded_numbers(spark, sf_dir):
    n = C("n").cast("double")
    return derive.relation(spark, sf_dir, MONEY).select("id", numbers.ratio(n, C("id") % 4).alias("ratio"), numbers.percent(C("n"), F.lit(7)).cast("double").alias("pct"), numbers.clipped(n / 8.0 - 3).alias("clipped"), numbers.half_even(n / 2.0).alias("even"), numbers.or_zero(C("money")).alias("zeroed"))


WRITTEN = "SELECT o_orderkey AS id, CASE CAST(o_orderkey % 6 AS int) WHEN 0 THEN y || '-' || m || '-' || d WHEN 1 THEN m || '/' || d || '/' || y WHEN 2 THEN m || '-' || d || '-' || y WHEN 3 THEN y || '/' || m || '/' || d WHEN 4 THEN '13/45/2020' ELSE '' END AS written, day FROM (SELECT o_orderkey, CAST(o_orderdate AS date) AS day, substr(CAST(CAST(o_orderdate AS date) AS string), 1, 4) AS y, substr(CAST(CAST(o_orderdate AS date) AS string), 6, 2) AS m, substr(CAST(CAST(o_orderdate AS date) AS string), 9, 2) AS d FROM orders) z"


@query("DAT02 DAT03 DAT06 NUM04", f"""WITH w AS ({WRITTEN}), p AS (SELECT *, coalesce(try_strptime(written, '%m/%d/%Y'), try_strptime(written, '%Y-%m-%d'), try_strptime(written, '%m-%d-%Y'), try_strptime(written, '%Y/%m/%d'))::DATE AS parsed FROM w)
SELECT id, strftime(parsed, '%Y-%m-%d') AS parsed, abs(date_diff('day', parsed, DATE '1995-01-01'))::INTEGER AS apart FROM p""")  # fmt: skip
def written_dates(spark, sf_dir):
    parsed = dates.parse(C("written"))
    return derive.relation(spark, sf_dir, WRITTEN).select("id", dates.written(parsed).alias("parsed"), dates.apart(parsed, F.lit("1995-01-01").cast("date")).alias("apart"))


@query("DAT04 DAT05 SRC13 SRC25", f"""WITH w AS ({WRITTEN}), r AS (SELECT id, day, (day + INTERVAL (id % 50) DAY)::DATE AS stop FROM w), h AS (SELECT id, day, stop, (day + INTERVAL (floor((stop - day) / 2.0)::INT) DAY)::DATE AS mid FROM r), x AS (SELECT id, day, (day - INTERVAL 1 DAY)::DATE AS y, mid, stop FROM h)
SELECT id, strftime(day, '%Y-%m-%d') AS first_from, strftime(mid, '%Y-%m-%d') AS first_to, strftime((mid + INTERVAL 1 DAY)::DATE, '%Y-%m-%d') AS second_from, strftime(stop, '%Y-%m-%d') AS second_to, strftime((day - INTERVAL 8 DAY)::DATE, '%Y-%m-%d') AS week_before,
    strftime(CASE dayofweek(y) WHEN 0 THEN (y - INTERVAL 2 DAY)::DATE WHEN 6 THEN (y - INTERVAL 1 DAY)::DATE ELSE y END, '%Y-%m-%d') AS weekday FROM x""")  # fmt: skip
def date_ranges(spark, sf_dir):
    df = derive.relation(spark, sf_dir, WRITTEN).withColumn("h", dates.halves(C("day"), F.date_add("day", (C("id") % 50).cast("int"))))
    w = dates.written
    return df.select("id", w(C("h")[0]["first"]).alias("first_from"), w(C("h")[0]["last"]).alias("first_to"), w(C("h")[1]["first"]).alias("second_from"), w(C("h")[1]["last"]).alias("second_to"), w(F.date_sub("day", 8)).alias("week_before"), w(dates.weekday_before(C("day"))).alias("weekday"))


# Texts and pages are built here; their twins take them apart again, with lists of their own.
_D, _L, _B, _S = f"'Desc: {derive.SUBDIVISIONS[0]} ' || CAST(p_size AS string)", "'Lot: ' || CAST(p_size AS string)", "'Block: B' || CAST(p_partkey % 9 AS string)", "'Sec: ' || CAST(p_partkey % 4 AS string)"
_A, _V, _T, _U = "'Abstract: A-' || CAST(p_size AS string)", "'Survey: J DOE ' || CAST(p_partkey % 5 AS string)", "'Tract: ' || CAST(p_partkey % 70 AS string)", f"'Subd: {derive.SUBDIVISIONS[1]} ' || CAST(p_size AS string)"
LEGAL = f"""SELECT p_partkey AS id, CASE CAST(p_partkey % 18 AS int) WHEN 0 THEN 'plain words only' WHEN 1 THEN {_L} || ' ' || {_B} || ' ' || {_S} || ' Comment: none' WHEN 2 THEN {_D} || ' ' || {_L} || ' ' || {_B} || ' ' || {_S} || ' Related Docs' WHEN 3 THEN {_B} || '  ' || {_L} WHEN 4 THEN {_D} || ' ' || {_S} WHEN 5 THEN NULL WHEN 6 THEN {_S} WHEN 7 THEN {_S} || ' ' || {_B}
    WHEN 8 THEN {_U} || ' ' || {_L} || ' ' || {_B} WHEN 9 THEN {_A} || ' ' || {_V} || ' ' || {_T} WHEN 10 THEN {_T} || ' ' || {_L} WHEN 11 THEN {_V} || ' Comment: see map' WHEN 12 THEN {_S} || ' ' || {_T} WHEN 13 THEN {_D} || ' ' || {_U} || ' ' || {_A} || ' Related Docs 7' WHEN 14 THEN {_T} || ' ' || {_A} || ' ' || {_V} WHEN 15 THEN {_U} || ' Comment: x ' || {_T} WHEN 16 THEN {_L} || ' ' || {_U} ELSE 'Subdivision: ' || p_brand || ' ' || {_A} END AS t FROM part"""
_ENDS = {"Desc": "Lot Block Sec Subd Abstract Survey Tract", "Subd": "Lot Block Sec Abstract Survey Tract", "Lot": "Block Sec Comment", "Block": "Lot Sec Comment", "Sec": "Lot Block Comment", "Abstract": "Survey Tract", "Survey": "Abstract Tract", "Tract": "Abstract Survey"}


def _part_sql(label: str) -> str:
    """What stands after a label up to one that ends it. Where another label stands in between, a part of words is not read, and one of any text goes on over it."""
    ends = ", ".join(f"'{x}'" for x in _ENDS[label].split())
    any_text = label in ("Desc", "Subd")
    # An abstract's label ends like a tract's, and is read as one.
    begins = "x.l IN ('Tract', 'Abstract')" if label == "Tract" else f"x.l = '{label}'"
    upto = f"coalesce(list_min(list_transform(list_filter(ps, lambda y: y.i > x.i AND y.l IN ({ends})), lambda y: y.i)), len(ps) + 1)"
    goes_on = "array_to_string(list_transform(ps[x.i:{upto} - 1], lambda y: CASE WHEN y.i = x.i THEN y.v ELSE y.l || ': ' || y.v END), ' ')".replace("{upto}", upto)
    value = goes_on if any_text else f"CASE WHEN x.i = len(ps) OR ps[x.i + 1].l IN ({ends}) THEN x.v END"
    return f"trim(split_part(coalesce(list_filter(list_transform(list_filter(ps, lambda x: {begins}), lambda x: {value}), lambda z: z IS NOT NULL)[1], ''), 'Related Docs', 1))"


@query("STR08", f"""WITH l AS ({LEGAL}), p AS (SELECT id, coalesce(t, '') AS t, list_filter(string_split(regexp_replace(replace(coalesce(t, ''), 'Subdivision', 'Subd'), '(Desc|Lot|Block|Sec|Comment|Subd|Abstract|Survey|Tract): ', '^\\1: ', 'g'), '^'), lambda x: contains(x, ': ')) AS pl, contains(t, 'Subdivision') AS long FROM l),
r AS (SELECT id, t, long, list_transform(pl, lambda x, i: {{'i': i, 'l': split_part(x, ': ', 1), 'v': trim(substr(x, length(split_part(x, ': ', 1)) + 3))}}) AS ps FROM p),
q AS (SELECT id, t, {_part_sql('Desc')} AS d, {_part_sql('Lot')} AS lot, {_part_sql('Block')} AS block, {_part_sql('Sec')} AS sec, CASE WHEN long THEN 'ivision: ' ELSE '' END || {_part_sql('Subd')} AS subdivision, {_part_sql('Abstract')} AS abstract, {_part_sql('Survey')} AS survey, {_part_sql('Tract')} AS tract FROM r)
SELECT id, CASE WHEN d || lot || block || subdivision || abstract || survey || tract = '' THEN trim(split_part(t, 'Related Docs', 1)) ELSE d END AS description, lot, block, sec, subdivision, abstract, survey, tract FROM q""")  # fmt: skip
def legal_texts(spark, sf_dir):
    """All eight parts. A long label is read by its short form, as the source does: what follows keeps the rest of the label."""
    p = legal.parse(C("t"))
    return derive.relation(spark, sf_dir, LEGAL).select("id", *[p[k].alias(k) for k in ("description", "lot", "block", "sec", "subdivision", "abstract", "survey", "tract")])


CELLS = "SELECT p_partkey AS id, '<table>' || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '<tr><td><b>DESC:</b></td><td>' || p_name || '</td></tr>' END || '<tr><td>Lot:</td><td> ' || CAST(p_size AS string) || ' </td></tr>' || CASE WHEN p_partkey % 3 = 0 THEN '<tr><td>NOTE</td><td>' || p_brand || '</td></tr><tr><td>lot:</td><td>7</td></tr>' ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '<tr><td>COMMENT:</td><td>' || p_type || '</td></tr><tr><td>Kind</td><td></td></tr><tr><td>Use</td><td>x</td></tr>' END || CASE CAST(p_partkey % 6 AS int) WHEN 0 THEN '<tr><td>Subdivision</td><td>' || p_brand || '</td></tr><tr><td>Block:</td><td>B2</td></tr>' WHEN 1 THEN '<tr><td>Abstract No</td><td>A-' || CAST(p_size AS string) || '</td></tr><tr><td>Survey</td><td>J DOE</td></tr><tr><td>Tract</td><td>T1</td></tr>' WHEN 2 THEN '<tr><td>Section:</td><td>4</td></tr><tr><td>Comment: 2</td><td>more</td></tr>' WHEN 3 THEN '<tr><td>Sec:</td><td>5</td></tr><tr><td>Section</td><td>none</td></tr><tr><td>Tract</td><td></td></tr>' ELSE '' END || '<tr><td>one cell</td></tr></table>' AS h FROM part"
# Fixed values, written out again: the label's text, in this order, says what a row is.
_KINDS = {"description": "DESC:", "block": "BLOCK:", "lot": "LOT:", "subdivision": "SUBDIV", "abstract": "ABSTRACT", "survey": "SURVEY", "tract": "TRACT", "sec": "SEC:|SECTION:", "comment": "COMMENT:"}
_KIND = "CASE " + " ".join(f"WHEN regexp_matches(upper(x[1]), '{p}') THEN '{k}'" for k, p in _KINDS.items()) + " ELSE 'other' END"
_OF = lambda kind: f"list_filter(kv, lambda x: x[3] = '{kind}')"
_MORE = lambda a, name, b: f"CASE WHEN {b} = '' THEN {a} WHEN {a} = '' THEN '{name}: ' || {b} ELSE {a} || ' | {name}: ' || {b} END"


@query("STR09", f"""WITH r AS ({CELLS}), k AS (SELECT id, list_transform(list_filter(list_zip(list_transform(regexp_extract_all(h, '<td>(?:<b>)?([^<]*)(?:</b>)?</td><td>([^<]*)</td>', 1), lambda x: trim(x)), list_transform(regexp_extract_all(h, '<td>(?:<b>)?([^<]*)(?:</b>)?</td><td>([^<]*)</td>', 2), lambda x: trim(x))), lambda x: x[2] <> ''), lambda x: [x[1], x[2], {_KIND}]) AS kv FROM r),
v AS (SELECT id, {', '.join(f"coalesce({_OF(x)}[-1][2], '') AS {x}" for x in _KINDS if x != 'comment')}, coalesce({_OF('comment')}[1][2], '') AS c1, coalesce({_OF('comment')}[2][2], '') AS c2, array_to_string(list_transform({_OF('other')}, lambda x: x[1] || ': ' || x[2]), ' | ') AS o FROM k),
w AS (SELECT *, {_MORE('description', 'COMMENT', 'c1')} AS e1 FROM v), w2 AS (SELECT *, {_MORE('e1', 'COMMENT', 'c2')} AS e2 FROM w)
SELECT id, {_MORE('e2', 'OTHER_LEGAL', 'o')} AS description, block, lot, subdivision, abstract, survey, tract, sec FROM w2""")  # fmt: skip
def legal_tables(spark, sf_dir):
    t = legal.table_parts(html.labelled(C("h")))
    return derive.relation(spark, sf_dir, CELLS).select("id", *[t[k].alias(k) for k in ("description", "block", "lot", "subdivision", "abstract", "survey", "tract", "sec")])


CAPTIONS = f"""SELECT k AS id, f, l, CASE CAST(k % 13 AS int) WHEN 0 THEN 'IN THE ESTATE OF: ANNA BERTA ' || l || ', DECEASED' WHEN 1 THEN 'In the Matter of ' || f || ' Sample' WHEN 2 THEN 'RE ESTATE OF ANNA B ' || l || ' JR.' WHEN 3 THEN '' WHEN 4 THEN 'A. Bo, Cy'
    WHEN 5 THEN 'Estate of ' || f || ' Lee Poe Deceased' WHEN 6 THEN 'IN THE GUARDIANSHIP OF: Jon Q. Testman Sr' WHEN 7 THEN 'RE ESTATE OF MARY O' || chr(39) || l || ' SAMPLE-' || f WHEN 8 THEN 'JOSÉ É TESTÓN' WHEN 9 THEN 'IN THE MATTER OF ÁNGEL ' || l || ' MÜLLER III'
    WHEN 10 THEN 'Estate of: Zoë D' || chr(39) || 'Éxample-' || l || ', deceased' WHEN 11 THEN 'ÑANDÚ ' || l || ' ' || f || ' Y PEÑA' ELSE f END AS caption FROM (SELECT k, coalesce(probate_lead_decedent_first, '') AS f, coalesce(probate_lead_decedent_last, '') AS l FROM ({derive.LEADS}) z) y"""
# As the source: a capital after every sign that is no letter; \b sees letters with accents, which stand as _ for a pattern that knows only ASCII.
_SOFT = "array_to_string(list_transform(regexp_extract_all({x}, '[\\p{Lu}\\p{Ll}\\p{Lt}]+|[^\\p{Lu}\\p{Ll}\\p{Lt}]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"
_RUN = r"regexp_extract_all(regexp_replace({x}, '[\x{80}-\x{2018}\x{201A}-\x{10FFFF}]', '_', 'g'), '\b[A-Za-z][A-Za-z''’\-]+(?:\s+[A-Za-z][A-Za-z''’\-]+)+\b')"
_PHRASES = ["IN THE CONSERVATORSHIP OF", "IN THE GUARDIANSHIP OF", "IN THE GUARDIANSHIP", "IN THE MATTER OF", "RE ESTATE OF"]


@query("STR27", f"""WITH c AS ({CAPTIONS}), a AS (SELECT id, caption, regexp_replace(trim(caption), '(?i)\\s+(?:Jr\\.?|Sr\\.?|I{{2,3}}|IV)$', '') AS t FROM c), b AS (SELECT id, CASE WHEN upper(caption) = caption THEN {_SOFT.replace('{x}', 't')} ELSE t END AS t FROM a),
d AS (SELECT id, CASE {' '.join(f"WHEN starts_with(upper(t), '{p}') THEN regexp_replace(substr(t, {len(p) + 1}), '^[:, ]+|[:, ]+$', '', 'g')" for p in _PHRASES)} ELSE t END AS t FROM b),
e AS (SELECT id, regexp_extract(t, '(?i)ESTATE OF[:\\s]*(.+?)(?:,|\\s+DECEASED)', 1) AS estate, list_reduce(list_prepend('', {_RUN.replace('{x}', 't')}), lambda p, q: CASE WHEN length(q) > length(p) THEN q ELSE p END) AS run,
    list_filter(regexp_split_to_array(trim(replace(t, ',', ' ')), '\\s+'), lambda w: regexp_matches(w, '^\\p{{L}}+$') AND upper(w) NOT IN ('ESTATE', 'IN', 'THE', 'OF', 'DECEASED')) AS rest FROM d),
f AS (SELECT id, CASE WHEN estate <> '' THEN regexp_split_to_array(trim(estate), '\\s+') WHEN run <> '' THEN regexp_split_to_array(run, '\\s+') WHEN len(rest) >= 2 THEN rest ELSE [] END AS ws FROM e)
SELECT id, CASE WHEN len(ws) >= 2 THEN array_to_string(ws[1:len(ws) - 1], ' ') ELSE coalesce(ws[1], '') END AS first, CASE WHEN len(ws) >= 2 THEN ws[-1] ELSE '' END AS last FROM f""")  # fmt: skip
def caption_names(spark, sf_dir):
    d = names.decedent(C("caption"))
    return derive.relation(spark, sf_dir, CAPTIONS).select("id", d["first"].alias("first"), d["last"].alias("last"))


#: Captions that name persons, firms and courts; of four in five the names are known, and the model learns from these.
NAMED = f"""SELECT id, CASE CAST(id % 7 AS int) WHEN 0 THEN 'Estate of ' || n || ', Deceased' WHEN 1 THEN 'In the Matter of ' || n WHEN 2 THEN 'Acme Holdings LLC v. ' || n WHEN 3 THEN 'Application of ' || n || ' as Executor, County Court No. 2'
    WHEN 4 THEN 'Guardianship of ' || n || ' and First Sample Bank' WHEN 5 THEN 'Notice to all Creditors of the Estate' ELSE n || ' through Probate Court' END AS caption, CASE WHEN id % 7 = 5 THEN '' ELSE n END AS known FROM (SELECT id, initcap(lower(f || ' ' || l)) AS n FROM ({CAPTIONS}) c WHERE f <> '' AND l <> '') d"""


@query("STR27")
def recognised_names(spark, sf_dir):
    """Names in captions with the recognition step on; it is off by default. Captions are read once for each different one, and weigh as often as they come."""
    rows = derive.relation(spark, sf_dir, NAMED)
    words, tags = tagger.tagged(C("caption"), [C("known")])
    taught = rows.filter("id % 5 <> 0").groupBy("caption", "known").agg(F.count("*").alias("times"))
    model = tagger.fit(taught.select(words.alias("words"), tags.alias("tags"), "times"), times="times")
    each = tagger.recognised(rows.select("caption").distinct().withColumn("t", names.caption_text(C("caption"))), "t", model)
    d = names.decedent(C("caption"), C("person"))
    found = files.kept(each.select("caption", "person", d["first"].alias("first"), d["last"].alias("last")), "captions")
    return rows.join(found, "caption").select("id", "caption", "known", "person", (C("id") % 5 == 0).alias("held_out"), "first", "last")


LABELS = "SELECT p_partkey AS id, CASE CAST(p_partkey % 7 AS int) WHEN 0 THEN 'Foundation Type: ' || p_name WHEN 1 THEN ' Heating / AC ' WHEN 2 THEN p_brand || ': Half-Bath' WHEN 3 THEN 'Grade Adjustment (' || p_type || ')' WHEN 4 THEN NULL WHEN 5 THEN '-' || p_name || ' / ' ELSE p_type || ' and Design' END AS label FROM part"
_KEY = "regexp_replace(regexp_replace(trim(regexp_replace(lower(coalesce(label, '')), '[:()]', '', 'g')), '[\\s/\\-]+', '_', 'g'), '^_+|_+$', '', 'g')"


_STANDARD = " ".join(f"WHEN contains(k, '{x}') THEN '{x}'" for x in ("foundation_type", "exterior_wall", "heating_ac", "grade_adjustment", "physical_condition"))


@query("STR21", f"WITH l AS ({LABELS}), m AS (SELECT id, {_KEY} AS k FROM l) SELECT id, CASE {_STANDARD} ELSE k END AS k FROM m")
def label_keys(spark, sf_dir):
    return derive.relation(spark, sf_dir, LABELS).select("id", text.label_key(C("label")).alias("k"))


@query("JSN10 SRT10 JSN12", "SELECT l_orderkey AS id, array_to_string(list(l_linenumber ORDER BY l_linenumber)[1:3], ',') AS firsts, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def json_lists(spark, sf_dir):
    """Lists written as JSON text and read back."""
    own = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("l"))
    back = F.from_json(relational.json_or_null(C("l")), "array<int>")
    return own.select(C("l_orderkey").alias("id"), F.array_join(F.slice(back, 1, 3), ",").alias("firsts"), F.size(back).cast("bigint").alias("n"))
