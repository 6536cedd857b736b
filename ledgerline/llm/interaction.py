"""Operator 13, audit of how filters interact; DataFrame functions only.

Every filter is evaluated once a document; its failures are bits of one mask. What any order of the filters keeps, removes,
finds already removed or loses is a function of how many documents have which mask, so the documents are folded to one cell
for each mask and part, at most 32 a part, and all orders are enumerated from the cells.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Filter:
    """letter: its name in an order; its bit is its place in FILTERS. fails: SQL over the columns of measure()."""

    letter: str
    fails: str


FILTERS = (
    Filter("A", "n_words < 200"),
    Filter("B", "100 * n_distinct < 50 * n_words"),
    Filter("C", "100 * n_capitals > 3 * n_points"),
    Filter("D", "has_symbol"),
    Filter("E", "doc_id > first_id"),
)
#: Filters that a text alone decides; the last one needs the whole table.
ALONE = FILTERS[:4]
STEPS = len(FILTERS)
ORDERS = factorial(STEPS)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id long, part (lang; null: empty), digest (SHA-256 of the text), and what the filters of one text need."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    words = base.withColumn("w", F.array_remove(F.split("t", SPACE), ""))
    return words.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.size("w").cast("long").alias("n_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("t", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length("t").cast("long").alias("n_points"),
        F.col("t").rlike("[#$%&*|]").alias("has_symbol"),
    )


def masks(docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, part, digest, mask (int; bit k is set where filter k fails).

    The texts are read once; what is left of them is written to the shared folder. The least doc_id of each text is found
    by a grouping on the text's SHA-256, combined before the shuffle, and joined back on doc_id and digest: that key is
    unique but for rows repeated as a whole, so a text that a third of all rows share does not make a hot key. A null
    doc_id is no smaller than any other and has none smaller.
    """
    bits = F.lit(0)
    for k, f in enumerate(ALONE):
        bits = bits + F.when(F.expr(f.fails), F.lit(1 << k)).otherwise(0)
    rows = common.keep(measure(docs).select("doc_id", "part", "digest", bits.alias("alone")), "masks")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("is_first", F.lit(True))
    late = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(firsts, ["doc_id", "digest"], "left").select("doc_id", "part", "digest", (F.col("alone") + F.when(late, F.lit(1 << len(ALONE))).otherwise(0)).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row a part and mask that occurs: part, mask, n, good (labels quality=1), toxic (labels toxic=1), all counts long.

    A document is good or toxic if any of its labels' rows says so. Labels of no document and rows without an id count nothing.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").filter("doc_id is not null")
    marks = marks.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = masks(docs).select("doc_id", "part", "mask").join(marks, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic"))


def _bits(letters) -> Column:
    """The bits of the filters whose letters a text holds."""
    out = F.lit(0)
    for k, f in enumerate(FILTERS):
        out = out + F.when(F.contains(letters, F.lit(f.letter)), F.lit(1 << k)).otherwise(0)
    return out


def enumerate_orders(table: DataFrame) -> DataFrame:
    """A row a part, order and step from cells(): the counts that the contract names.

    Each cell meets all orders, one literal, and their steps, so the work hangs on the number of parts, not of documents. Of all
    orders, a filter comes first among the k that a document fails in one of k; so shapley adds 120 / k for each of them.
    """
    orders = " ".join("".join(p) for p in permutations(f.letter for f in FILTERS))
    rows = table.select("*", F.explode(F.split(F.lit(orders), " ")).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step"))
    rows = rows.withColumns({"own": _bits(F.expr("substr(filter_order, step, 1)")), "before": _bits(F.expr("substr(filter_order, 1, step - 1)"))})
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition, what="n"):
        return F.sum(F.when(condition, F.col(what)).otherwise(0)).cast("long")

    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * (ORDERS / F.bit_count("mask")).cast("long")).otherwise(0)).cast("long").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows a part.

    A null or empty text has no words, so it fails A, and E if a smaller doc_id has none either. Every row is a document:
    rows repeated as a whole all count, and none of them is a smaller one of the other. Long texts are read whole. Null and
    empty lang are one part. An empty table has no parts and gives no rows; empty labels lose nothing. Other columns are
    not read, whatever their names.
    """
    return enumerate_orders(cells(docs, labels))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS f FROM t),
b AS (SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > f, false) AS e FROM m),
g AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM b LEFT JOIN g USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM l p JOIN l q ON q.x <> p.x JOIN l r ON r.x NOT IN (p.x, q.x) JOIN l s ON s.x NOT IN (p.x, q.x, r.x) JOIN l u ON u.x NOT IN (p.x, q.x, r.x, s.x)),
k AS (SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS x, substr(filter_order, 1, step::INT - 1) AS before FROM o, range(1, 6) v(step)),
r AS (SELECT part, filter_order, step, x, n, good, toxic, contains(fails, x) AS own, before <> '' AND length(translate(fails, before, '')) < length(fails) AS gone, fails = x AS sole FROM c, k),
z AS (SELECT part, filter_order, step, x, sum(n) FILTER (NOT own AND NOT gone) AS kept, sum(n) FILTER (own AND NOT gone) AS removed, sum(n) FILTER (own AND gone) AS redundant, sum(n) FILTER (sole) AS unique_fails,
    sum(good) FILTER (own AND NOT gone) AS good_lost, sum(toxic) FILTER (own AND NOT gone) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, x), 0)::BIGINT AS shapley FROM z
"""
