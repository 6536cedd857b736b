"""Operator 7, quality rules kept as a bitmask ledger; DataFrame functions only.

Every rule is evaluated once. The ledger stores the measurements and one bit for each failed rule. A policy is a
versioned mask over these bits, so it can be changed, compared and ablated without reading a text again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """bit: its place in the ledger, never reused. fails: SQL over the measurements."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(3, "symbols", "5 * n_symbols > n_words"),
    Rule(4, "word_length", "word_chars < 2 * n_words or word_chars > 25 * n_words"),
    Rule(5, "digits", "5 * n_digits > word_chars"),
    Rule(6, "letters", "2 * n_letters < word_chars"),
    Rule(7, "capitals", "2 * n_capitals > n_letters"),
    Rule(8, "ellipses", "10 * n_ellipsis_lines > 3 * n_lines"),
    Rule(9, "bullets", "10 * n_bullet_lines > 9 * n_lines"),
    Rule(10, "duplicate_line_chars", "10 * n_dup_line_chars > 3 * n_line_chars"),
)


@dataclass(frozen=True)
class Policy:
    """A version of what rejects: the failure of any of its rules. A change of rules is a new version, never an edit."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)


POLICIES = (
    Policy("base", 1, ("few_words", "repeated_windows")),
    Policy("standard", 1, ("few_words", "repeated_windows", "duplicate_lines", "symbols", "word_length")),
    Policy("strict", 1, tuple(r.name for r in RULES)),
)


def policy(name: str, version: int) -> Policy:
    return next(p for p in POLICIES if (p.name, p.version) == (name, version))


MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_digits", "n_letters", "n_capitals", "n_ellipsis_lines", "n_bullet_lines", "n_line_chars", "n_dup_line_chars")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds MEASUREMENTS (all long) to a frame; columns of these names are replaced.

    Windows of three words are compared by a chained 64-bit hash within one text. The windows are sorted with their
    places only where a first pass, one hash set, has seen any of them twice; so the cost of a text is n log n at most.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("__t", t).withColumn("__w", F.array_remove(F.split("__t", SPACE + "+"), ""))
    step = step.withColumn("__n", F.size("__w")).withColumn("__lines", F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(WORD)))
    m = F.greatest(F.col("__n") - 2, F.lit(0))
    two = F.zip_with(F.slice("__w", F.lit(1), m), F.slice("__w", F.lit(2), m), lambda a, b: F.xxhash64(a, b))
    step = step.withColumn("__h", F.zip_with(two, F.slice("__w", F.lit(3), m), lambda h, c: F.xxhash64(h, c)))
    step = step.withColumn("__again", F.size("__h") > F.size(F.array_distinct("__h")))
    placed = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("__s", F.when(F.col("__again"), placed))
    k = F.size("__s") - 1
    twins = F.flatten(F.filter(F.zip_with(F.slice("__s", F.lit(1), k), F.slice("__s", F.lit(2), k), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda p: p.isNotNull()))
    step = step.withColumn("__p", F.when(F.col("__again"), twins))
    covered = F.size(F.array_distinct(F.concat("__p", F.transform("__p", lambda p: p + 1), F.transform("__p", lambda p: p + 2))))
    return step.withColumns(
        {
            "n_words": F.col("__n").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace("__t", f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("__again"), covered).otherwise(0).cast("long"),
            "n_digits": F.length(F.regexp_replace("__t", "[^0-9]+", "")).cast("long"),
            "n_letters": F.length(F.regexp_replace("__t", r"\P{L}+", "")).cast("long"),
            "n_capitals": F.length(F.regexp_replace("__t", "[^A-Z]+", "")).cast("long"),
            "n_ellipsis_lines": F.size(F.filter("__lines", lambda x: x.rlike(rf"(\.\.\.|…){SPACE}*\z"))).cast("long"),
            "n_bullet_lines": F.size(F.filter("__lines", lambda x: x.rlike(rf"\A{SPACE}*[-*•]"))).cast("long"),
            "n_line_chars": F.length(F.array_join("__lines", "")).cast("long"),
            "n_dup_line_chars": (F.length(F.array_join("__lines", "")) - F.length(F.array_join(F.array_distinct("__lines"), ""))).cast("long"),
        }
    ).drop("__t", "__w", "__n", "__lines", "__h", "__again", "__s", "__p")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """measure() and fail_bits long: bit r.bit is set where rule r fails.

    Null and empty texts have no words, so they fail few_words. Other columns are kept; the names of the measurements
    and fail_bits replace columns of the same name. Rows are independent: ties and repeats need no rule.
    """
    bits: Column = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0).cast("long"))
    return measure(docs, text).withColumn("fail_bits", bits)


def write(docs: DataFrame, path: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> None:
    """Store the ledger of a table: the keys of its rows, measurements and fail_bits, no text. Policies are applied to what read() gives.

    Nulls, empty texts and repeated rows are as in ledger(), each row with a row of its own; an empty table is an empty ledger.
    """
    ledger(docs.select(*keys, text), text).drop(text).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def judge(book: DataFrame, by: Policy) -> DataFrame:
    """Adds kept (no rule of the policy has failed) and sole_rule, the rule that alone rejects, so that without it the row is kept; else null."""
    own = F.col("fail_bits").bitwiseAND(F.lit(by.mask).cast("long"))
    sole = F.coalesce(*[F.when(own == F.lit(1 << r.bit).cast("long"), r.name) for r in RULES if by.mask >> r.bit & 1])
    return book.withColumns({"kept": own == 0, "sole_rule": sole})


def _folded(book: DataFrame) -> DataFrame:
    """The ledger's distinct bit patterns, at most two to the number of rules, with their counts: all that policies need."""
    return book.groupBy("fail_bits").agg(F.count("*").alias("n"))


def compare(book: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """A row a policy: policy, version, n_kept, n_rejected, and hit_bits, the rules that any row has failed under it (their bits or-ed)."""
    each = F.explode(F.array(*[F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(p.mask).cast("long").alias("mask")) for p in policies])).alias("p")
    rows = _folded(book).select("fail_bits", "n", each).select("n", "p.*", F.col("fail_bits").bitwiseAND(F.col("p.mask")).alias("own"))
    return rows.groupBy("policy", "version").agg(
        F.sum(F.when(F.col("own") == 0, F.col("n")).otherwise(0)).alias("n_kept"), F.sum(F.when(F.col("own") != 0, F.col("n")).otherwise(0)).alias("n_rejected"), F.bit_or("own").alias("hit_bits")
    )


def ablate(book: DataFrame, by: Policy) -> DataFrame:
    """A row a rule of the policy: n_failed, n_only (rejected by it alone, so kept without it), n_rejected by the policy."""
    m = by.mask
    rules = [r for r in RULES if m >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("own")) for r in rules])).alias("r")
    rows = _folded(book).select(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("b"), "n", each).select("b", "n", "r.*")
    hit = F.col("b").bitwiseAND(F.col("own")) != 0
    return rows.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("b") == F.col("own"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("b") != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
    )


BASE, VERDICT = policy("base", 1), policy("standard", 1)


def digest(docs: DataFrame) -> DataFrame:
    """The stored ledger of doc_id and text, judged: doc_id, measurements, fail_bits, base_failed, kept, sole_rule.

    A row a document, a null doc_id included; null and empty texts fail for their few words. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = f"{common.shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    common.own(spark, path)
    write(docs, path)
    book = judge(read(spark, path), VERDICT)
    failed = F.col("fail_bits").bitwiseAND(F.lit(BASE.mask).cast("long")) != 0
    return book.select("doc_id", *MEASUREMENTS, "fail_bits", failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"), "sole_rule")


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] AS k FROM w, unnest(range(1, len(ws) - 1)) r(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
v AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM r, range(0, 3) s(o) GROUP BY doc_id),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
m AS (SELECT l.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^0-9]+', '', 'g'))::BIGINT AS n_digits, length(regexp_replace(t, '\P{L}+', '', 'g'))::BIGINT AS n_letters,
    length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z')))::BIGINT AS n_ellipsis_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '\A[\x20\x09-\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
    length(array_to_string(ls, ''))::BIGINT AS n_line_chars,
    (length(array_to_string(ls, '')) - length(array_to_string(list_distinct(ls), '')))::BIGINT AS n_dup_line_chars
    FROM l LEFT JOIN v USING (doc_id)),
f AS (SELECT *, n_words < 50 AS f0, 100 * n_repeat_words > 50 * n_words AS f1, 100 * n_dup_lines > 50 * n_lines AS f2,
    5 * n_symbols > n_words AS f3, word_chars < 2 * n_words OR word_chars > 25 * n_words AS f4, 5 * n_digits > word_chars AS f5,
    2 * n_letters < word_chars AS f6, 2 * n_capitals > n_letters AS f7, 10 * n_ellipsis_lines > 3 * n_lines AS f8,
    10 * n_bullet_lines > 9 * n_lines AS f9, 10 * n_dup_line_chars > 3 * n_line_chars AS f10 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_digits, n_letters, n_capitals, n_ellipsis_lines,
    n_bullet_lines, n_line_chars, n_dup_line_chars,
    (f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT + 64 * f6::INT + 128 * f7::INT + 256 * f8::INT + 512 * f9::INT + 1024 * f10::INT)::BIGINT AS fail_bits,
    f0 OR f1 AS base_failed, NOT (f0 OR f1 OR f2 OR f3 OR f4) AS kept,
    CASE WHEN f0::INT + f1::INT + f2::INT + f3::INT + f4::INT = 1
        THEN CASE WHEN f0 THEN 'few_words' WHEN f1 THEN 'repeated_windows' WHEN f2 THEN 'duplicate_lines' WHEN f3 THEN 'symbols' ELSE 'word_length' END END AS sole_rule FROM f
"""
