"""Operator 10, sharding by extendible hashing.

A row's place is given by the leading bits of the hash of its key. A directory maps every prefix to a shard; a shard
that is over its byte limit, and only such a shard, is split on one more bit, until each fits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Bits of the hash that can be used; 15 hexadecimal digits of an MD5.
BITS = 60
#: The byte limit of a shard where none is given: a share of all bytes, so that writers are kept busy, within these bounds.
SHARES, LEAST, MOST = 64, 32 << 10, 256 << 20


def limit_of(total: int) -> int:
    return max(LEAST, min(MOST, total // SHARES))


def hash_bits(key: str = "doc_id", text: str = "text") -> Column:
    """60 bits from the key and, so that rows sharing one key still part, the text."""
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _total(sized: DataFrame) -> int:
    return common.collect(sized.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))))[0][0]


def directory(sized: DataFrame, limit: int, total: int) -> list[tuple[int, DataFrame]]:
    """Shards of rows (h, n_bytes) of so many bytes: [(bits, leaves)], leaves (leaf, depth, prefix, shard_bytes, oversized).

    One aggregate at the depth that an even hash needs gives the leaves; the sizes of all shallower prefixes are sums
    of leaves. Rows whose leaf has no depth are over the limit there and find theirs in the next entry, eight bits deeper,
    where they alone are looked at. A leaf over the limit with one hash holds rows equal in key and text, or one row over
    the limit; no bit would split it, so it is a shard of all 60 bits and marked.
    """
    bits, base, rows, out = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 2), 0, sized, []
    while True:
        leaves = rows.groupBy(F.shiftright("h", BITS - bits).alias("leaf")).agg(F.sum("n_bytes").alias("leaf_bytes"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        leaves = common.keep(leaves, "leaves")
        up = leaves.select("leaf", "leaf_bytes", F.explode(F.sequence(F.lit(base), F.lit(bits))).alias("depth"))
        up = up.withColumn("prefix", F.expr(f"shiftright(leaf, {bits} - depth)"))
        fits = up.groupBy("depth", "prefix").agg(F.sum("leaf_bytes").alias("shard_bytes")).filter(F.col("shard_bytes") <= limit)
        best = up.join(fits, ["depth", "prefix"]).groupBy("leaf").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("s"))
        own = lambda name, whole: F.coalesce(f"s.{name}", F.when(F.col("lo") == F.col("hi"), whole)).alias(name)
        level = leaves.join(best, "leaf", "left").select(
            "leaf", own("depth", F.lit(BITS)), own("prefix", F.col("lo")), own("shard_bytes", F.col("leaf_bytes")), (F.col("s").isNull() & (F.col("lo") == F.col("hi"))).alias("oversized")
        )
        level = common.keep(level, "directory")
        common.drop(leaves)
        out.append((bits, level))
        left = level.filter("depth is null").select("leaf")
        if common.is_empty(left):
            return out
        rows = rows.join(left, F.shiftright("h", BITS - bits) == F.col("leaf"), "left_semi")
        base, bits = bits + 1, min(BITS, bits + 8)


def looked_up(rows: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """Adds shard, depth, shard_bytes and oversized to rows with their hash __h, which goes. Every row looks up its own leaves."""
    for k, (bits, leaves) in enumerate(levels):
        own = leaves.filter("depth is not null").select(F.col("leaf").alias("__leaf"), F.struct("depth", "prefix", "shard_bytes", "oversized").alias(f"__s{k}"))
        rows = rows.withColumn("__leaf", F.shiftright("__h", BITS - bits)).join(own, "__leaf", "left").drop("__leaf")
    found = [f"__s{k}" for k in range(len(levels))]
    rows = rows.withColumn("__s", F.coalesce(*found))
    bits = F.when(F.col("__s.depth") == 0, "").otherwise(F.expr("lpad(bin(__s.prefix), __s.depth, '0')"))
    out = rows.withColumns({"shard": bits, "depth": F.col("__s.depth").cast("int"), "shard_bytes": F.col("__s.shard_bytes"), "oversized": F.col("__s.oversized")})
    return out.drop("__h", "__s", *found)


def assign(docs: DataFrame, limit: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's key, n_bytes, shard (its prefix as bits, '' for the undivided whole), depth, shard_bytes, oversized.

    limit: bytes of a shard; limit_of() all bytes if not given. Null texts count 0 bytes and null keys hash as ''. Equal
    rows share a shard. An empty table gives no rows. Columns other than key and text are neither read nor returned.
    """
    sized = common.keep(docs.select(F.col(key).alias("key"), hash_bits(key, text).alias("h"), size(text).alias("n_bytes")), "sized")
    total = _total(sized)
    levels = directory(sized, limit_of(total) if limit is None else limit, total)
    return looked_up(sized.withColumnRenamed("h", "__h"), levels).select(F.col("key").alias(key), "n_bytes", "shard", "depth", "shard_bytes", "oversized")


def write(docs: DataFrame, path: str, limit: int | None = None, key: str = "doc_id", text: str = "text") -> list[tuple[int, DataFrame]]:
    """Write one folder a shard (shard=b0101), all columns kept, and return the directory.

    Nulls, repeats and empty tables are as in assign(). Rows with equal key and text go to one folder; a shard that no bit
    would split is written there by several tasks, each about the limit. A column named shard is replaced.
    """
    sized = common.keep(docs.select(hash_bits(key, text).alias("h"), size(text).alias("n_bytes")), "sized")
    total = _total(sized)
    limit = limit_of(total) if limit is None else limit
    levels = directory(sized, limit, total)
    common.drop(sized)
    # Rows are numbered where they are read, so a task that runs again numbers them alike.
    rows = docs.select(hash_bits(key, text).alias("__h"), F.monotonically_increasing_id().alias("__n"), F.struct(*[c for c in docs.columns if c != "shard"]).alias("row"))
    rows = looked_up(rows, levels)
    parts = F.when(F.col("oversized"), F.ceil(F.col("shard_bytes") / limit)).otherwise(1)
    rows = rows.select("row.*", F.concat(F.lit("b"), "shard").alias("shard"), F.pmod("__n", parts).alias("__part"))
    with common.tuned(docs.sparkSession):
        rows.repartition("shard", "__part").drop("__part").write.partitionBy("shard").parquet(path)
    return levels


ORACLE = f"""
WITH k AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
t AS (SELECT greatest({LEAST}, least({MOST}, coalesce(sum(n_bytes), 0)::BIGINT // {SHARES})) AS most FROM k),
u AS (SELECT k.*, d::INTEGER AS depth, h >> (60 - d)::INTEGER AS prefix FROM k, range(0, 61) r(d)),
s AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes FROM u GROUP BY ALL),
b AS (SELECT u.*, s.shard_bytes FROM u JOIN s USING (depth, prefix), t WHERE s.shard_bytes <= most OR depth = 60)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, depth, shard_bytes,
    shard_bytes > most AS oversized
FROM (SELECT *, min(depth) OVER (PARTITION BY h, doc_id, n_bytes) AS least FROM b) z, t WHERE depth = least
"""
