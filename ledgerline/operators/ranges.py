"""Ranges of dates that are halved until what a search of each returns fits a limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import dates
from ledgerline.sources import files

#: Fixed value: the records that one search may return.
MOST = 400


def _halved(df: DataFrame, day: str | None = None) -> DataFrame:
    """Rows of (first, last) with the half that their day falls in; without a day a row for either half."""
    h = df.withColumn("__h", dates.halves(F.col("first"), F.col("last")))
    if day is None:
        h = h.withColumn("__h", F.explode("__h"))
    else:
        h = h.withColumn("__h", F.when(F.col(day) <= F.col("__h")[0]["last"], F.col("__h")[0]).otherwise(F.col("__h")[1]))
    return h.withColumns({"first": F.col("__h.first"), "last": F.col("__h.last")}).drop("__h")


def bounds(records: DataFrame, day: str, keys: list[str]) -> DataFrame:
    """The range of each key's days: keys, first, last."""
    return records.filter(F.col(day).isNotNull()).groupBy(*keys).agg(F.min(day).alias("first"), F.max(day).alias("last")).filter("first is not null")


def split(records: DataFrame, day: str, keys: list[str], whole: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """keys, first, last, n, level: ranges that together hold every day of a key's whole range once, n records in each.

    A range with more than the most records is halved at its middle day, if it has more than one day; so each range fits or
    is one day long. Ranges without a record are there too: whoever searches finds out only by searching. whole: the ranges
    to begin with (keys, first, last), from each key's first to its last day if not given; records outside them and without
    a day are not counted, null keys are a key. Level 0 are the whole ranges.

    Records are folded to one row a key and day. A level is one aggregate and one join by key and range, never a join of
    ranges with days: each day knows the range that it lies in, and days of a range that is halved move to their half. Only
    what is still too large goes on; there are at most as many levels as halvings down to one day, and each is written, so
    plans do not grow from level to level. An empty table gives no ranges.
    """
    at = [*keys, "first", "last"]
    whole = bounds(records, day, keys) if whole is None else whole
    perday = records.filter(F.col(day).isNotNull()).groupBy(*keys, F.col(day).alias("__day")).agg(F.count("*").alias("__n"))
    same = lambda a, b, names: [a[k].eqNullSafe(b[k]) for k in names]
    left = files.kept(whole.select(*at), "ranges")
    inside = F.col("__day").between(F.col("first"), F.col("last"))
    if keys:  # one row a key meets its days
        lies = perday.join(left, same(perday, left, keys)).filter(inside).select(*[perday[k] for k in keys], "__day", "__n", "first", "last")
    else:  # without keys there is one range
        lies = perday.join(F.broadcast(left.limit(1)), inside)
    counts = files.kept(lies, "days")
    done, level = None, 0
    while True:
        sums = counts.groupBy(*at).agg(F.sum("__n").alias("__sum"))
        found = left.join(sums, same(left, sums, at), "left").select(*[left[c] for c in at], F.coalesce("__sum", F.lit(0)).cast("bigint").alias("n"), F.lit(level).alias("level"))
        found = files.kept(found, "level")
        large = (F.col("n") > most) & (F.col("first") < F.col("last"))
        done = found.filter(~large) if done is None else done.unionByName(found.filter(~large))
        large = found.filter(large).select(*at)
        if large.isEmpty():
            return done
        left = _halved(large)
        counts = files.kept(_halved(counts.join(large, same(counts, large, at), "left_semi"), "__day"), "days")
        level += 1


def assigned(records: DataFrame, day: str, keys: list[str], found: DataFrame) -> DataFrame:
    """Records with the range (first, last) that their day lies in, by equality: each range is one row a day. Records without a day are left out."""
    days = found.select(*[F.col(k).alias(f"__{k}") for k in keys], "first", "last", F.explode(F.sequence("first", "last")).alias("__day"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys] + [F.col(day) == F.col("__day")]
    return records.join(days, same).drop("__day", *[f"__{k}" for k in keys])
