"""Containment search over a stored index: postings of stretches of three characters, bucketed, so that a search never moves them.

The index is written once, as two tables that are bucketed and sorted by the stretch: how many texts each has, and in which
it stands. A query's rarest few stretches are looked up and their postings intersected; the contains test is for what is
left. A stretch that very many texts have is dealt over several buckets by a second key, so that none holds it whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import files

GRAM = 3
#: Stretches of a query that are intersected, at most.
RAREST = 3
#: Postings of a stretch under one second key, about.
PART = 1 << 20


def stretches(x: Column, n: int) -> Column:
    """All stretches of n characters; a shorter text is one itself."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - (n - 1), F.lit(1))), lambda i: F.substring(x, i, n))


def grams(x: Column) -> Column:
    """Distinct stretches of three characters; an empty text has none."""
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(stretches(x, GRAM)))


@dataclass(frozen=True)
class Index:
    """Names of the tables: counts (gram, n, parts), postings (gram, part, id), texts (id, text)."""

    counts: str
    postings: str
    texts: str


def write(texts: DataFrame, id: str, text: str, name: str, path: str | None = None, buckets: int | None = None, part: int = PART) -> Index:
    """The index of a table (id, text), as tables name_counts, name_postings and name_texts in the warehouse, or below a path.

    ids are taken to be unique and not null; null and empty texts are found by nothing. An empty table gives an empty index.
    """
    spark = texts.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = texts.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def save(df: DataFrame, what: str, by: list[str]) -> str:
        table = f"{name}_{what}"
        writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
        (writer.option("path", f"{path}/{what}") if path else writer).saveAsTable(table)
        return table

    each = own.select("id", F.explode(grams(F.col("text"))).alias("gram"))
    counts = save(each.groupBy("gram").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / part).cast("int")), "counts", ["gram"])
    large = spark.table(counts).filter("parts > 1").select("gram", "parts")
    dealt = each.join(large, "gram", "left").select("gram", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("part"), "id")
    return Index(counts, save(dealt, "postings", ["gram", "part"]), save(own, "texts", ["id"]))


def drop(spark: SparkSession, index: Index) -> None:
    for table in (index.counts, index.postings, index.texts):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def candidates(index: Index, asked: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(query, id): the texts that have all of a query's rarest stretches. asked: distinct queries, column query.

    A query with a stretch that no text has has none. Queries of fewer than three characters are looked up in the
    stretches themselves: by equality, as each has but few parts; their candidates are hits. Empty queries have none.
    """
    spark = asked.sparkSession
    counts, postings = spark.table(index.counts), spark.table(index.postings)
    long = asked.filter(F.length("query") >= GRAM).select("query", F.explode(grams(F.col("query"))).alias("gram"))
    known = long.join(counts, "gram", "left")
    # The least n come first; one that is nowhere ends the query.
    chosen = known.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "parts"))), 1, rarest).alias("c")).filter(F.col("c")[0]["n"] > 0)
    wanted = chosen.select("query", F.size("c").alias("want"), F.explode("c").alias("c")).select("query", "want", "c.gram", F.explode(F.sequence(F.lit(0), F.col("c.parts") - 1)).alias("part"))
    both = wanted.join(postings, ["gram", "part"]).groupBy("query", "id", "want").agg(F.count("*").alias("have")).filter("have = want").select("query", "id")
    short = asked.filter(F.length("query").between(1, GRAM - 1))
    pieces = F.array_distinct(F.flatten(F.array(*[stretches(F.col("gram"), n) for n in range(1, GRAM)])))
    found = counts.select("gram", "parts", F.explode(pieces).alias("query")).join(short, "query").select("query", "gram", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return both.unionByName(found.join(postings, ["gram", "part"]).select("query", "id").distinct())


def search(index: Index, asked: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(query, id, text) of the texts that contain a query; asked may repeat queries, and null ones find nothing."""
    pairs = candidates(index, asked.select("query").filter("query is not null").distinct(), rarest)
    return pairs.join(asked.sparkSession.table(index.texts), "id").filter(F.contains("text", "query")).select("query", "id", "text")


def scratch(texts: DataFrame, id: str, text: str, **options) -> Index:
    """write() with tables that last as long as the application, their files in the shared folder."""
    spark = texts.sparkSession
    name = f"grams_{uuid.uuid4().hex}"
    path = f"{files.scratch(spark)}/{name}"
    files.goes(spark, path)
    return write(texts, id, text, name, path, **options)
