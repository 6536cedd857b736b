"""Checks that are planned from what a catalog says of a table, and counted while its rows go by.

The catalog gives columns, types, nullability and descriptions; tests beyond these stand in the table's properties, as
tests.<column> = a list such as ['unique', 'accepted:F,O,P']. Spark's own file tables do not keep NOT NULL, so 'not_null' may
stand there too. All counts of a frame are metrics of one observation, which rides along with whatever reads the frame, its
load for one, so checks cost no scan of their own. Only uniqueness needs the values together, and so a job of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import discovery

METADATA = "column_name string, data_type string, is_nullable boolean, description string, custom_tests array<string>"
PROPERTY = "tests."


def metadata(spark: SparkSession, table: str) -> DataFrame:
    """METADATA of a table or view by its catalog, a row a column; as discovery.merge() takes its source. A table's columns are few."""
    properties: dict[str, str] = {}
    if spark.catalog.getTable(table).tableType not in ("VIEW", "TEMPORARY"):
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    rows = [(c.name, c.dataType, c.nullable, c.description, properties.get(f"{PROPERTY}{c.name}")) for c in spark.catalog.listColumns(table)]
    found = spark.createDataFrame(rows, "column_name string, data_type string, is_nullable boolean, description string, custom string")
    tests = F.coalesce(discovery.read_tests(F.col("custom")), F.array().cast("array<string>"))
    required = ~F.col("is_nullable") | F.array_contains(tests, "not_null")
    return found.select("column_name", "data_type", (~required).alias("is_nullable"), "description", F.filter(tests, lambda t: t != "not_null").alias("custom_tests"))


@dataclass(frozen=True)
class Assertion:
    """What must hold of a column: present, known, not_null, type, accepted or unique; argument: the type, or the values by commas."""

    column: str
    test: str
    argument: str = ""


def planned(described: DataFrame, columns: list[str]) -> list[Assertion]:
    """Assertions about a frame of these columns from a table's metadata. Names are compared without regard to case; an unknown test is an error."""
    there = {c.lower(): c for c in columns}
    out: list[Assertion] = []
    named = set()
    for r in described.orderBy("column_name").collect():
        named.add(r["column_name"].lower())
        name = there.get(r["column_name"].lower())
        if name is None:
            out.append(Assertion(r["column_name"], "present"))
            continue
        out.append(Assertion(name, "type", r["data_type"]))
        if not r["is_nullable"]:
            out.append(Assertion(name, "not_null"))
        for t in r["custom_tests"] or []:
            kind, _, argument = t.partition(":")
            if kind not in ("unique", "accepted"):
                raise ValueError(f"unknown test {t!r} of {name}")
            out.append(Assertion(name, kind, argument))
    return out + [Assertion(c, "known") for c in columns if c.lower() not in named]


def failing(df: DataFrame, a: Assertion) -> Column | None:
    """How many rows break an assertion, as an aggregate; None where that needs values of other rows.

    A value breaks its type if it is there and cannot be cast to it. Null is no value of accepted's. An assertion on the
    columns themselves is broken by each row.
    """
    own = F.col(f"`{a.column}`")
    if a.test in ("present", "known"):
        return F.count(F.lit(1))
    if a.test == "not_null":
        return F.count_if(own.isNull())
    if a.test == "type":
        return F.lit(0).cast("long") if df.schema[a.column].dataType.simpleString() == a.argument else F.count_if(own.isNotNull() & own.try_cast(a.argument).isNull())
    if a.test == "accepted":
        return F.count_if(own.isNotNull() & ~own.cast("string").isin(a.argument.split(",")))
    return None


def observed(df: DataFrame, assertions: list[Assertion], observation: Observation) -> DataFrame:
    """The frame with the counts of its broken assertions as metrics, which the observation has after the first job that reads it whole."""
    counts = {f"m{i}": failing(df, a) for i, a in enumerate(assertions)}
    # An observation holds aggregates only; a constant becomes one.
    metrics = [(F.max(c) if a.test == "type" and df.schema[a.column].dataType.simpleString() == a.argument else c).alias(n) for a, (n, c) in zip(assertions, counts.items()) if c is not None]
    return df.observe(observation, *metrics) if metrics else df


def failures(df: DataFrame, assertions: list[Assertion], observation: Observation | None = None) -> DataFrame:
    """(column_name, test, failures long): an assertion a row. Without an observation that has been taken the frame is read once for it.

    unique: the rows, without null, beyond the first of each value; the column alone is read, combined before the shuffle,
    all such columns in one job. An empty frame breaks nothing; columns of a frame that lacks rows neither.
    """
    spark = df.sparkSession
    if observation is None:
        observation = Observation()
        observed(df, assertions, observation).write.format("noop").mode("overwrite").save()
    counts = observation.get if any(failing(df, a) is not None for a in assertions) else {}
    rows = [(a.column, a.test, int(counts[f"m{i}"] or 0)) for i, a in enumerate(assertions) if f"m{i}" in counts]
    out = spark.createDataFrame(rows, "column_name string, test string, failures long")
    single = [a.column for a in assertions if a.test == "unique"]
    if single:
        values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in single])).alias("v")
        each = df.select(values).select("v.*").filter("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("n"))
        more = each.groupBy("column_name").agg(F.sum(F.col("n") - 1).alias("failures"))
        named = spark.createDataFrame([(c,) for c in single], "column_name string")
        out = out.unionByName(named.join(more, "column_name", "left").select("column_name", F.lit("unique").alias("test"), F.coalesce("failures", F.lit(0)).alias("failures")))
    return out


def load(df: DataFrame, table: str, described: DataFrame | None = None) -> DataFrame:
    """Append a frame to a table, by its types, and give the failures that were counted on the way; values that do not fit are null.

    Columns that the table lacks are left out, those that the frame lacks are null.
    """
    spark = df.sparkSession
    described = metadata(spark, table) if described is None else described
    assertions = planned(described, df.columns)
    seen = Observation()
    there = {c.lower(): c for c in df.columns}
    rows = observed(df, assertions, seen)
    own = [(F.col(f"`{there[c.name.lower()]}`").try_cast(c.dataType) if c.name.lower() in there else F.lit(None).cast(c.dataType)).alias(c.name) for c in spark.catalog.listColumns(table)]
    rows.select(*own).write.mode("append").saveAsTable(table)
    return failures(df, assertions, seen)
