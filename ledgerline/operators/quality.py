"""Checks of data: each returns the rows, or counts of rows, that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures): how many rows of each column are null, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counted.select(F.explode(pairs).alias("p")).select("p.*")


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """(value, failures): values that are not in the list; null is no value."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("failures"))


def without(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Rows in which any of some texts is null or empty."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | c.isNull() | (c == "")
    return df.filter(bad)


def run(df: DataFrame, tests: list[tuple[str, str]]) -> DataFrame:
    """(column_name, test, failures) of not_null and unique tests, by name."""
    flat = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"), (F.count_if(F.col(c).isNull()) if t == "not_null" else F.count(c) - F.count_distinct(c)).alias("failures")) for c, t in tests]
    return df.agg(F.array(*flat).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    return [c for c in needed if c not in df.columns]


def wrong_delimiter(df: DataFrame) -> bool:
    """One column only: most likely the file was split by another sign."""
    return len(df.columns) <= 1
