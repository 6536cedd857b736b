"""Which keys records have, which of them are new, and metadata merged with what is known."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys(records: DataFrame, raw: str = "RAW_RECORD") -> DataFrame:
    """The distinct top-level keys of JSON records."""
    return records.select(F.explode(F.json_object_keys(raw)).alias("column_name")).filter("column_name is not null").distinct()


def new_keys(found: DataFrame, known: DataFrame) -> DataFrame:
    return found.select("column_name").subtract(known.select("column_name"))


def merge(source: DataFrame, existing: DataFrame) -> DataFrame:
    """Columns by name without regard to case: the source's tests, its description unless empty; what only one side has stays.

    source: column_name, description, is_nullable, custom_tests array<string>; existing: column_name, description, tests.
    """
    s = source.select(F.lower("column_name").alias("k"), F.col("column_name").alias("s_name"), F.coalesce("description", F.lit("")).alias("s_description"), tests().alias("s_tests"))
    e = existing.select(F.lower("column_name").alias("k"), F.col("column_name").alias("e_name"), F.col("description").alias("e_description"), F.col("tests").alias("e_tests"))
    both = s.join(e, "k", "full")
    return both.select(
        "k",
        F.coalesce("e_name", "s_name").alias("column_name"),
        F.when(F.col("s_name").isNull(), F.col("e_description")).otherwise(F.coalesce(F.nullif("s_description", F.lit("")), "e_description", F.lit(""))).alias("description"),
        F.coalesce("s_tests", "e_tests").alias("tests"),
        F.when(F.col("e_name").isNull(), "added").when(F.col("s_name").isNull(), "kept").otherwise("merged").alias("origin"),
    )


def yml(model: str, merged: DataFrame) -> str:
    """A schema file of a model from merge()'s rows, columns in order; a table's metadata is small."""
    lines = ["version: 2", "models:", f"  - name: {json.dumps(model)}", "    columns:"]
    for r in merged.select("column_name", "description", "tests").orderBy("column_name").collect():
        lines += [f"      - name: {json.dumps(r['column_name'])}", f"        description: {json.dumps(r['description'] or '')}"]
        lines += ["        tests:", *(f"          - {t}" for t in r["tests"])] if r["tests"] else []
    return "\n".join(lines) + "\n"


def write_yml(content: str, path: str, dry_run: bool = False) -> str:
    """Write a schema file of the driver, or in a dry run only return what would be written."""
    if not dry_run:
        with open(path, "w", encoding="utf-8") as f:
            f.write(content)
    return content


def tests():
    """not_null for what may not be null, then a column's own tests."""
    return F.concat(F.when(~F.col("is_nullable"), F.array(F.lit("not_null"))).otherwise(F.array().cast("array<string>")), F.coalesce("custom_tests", F.array().cast("array<string>")))


def read_tests(text):
    """A list of tests from a list that is written as text, null if it is none."""
    return F.from_json(F.regexp_replace(text, "'", '"'), "array<string>")
