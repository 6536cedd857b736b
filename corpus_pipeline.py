"""The corpus pipeline: what is toxic goes, near duplicates go, benchmark passages go, personal data is blanked, and the rest is packed.

Each stage takes (spark, docs, sf_dir) and gives the next one its documents; ``run`` writes each stage's result to the
shared folder as Parquet and rereads it. The last stage returns a row a piece, as packing.digest does. An empty table
gives an empty table in every stage; columns beside doc_id and text are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import common, decontam, jaccard, packing, pii, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go, as toxicity.clean. Null and empty texts score as texts without evidence; rows of one doc_id, a null one too, stay or go together."""
    return toxicity.clean(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays, as jaccard.dedupe. Null and empty texts link with nothing; a null doc_id stays."""
    return jaccard.dedupe(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, as decontam.clean. Texts without words are clean; rows of one doc_id, a null one too, go if any of them is contaminated."""
    return decontam.clean(docs, common.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans are replaced by their kinds, as pii.redact; every row stays, a null text null, and n_chars counts the new text."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece, as packing.digest; a null text is packed as its end alone."""
    return packing.digest(docs)


STAGES = [
    ("toxicity", toxic),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("personal data", personal_data),
    ("packing", pack),
]
#: Neither the classifier nor the tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
