"""New records as they come: the same operators over a stream of files, each batch scored and appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import rules, staging


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Load-table rows from Parquet files as they arrive in a folder."""
    schema = "PROBATE_CASE_NUMBER string, HCAD_ACCOUNT_ID string, SCRAPE_TIMESTAMP timestamp, SOURCE_FILENAME string, HCAD_LOT_SQFT_TOTAL double, RAW_RECORD string"
    return spark.readStream.schema(schema).parquet(folder)


def score(stream: DataFrame, out: str, checkpoint: str, as_of: str):
    """Score each batch into a folder of its own number, so that a batch that is run again overwrites itself."""

    def one(batch: DataFrame, number: int) -> None:
        scored = rules.score(staging.flatten(batch), as_of)
        scored.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
