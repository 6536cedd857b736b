"""Files between the steps of a pipeline, in any store that Spark can open."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, sep: str = ";", schema: str | None = None, filled: bool = False) -> DataFrame:
    """Delimited text with a header and quoted fields that may hold line ends. All columns are text unless a schema is given."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.na.fill("") if filled else df


def write(df: DataFrame, path: str, sep: str = ";", quote_all: bool = False, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("quoteAll", quote_all).csv(path)


def listing(spark: SparkSession, folder: str, pattern: str = "*.csv", but: str = "") -> DataFrame:
    """(path, changed) of files of a folder whose name fits; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    rows = files.select("path", F.col("modificationTime").alias("changed"))
    return rows.filter(~F.col("path").endswith(but)) if but else rows


def newest(spark: SparkSession, folder: str, pattern: str = "*.csv", but: str = "") -> str | None:
    """The file that was changed last, by name among equals; None if there is none."""
    row = listing(spark, folder, pattern, but).agg(F.max(F.struct("changed", "path")).alias("m")).first()
    return row["m"]["path"] if row["m"] else None


def scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def rebuild(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def kept(df: DataFrame, name: str) -> DataFrame:
    """A frame written to the shared folder and read back: what is built on it does not build it again, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    goes(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def goes(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the application ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
