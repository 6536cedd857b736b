"""What the corpus operators share: reading tables, cutting lineage, connected components."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python worker makes objects of at once: texts may be long, so few.
BATCH_ROWS = 128
#: Settings under which operators run jobs of their own: what a worker holds at once is bounded by rows and by bytes, joins may
#: prune by Bloom filters, and a job's shuffle files go when it ends.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_made: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def tuned(spark: SparkSession):
    """SETTINGS for the length of a block; then the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def collect(df: DataFrame) -> list:
    """Rows of a small result of a job under SETTINGS."""
    with tuned(df.sparkSession):
        return df.collect()


def is_empty(df: DataFrame) -> bool:
    with tuned(df.sparkSession):
        return df.isEmpty()


def sliced(batches, rows: int = BATCH_ROWS):
    """Arrow batches in slices of few rows, for frames that are handed back and run under whatever settings the caller has."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def pressed(raw: bytes) -> bytes:
    import pyarrow as pa

    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def plain(raw: bytes) -> bytes:
    import pyarrow as pa

    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def planes(a: np.ndarray, kind: str = "<i8") -> bytes:
    """Numbers, byte by byte of all, which compresses well, compressed."""
    return pressed(a.astype(kind).view(np.uint8).reshape(len(a), np.dtype(kind).itemsize).T.tobytes())


def from_planes(raw: bytes, kind: str = "<i8") -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(plain(raw), np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", base)
        own(spark, base)
    return base


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the JVM may have gone first
            return


def own(spark: SparkSession, path: str) -> None:
    """Have a path deleted when the driver ends."""
    _made.append((spark, path))


def keep(df: DataFrame, tag: str, files: int | None = None, by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there and a lost executor loses nothing.

    by: a column whose values get folders of their own, which drop() can delete one at a time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    writer = (df.coalesce(files) if files else df).write.option("compression", "zstd")
    own(spark, path)
    with tuned(spark):
        (writer.partitionBy(by) if by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_path = path
    return out


def drop(df: DataFrame, part: str | None = None) -> None:
    """Delete what keep() wrote, or the folder column=value of it, once nothing reads it any more."""
    path = getattr(df, "_kept_path", None)
    if path:
        _delete(df.sparkSession, f"{path}/{part}" if part else path)
        if not part:
            _made[:] = [x for x in _made if x[1] != path]


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges of each partition as stars: every node of it to the least that it reaches within the partition."""
    import pyarrow as pa

    def run(batches):
        top: dict = {}

        def find(x):
            while top.setdefault(x, x) != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    top[max(a, b)] = min(a, b)
        pairs = [(x, find(x)) for x in list(top)]
        pairs = [p for p in pairs if p[0] != p[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of edges (a, b), both long: rows (node, component), component the smallest node reachable.

    Each partition's edges are contracted where they lie. Then alternating star contraction: each round every node
    hands its larger neighbours, then its smaller ones, to the smallest node it knows. Minima are combined before the
    shuffle and joins are plain equi-joins that Spark may split, so one node with very many neighbours does not fill a
    task. Nodes without edges are not returned.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    cur = keep(_contracted(edges), "edges")
    for _ in range(rounds):
        # A star forest: no node that points at another is pointed at, or points twice.
        ends = cur.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(cur.select("b", F.lit(0), F.lit(1)).distinct())
        if is_empty(ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or (out > 0 and into > 0)")):
            break
        # Larger neighbours of a go to the least of a and its neighbours.
        sym = cur.union(cur.select("b", "a"))
        low = smallest(sym).select("a", F.least("a", "m").alias("m"))
        large = sym.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Smaller neighbours of a, and a, go to the least of them.
        low = smallest(large)
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        nxt = keep(small, "edges")
        drop(cur)
        cur = nxt
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
