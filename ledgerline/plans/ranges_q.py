"""Ranges of dates, split until a search of each fits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.functions import dates
from ledgerline.operators import ranges
from ledgerline.sources import files, saved

from . import derive
from .registry import query

C = F.col
#: Filings: of one priority far more a day than a search returns, of the others a few.
FILINGS = """SELECT o_orderkey AS id, o_orderpriority AS court, CASE WHEN o_orderkey % 47 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN CAST('1995-03-17' AS date) ELSE CAST(o_orderdate AS date) END AS day FROM orders"""
RANGES = f"""f AS ({FILINGS}), d AS (SELECT court, day, count(*)::BIGINT AS n FROM f WHERE day IS NOT NULL GROUP BY ALL),
w AS (SELECT court, min(day) AS first, max(day) AS last, sum(n)::BIGINT AS n FROM d GROUP BY court),
r AS (SELECT court, first, last, n, 0 AS level FROM w
UNION ALL SELECT h.court, h.first, h.last, coalesce((SELECT sum(n) FROM d WHERE d.court = h.court AND d.day BETWEEN h.first AND h.last), 0)::BIGINT, h.level FROM (
    SELECT court, CASE WHEN side = 0 THEN first ELSE first + ((last - first) // 2 + 1)::INTEGER END AS first, CASE WHEN side = 0 THEN first + ((last - first) // 2)::INTEGER ELSE last END AS last, level + 1 AS level FROM r, range(0, 2) s(side) WHERE n > 400 AND first < last) h),
g AS (SELECT * FROM r WHERE n <= 400 OR first = last)"""


@query("SRC13 DAT05", f"""WITH RECURSIVE {RANGES}
SELECT court, strftime(first, '%Y-%m-%d') AS first, strftime(last, '%Y-%m-%d') AS last, n, level FROM g""")
def split_ranges(spark, sf_dir):
    """Every day of all filings in one range: each fits a search, or is one day."""
    found = ranges.split(derive.relation(spark, sf_dir, FILINGS), "day", ["court"])
    return found.select("court", dates.written(C("first")).alias("first"), dates.written(C("last")).alias("last"), "n", "level")


@query("SRC13 SRC14 SRC16 SRC17", f"""WITH RECURSIVE {RANGES}, p AS (SELECT f.*, g.first, g.last, row_number() OVER (PARTITION BY f.court, g.first, g.last ORDER BY id) AS nth FROM f JOIN g ON f.court = g.court AND f.day BETWEEN g.first AND g.last)
SELECT id, court, strftime(day, '%Y-%m-%d') AS day, strftime(first, '%Y-%m-%d') AS first, ((nth - 1) // 20 + 1)::INTEGER AS page, ((nth - 1) % 20 + 1)::INTEGER AS row_no FROM p WHERE nth <= 400 AND day >= DATE '1994-06-01' AND day < DATE '1997-01-01'""")  # fmt: skip
def saved_scans(spark, sf_dir):
    """Filings laid out as the pages that a scan of each range saves, read back by the data source with a filter on their dates."""
    filings = derive.relation(spark, sf_dir, FILINGS)
    whole = ranges.assigned(filings, "day", ["court"], ranges.split(filings, "day", ["court"]))
    rows = whole.withColumn("filed", F.date_format("day", "MM/dd/yyyy"))
    path = f"{files.scratch(spark)}/scans-{uuid.uuid4().hex}"
    saved.write(saved.pages_of(rows, ["court", "first", "last"], "id", {"Case": "id", "Filed": "filed"}), path, ("court",))
    files.goes(spark, path)
    saved.register(spark)
    read = spark.read.format("saved_pages").option("columns", "Case").option("date", "Filed").option("keys", "court").load(path)
    w = dates.written
    return read.filter("day >= DATE '1994-06-01' AND day < DATE '1997-01-01'").select(C("Case").cast("bigint").alias("id"), "court", w(C("day")).alias("day"), w(C("first")).alias("first"), "page", "row_no")
