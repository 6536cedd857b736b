"""Every query by name, with the operators that it covers and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function as a query of its own name."""

    def put(f):
        CATALOGUE[f.__name__] = Query(f, tuple(covers.split()), sql)
        return f

    return put


def _load() -> None:
    from . import editions_q, functions_q, leads_q, linkage_q, property_q, ranges_q, records_q, reports_q, states_q  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: q.run for k, q in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in CATALOGUE.items() if q.sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty leads with the highest scores and their reasons."""
    from .leads_q import scored

    return scored(spark, sf_dir).select("lead_id", "probate_lead_case_number", "r_score_acquisition", F.array_join("reasoning_array", " | ").alias("reasons")).orderBy(F.desc("r_score_acquisition"), "lead_id").limit(20)
