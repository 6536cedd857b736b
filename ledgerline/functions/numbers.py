"""Conversions that give null instead of failing, and the roundings that results depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def currency(x: Column) -> Column:
    """A money text as double: without $ and commas; empty, pending and anything else as null."""
    t = F.trim(F.regexp_replace(x.cast("string"), r"[$,]", ""))
    return F.when(F.lower(t).isin("", "pending"), None).otherwise(t.try_cast("double"))


def first_number(x: Column) -> Column:
    """The first number in a text, commas left out."""
    return F.regexp_replace(F.regexp_extract(x, r"(-?[\d,]*\.?\d+)", 1), ",", "").try_cast("double")


def whole(x: Column) -> Column:
    """A text as a whole number of up to 38 digits, halves away from zero."""
    return x.try_cast("decimal(38,0)")


def flag(x: Column) -> Column:
    return x.try_cast("boolean")


def or_zero(x: Column) -> Column:
    return F.coalesce(x.try_cast("double"), F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def clipped(x: Column) -> Column:
    """Into 0 to 100, two decimals."""
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), x)), 2)


def half_even(x: Column) -> Column:
    """To the nearest whole number, halves to the even one."""
    return F.rint(x)


def percent(part: Column, total: Column) -> Column:
    return F.round(part * 100.0 / total, 2)
