"""Text cleaning and address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# States that count as states of the US, those that count as near, the home state, and street words that
# an address pattern may take for a state.
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
]
NEARBY_STATES = ["OK", "LA", "NM", "AR"]
HOME_STATE = "TX"
STREET_WORDS = ["ST", "RD", "DR", "LN", "AVE", "CT", "PL", "WAY", "CIR"]


def blank(x: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(x, F.lit(""))


def squeeze(x: Column) -> Column:
    """Runs of white space as one space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(blank(x), r"\s+", " "))


def empty_as_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def first_match(x: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without one (and where the group is empty)."""
    return empty_as_null(F.regexp_extract(x, pattern, group))


def no_nan(x: Column) -> Column:
    """Upper case, trimmed; null and the text NAN as empty."""
    t = F.upper(F.trim(blank(x)))
    return F.when(t == "NAN", "").otherwise(t)


def state_of(address: Column) -> Column:
    """Two letters that stand where a state stands; UNKNOWN if none do.

    In this order: after a comma and before a ZIP code; before a ZIP code, unless a street word; at the end, unless a
    street word.
    """
    a = F.upper(address)
    before_zip, last = first_match(a, r"\s+([A-Z]{2})\s+\d{5}"), first_match(a, r"\s+([A-Z]{2})\s*$")
    return F.coalesce(
        first_match(a, r",\s*([A-Z]{2})\s+\d{5}"),
        F.when(~before_zip.isin(STREET_WORDS), before_zip),
        F.when(~last.isin(STREET_WORDS), last),
        F.lit("UNKNOWN"),
    )


def valid_state(raw: Column) -> Column:
    return F.when(raw.isin(US_STATES) | (raw == "UNKNOWN"), raw).otherwise("FOREIGN")


def location_type(raw: Column) -> Column:
    return F.when(raw == HOME_STATE, "SAME_STATE").when(raw.isin(NEARBY_STATES), "NEARBY_STATE").when(raw.isin(US_STATES), "US_OTHER").when(raw != "UNKNOWN", "FOREIGN").otherwise("UNKNOWN")


def label_key(label: Column) -> Column:
    """A field name from a printed label, standard names for the five known ones."""
    k = F.regexp_replace(F.lower(blank(label)), r"[:()]", "")
    k = F.regexp_replace(F.trim(k), r"[\s/\-]+", "_")
    k = F.regexp_replace(k, r"^_+|_+$", "")
    return (
        F.when(k.contains("foundation_type"), "foundation_type")
        .when(k.contains("exterior_wall"), "exterior_wall")
        .when(k.contains("heating_ac"), "heating_ac")
        .when(k.contains("grade_adjustment"), "grade_adjustment")
        .when(k.contains("physical_condition"), "physical_condition")
        .otherwise(k)
    )


def account_in(url: Column) -> Column:
    return first_match(url, r"(?i)acct=(\d+)")
