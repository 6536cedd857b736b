"""Links of people in court filings to parties of deeds: features, weighted score, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import dates, names, numbers, similarity
from ledgerline.functions.text import blank

# Weights of the features; they sum to 0.90.
WEIGHTS = {"name_last_score": 0.25, "name_first_score": 0.10, "date_proximity_score": 0.20, "party_role_score": 0.10, "instrument_weight": 0.15, "search_tier_weight": 0.10}
# Weights of instruments and, by how a tier's name begins, of search tiers; 25 for others.
INSTRUMENTS = {"W/D": 100, "DEED": 95, "GIFT DEED": 90, "QUIT CLAIM DEED": 80, "D/T": 30, "RELEASE OF LIEN": 20, "MODIF": 15, "NOTICE": 10}
TIERS = {"TIER_1": 100, "TIER_2": 75, "TIER_3": 50}
OTHER = 25
HIGH, MEDIUM = 80, 60


def filing_signal(kind: Column, subtype: Column) -> Column:
    """0 to 5, by what a case's type and subtype say."""
    c = F.lower(F.trim(F.concat(blank(kind), F.lit(" "), blank(subtype))))
    has = c.contains
    return (
        F.when(has("probate of will") | has("letters testamentary") | has("application for probate"), 5)
        .when(has("independent administration") & (has("with will annexed") | has("heirship")), 4)
        .when(has("ancillary administration"), 3)
        .when(has("dependent administration") | has("will deposit"), 2)
        .when(has("muniment of title"), 1)
        .otherwise(0)
    )


def deed_signal(description: Column, lot: Column, block: Column, filed: Column, recorded: Column) -> Column:
    """0 to 4: a description, a lot or block, and how near the dates are."""
    days = F.abs(F.date_diff(recorded, filed))
    there = lambda x: F.trim(blank(x)) != ""
    return F.when(there(description), 1).otherwise(0) + F.when(there(lot) | there(block), 1).otherwise(0) + F.when(days <= 180, 2).when(days <= 365, 1).otherwise(0)


def nearness(days: Column) -> Column:
    return F.when(days < 180, 100).when(days < 365, 50).otherwise(0)


def role_score(role: Column) -> Column:
    return F.when(F.upper(F.trim(role)) == "GRANTOR", 100).otherwise(0)


def instrument_weight(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in INSTRUMENTS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(F.trim(kind))), F.lit(OTHER))


def tier_weight(tier: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for k, w in TIERS.items():
        out = out.when(F.upper(F.trim(tier)).startswith(k), w)
    return out.otherwise(OTHER)


def features(pairs: DataFrame) -> DataFrame:
    """Cleaned names, phonetic keys and the six features of pairs (decedent_*, party_*, filing_date, rp_file_date, rp_party_type, rp_instrument_type, rp_search_tier).

    Names are alike over and over, so they are cleaned and compared once for each two of them.
    """
    out = pairs
    for n in ("last", "first"):
        two = pairs.select(F.col(f"decedent_{n}").alias("__d"), F.col(f"party_{n}").alias("__p")).distinct()
        two = two.withColumns({f"cleaned_decedent_{n}": names.cleaned(F.col("__d")), f"cleaned_party_{n}": names.cleaned(F.col("__p"))})
        own = {f"name_{n}_score": similarity.ratio(F.col(f"cleaned_decedent_{n}"), F.col(f"cleaned_party_{n}"))}
        if n == "last":
            own |= {f"soundex_{who}_last": similarity.sounds(F.col(f"cleaned_{who}_last")) for who in ("decedent", "party")}
        two = two.withColumns(own)
        out = out.join(two, out[f"decedent_{n}"].eqNullSafe(two["__d"]) & out[f"party_{n}"].eqNullSafe(two["__p"])).drop("__d", "__p")
    return out.withColumns(
        {
            "days_apart": dates.apart(F.col("rp_file_date"), F.col("filing_date")),
            "date_proximity_score": nearness(dates.apart(F.col("rp_file_date"), F.col("filing_date"))),
            "party_role_score": role_score(F.col("rp_party_type")),
            "instrument_weight": instrument_weight(F.col("rp_instrument_type")),
            "search_tier_weight": tier_weight(F.col("rp_search_tier")),
        }
    )


def score(featured: DataFrame) -> DataFrame:
    total = F.lit(0.0)
    for k, w in WEIGHTS.items():
        total = total + numbers.or_zero(F.col(k)) * w
    out = featured.withColumn("match_score_total", numbers.clipped(total))
    level = F.when(F.col("match_score_total") >= HIGH, "High").when(F.col("match_score_total") >= MEDIUM, "Medium").otherwise("Low")
    return out.withColumn("match_confidence_level", level).withColumn("is_potential_decedent_match", F.col("match_confidence_level").isin("High", "Medium"))


def link(pairs: DataFrame) -> DataFrame:
    return score(features(pairs))


def qa_sample(linked: DataFrame, key: str, size: int = 25, shares: tuple[tuple[str, int], ...] = (("High", 10), ("Medium", 8), ("Low", 7))) -> DataFrame:
    """Up to so many rows of each level by score, then low ones from their first on until ``size`` are drawn, without repeats.

    Rows drawn again are dropped, so a refill may leave the sample short. Rows are cut to the best of each level in many
    buckets first, so that no level has to fit one task; what is left for the last step is bounded.
    """
    order = [F.desc("match_score_total"), F.asc(key)]
    bucket = F.pmod(F.xxhash64(key), F.lit(64))
    some = linked.withColumn("level_rank", F.row_number().over(Window.partitionBy("match_confidence_level", bucket).orderBy(*order))).filter(F.col("level_rank") <= size)
    rank = Window.partitionBy("match_confidence_level").orderBy(*order)
    tops = some.withColumn("level_rank", F.row_number().over(rank)).filter(F.col("level_rank") <= size)
    # At most size rows a level: how many each has, up to that, is all that the shares depend on.
    all_rows = Window.partitionBy()
    left, n = F.lit(size), {}
    for level, share in shares:
        n[level] = F.least(F.count_if(F.col("match_confidence_level") == level).over(all_rows), F.lit(share), left)
        left = left - n[level]
    drawn = tops.withColumns({f"n_{k}": v for k, v in n.items()})
    last = shares[-1][0]
    keep = F.col("match_confidence_level").isNull()
    for level, _ in shares:
        most = F.col(f"n_{level}")
        if level == last:
            most = F.greatest(most, F.lit(size) - sum((F.col(f"n_{k}") for k, _ in shares), F.lit(0)))
        keep = keep | ((F.col("match_confidence_level") == level) & (F.col("level_rank") <= most))
    return drawn.filter(keep).select(*linked.columns, "level_rank")
