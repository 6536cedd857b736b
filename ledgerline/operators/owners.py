"""Who owns a property, set against who died and who signed: scores, types, review reasons, contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import names, numbers, similarity
from ledgerline.functions.text import blank

from .pairs import Pairs

ENOUGH = 80
# Match types in order of precedence, and search outcomes that need no review.
SAME, DIFFERED, DEVIATED, GRANTEE, UNRELATED = "MATCH_PROBATE_DECEDENT_AS_RP_PARTY", "MATCH_PROBATE_DECEDENT_RP_PARTY_DIFFERED", "MATCH_RP_PARTY_PROBATE_DEVIATED", "MATCH_RP_GRANTEE", "HCAD_OWNER_IS_UNRELATED_THIRD_PARTY"
MISSING = "HCAD_OWNER_NAME_MISSING"
FOUND = ["SUCCESS", "SUCCESS_T0_NEEDS_NAME_CONFIRM"]
BENIGN = ["SUCCESS", "SKIPPED_INSUFFICIENT_DATA", "NO_HITS", "COMMON_SURNAME_TOO_BROAD", "NO_QUERY_FORMED"]


def full_name(first: Column, last: Column) -> Column:
    return F.nullif(F.trim(F.concat(F.upper(F.trim(blank(first))), F.lit(" "), F.upper(F.trim(blank(last))))), F.lit(""))


def blend(name: Column, owner: Column, last_share: float, by=similarity) -> Column:
    """Last names and full names in parts, to the nearest whole number, halves to even; 0 without either name. by: what compares."""
    there = (blank(name) != "") & (blank(owner) != "")
    last, guess = names.surname(name), names.owner_surname(owner)
    both = there & (last != "") & (guess != "")
    lasts = F.when(both, by.token_set_ratio(F.when(both, last), F.when(both, guess))).otherwise(0.0)
    return F.when(there, numbers.half_even(lasts * last_share + by.token_set_ratio(F.when(there, name), F.when(there, owner)) * (1 - last_share))).otherwise(0.0)


def scores(rows: DataFrame) -> DataFrame:
    """The four scores of rows (hcad_owner_full_name, decedent_*, party_*, rp_grantee_full_names_list).

    Names are alike over and over, so each two of them are compared once; of grantees each list with each owner.
    """
    names_list = F.coalesce("rp_grantee_full_names_list", F.array().cast("array<string>"))
    base = rows.withColumns({
        "__owner": F.upper(F.trim(blank(F.col("hcad_owner_full_name")))),
        "probate_decedent_full_name": full_name(F.col("decedent_first"), F.col("decedent_last")),
        "rp_party_full_name": full_name(F.col("party_first"), F.col("party_last")),
        "__there": F.col("hcad_search_status").isin(FOUND),
    })
    there = F.coalesce((F.col("__owner") != "") & F.col("__there"), F.lit(False))
    base = base.withColumn("__owner", F.when(there, F.col("__owner"))).withColumn("__list", F.when(there, names_list))
    one = lambda g: F.upper(F.trim(g))
    grantees = base.select(F.col("__owner").alias("__o"), F.explode("__list").alias("__g")).withColumn("__g", one(F.col("__g"))).filter("__g is not null").distinct()
    by = Pairs()
    best = blend(F.col("__g"), F.col("__o"), 0.6, by)
    each = by.without(by.compared(grantees).withColumn("__best", best))
    lists = base.select(F.col("__owner").alias("__o"), F.col("__list").alias("__l")).filter("__l is not null").distinct()
    known = lists.withColumn("__g", F.explode("__l")).withColumn("__g", one(F.col("__g"))).join(each, ["__o", "__g"]).groupBy("__o", "__l").agg(F.max("__best").alias("__best"))
    by = Pairs()
    dead, party, owner = F.col("probate_decedent_full_name"), F.col("rp_party_full_name"), F.col("__owner")
    out = {
        "score_hcad_vs_probate": blend(dead, owner, 0.3, by),
        "score_hcad_vs_rp_party": blend(party, owner, 0.3, by),
        "score_hcad_vs_best_rp_grantee": F.greatest(F.lit(0.0), F.coalesce("__best", F.lit(0.0))),
        "score_probate_vs_rp_party": F.coalesce(by.token_set_ratio(F.when(owner.isNotNull(), dead), F.when(owner.isNotNull(), party)), F.lit(0.0)),
    }
    met = by.compared(base).join(known, (F.col("__owner") == F.col("__o")) & (F.col("__list") == F.col("__l")), "left")
    return by.without(met.withColumns(out)).drop("__owner", "__there", "__list", "__o", "__l", "__best")


def match_type(scored: DataFrame) -> DataFrame:
    """hcad_owner_match_type, is_owner_grantor, is_owner_grantee."""
    c = F.col
    alone = c("rp_party_full_name").isNull() & c("probate_decedent_full_name").isNotNull()
    dead = c("score_hcad_vs_probate") >= ENOUGH
    party = F.when(alone, dead).otherwise(c("score_hcad_vs_rp_party") >= ENOUGH)
    same = alone | (c("score_probate_vs_rp_party") >= ENOUGH)
    kind = F.when(dead & same, SAME).when(dead, DIFFERED).when(party, DEVIATED).when(c("score_hcad_vs_best_rp_grantee") >= ENOUGH, GRANTEE).otherwise(UNRELATED)
    found, named = c("hcad_search_status").isin(FOUND), F.trim(blank(c("hcad_owner_full_name"))) != ""
    out = scored.withColumn("hcad_owner_match_type", F.when(found & named, kind).when(found, MISSING).otherwise(c("hcad_search_status")))
    is_ = lambda *k: F.when(c("hcad_owner_match_type").isin(*k), 1).otherwise(0)
    return out.withColumns({"is_owner_grantor": is_(SAME, DIFFERED, DEVIATED), "is_owner_grantee": is_(GRANTEE)})


def review(typed: DataFrame) -> DataFrame:
    """needs_review_flag and review_reason."""
    c, kind = F.col, F.col("hcad_owner_match_type")
    known = F.coalesce(similarity.token_set_ratio(c("probate_decedent_full_name"), c("hcad_owner_full_name")) >= ENOUGH, F.lit(False))
    # The reasons as they are shown, in order of precedence.
    reason = (
        F.when(~c("hcad_search_status").isin(BENIGN), F.concat(F.lit("HCAD Search Status: "), c("hcad_search_status")))
        .when(c("parsing_error").isNotNull(), F.concat(F.lit("HCAD Detail Page Parsing Error: "), c("parsing_error")))
        .when(kind == DEVIATED, "Review: HCAD Owner matches RP Party, which differs from Probate Lead")
        .when(kind == DIFFERED, "Review: HCAD Owner matches Probate Lead, but RP Party was different")
        .when(kind == UNRELATED, "Review: HCAD Owner appears to be an unrelated third party")
        .when((kind == GRANTEE) & ~known, "Review: HCAD Owner matches RP Grantee (who is not Probate Lead)")
        .when(kind == MISSING, "HCAD Owner Name Missing After Successful Scrape")
    )
    return typed.withColumn("review_reason", reason).withColumn("needs_review_flag", F.when(F.col("review_reason").isNotNull(), 1).otherwise(0))


def contact(rows: DataFrame) -> DataFrame:
    """owner_contact_name, owner_contact_rationale, contact_target_tier."""
    c = F.col
    person, signer = names.is_person(c("hcad_owner_full_name")), names.is_person(c("rp_party_full_name"))
    kind, grantor = blank(c("hcad_owner_match_type")), F.coalesce(c("rp_party_type") == "Grantor", F.lit(False))
    out = lambda name, why, tier: F.struct(name.alias("name"), F.lit(why).alias("why"), F.lit(tier).alias("tier"))
    owner, party = c("hcad_owner_full_name"), c("rp_party_full_name")
    pick = (
        F.when(person & kind.isin(SAME, DIFFERED), out(owner, "MATCHED_HCAD_DECEDENT", "A"))
        .when(person & kind.isin(DEVIATED, GRANTEE) & grantor & signer, out(party, "FALLBACK_RP_GRANTOR", "B"))
        .when(~person & grantor & signer, out(party, "FALLBACK_RP_GRANTOR_VS_ENTITY", "B"))
        .when(person, out(owner, "MANUAL_REVIEW_UNMATCHED_HUMAN", "C"))
        .otherwise(out(F.lit(None).cast("string"), "ENTITY_SUPPRESS", "DROP"))
    )
    return rows.withColumn("p", pick).select("*", c("p.name").alias("owner_contact_name"), c("p.why").alias("owner_contact_rationale"), c("p.tier").alias("contact_target_tier")).drop("p")


def reach(contacts: DataFrame, known: DataFrame | None) -> DataFrame:
    """contact_phone and contact_email of tiers A and B, from a table (name, contact_phone, contact_email); null without one."""
    if known is None:
        return contacts.withColumns({k: F.lit(None).cast("string") for k in ("contact_phone", "contact_email")})
    wanted = F.when(F.col("contact_target_tier").isin("A", "B"), F.col("owner_contact_name"))
    return contacts.withColumn("name", wanted).join(known, "name", "left").drop("name")
