"""Lead scoring by a catalogue of rules, each with its reason and its confidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text

OUTPUT = "struct<score:int,tag:string,reasoning:string,confidence:double,confidence_reason:string>"
COURT = "Court records are reliable and updated regularly."
NAME = "Name data is useful but can have variations or common matches."
MAIL = "Mailing addresses are generally accurate but don't always indicate true residence."


@dataclass(frozen=True)
class Branch:
    """when: SQL over a lead, {as_of} the day it is scored for."""

    when: str
    score: int
    reasoning: str
    confidence: float
    confidence_reason: str
    tag: str = ""

    def output(self) -> Column:
        tag = self.tag or self.reasoning.split(":")[0]
        return F.struct(F.lit(self.score).alias("score"), F.lit(tag).alias("tag"), F.lit(self.reasoning).alias("reasoning"), F.lit(self.confidence).alias("confidence"), F.lit(self.confidence_reason).alias("confidence_reason"))


# The catalogue. The first branch that holds is the rule's output; a rule without one scores 0.
RULES: dict[str, list[Branch]] = {
    "1": [Branch("probate_lead_filing_date is not null and datediff({as_of}, probate_lead_filing_date) >= 90", 15, "PROBATE_TIMING: Probate case filed ≥90 days ago; time window suggests administrative delays or lack of heirs.", 0.85, COURT)],
    "2": [Branch("lower(probate_lead_status) = 'open'", 25, "PROBATE_STATUS: Probate case is still open, suggesting the estate is unresolved.", 0.85, COURT)],
    "3": [Branch("lower(probate_lead_subtype) like any ('%affidavit%', '%administration%')", 15, "PROBATE_TYPE: Probate subtype suggests informal or non-standard process (Affidavit or Administration).", 0.85, COURT)],
    "4": [Branch("probate_lead_decedent_last is not null", 10, "NAME_SIGNAL: Decedent's last name is present, aiding name match inference.", 0.75, NAME)],
    "5": [Branch("length(trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last)) - length(replace(trim(probate_lead_decedent_first || ' ' || probate_lead_decedent_last), ' ', '')) >= 1", 10, "NAME_COMPLEXITY: Decedent's full name has 2+ tokens, improving match confidence.", 0.75, NAME)],
    "10": [Branch("try_cast(prior_years_taxes_due as decimal(38,0)) > 0", 25, "TAX_DISTRESS: Delinquent on prior years taxes.", 0.9, "Tax records are official government data with high accuracy.")],
    "11": [Branch("lower(exemption_code) like '%hs%'", -10, "OWNER_OCCUPIED: Homestead exemption present; likely owner-occupied and less motivated.", 0.8, "Homestead data is accurate but may lag changes in residency.")],
    "12_5": [
        Branch("mailing_location_type = 'NEARBY_STATE'", 10, "OWNER_LOCATION: Owner's mailing address is in a nearby state (moderate distance from property).", 0.78, MAIL),
        Branch("mailing_location_type = 'US_OTHER'", 15, "OWNER_LOCATION: Owner's mailing address is in a distant U.S. state (higher detachment).", 0.78, MAIL),
        Branch("mailing_location_type = 'FOREIGN'", 30, "OWNER_LOCATION: Owner's mailing address is international (highest detachment).", 0.78, MAIL),
    ],
    "13": [Branch("split_part(lower(hcad_owner_full_name), ' ', -1) = lower(probate_lead_decedent_last)", 20, "NAME_MATCH: Owner's last name matches decedent's last name.", 0.75, "Name matching is helpful but can have false positives with common surnames.")],
    "14": [Branch("try_cast(try_variant_get(try_parse_json(hcad_building_data_json), '$.year_built', 'string') as decimal(38,0)) < 1960", 10, "AGE_SIGNAL: Built before 1960; older properties may have deferred maintenance.", 0.65, "Property age data is reliable, but actual condition varies widely.")],
    "15": [Branch("upper(hcad_physical_condition) in ('POOR', 'VERY POOR', 'UNSOUND') or upper(hcad_grade_adjustment) in ('C', 'C-', 'D', 'D-', 'E', 'F')", 15, "CONDITION: Assessor grade is C or lower, suggesting physical or cosmetic issues.", 0.65, "Condition assessments are based on external observation and may miss recent updates.")],
    "16": [Branch("hcad_land_market_value > 0 and try_cast(hcad_market_value_detail as decimal(38,0)) > 0 and try_divide(cast(hcad_land_market_value as double), cast(try_cast(hcad_market_value_detail as decimal(38,0)) as double)) >= 0.40", 10, "LAND_RATIO: Land value is ≥ 40% of total, indicating potential redevelopment value.", 0.7, "Land valuations are stable but can be outdated in rapidly changing markets.")],
    "16_5": [Branch("hcad_garage_sqft > 0", 2, "GARAGE: Garage present — minor marketability upgrade.", 0.6, "Garage data is sometimes inaccurate, especially for converted or detached structures.")],
    "17": [Branch("hcad_lot_sqft_total > 7500", 5, "LOT_SIZE: Lot size is over 7500 sqft, offering potential for expansion or appeal.", 0.7, "Lot size data is generally accurate but boundary disputes can occur.")],
    "17_5": [Branch("hcad_land_line_count > 1", 5, "LOT_SEGMENTS: Multiple land segments suggest non-standard parcel, possible value or complexity.", 0.7, "Lot segmentation data is stable but can reflect outdated subdivisions.")],
    "100": [
        Branch("upper(rp_instrument_type) in ('W/D', 'DEED', 'SPECIAL WARRANTY DEED')", -20, "DEED_SALE: A finalizing deed (Warranty/Special) was filed, indicating the property has likely been sold.", 0.92, "High confidence; these are clear indicators of a finalized sale."),
        Branch("upper(rp_instrument_type) = 'EXECUTOR\\'S DEED'", 15, "DEED_HEIR_XFER: An Executor's Deed was filed, indicating an heir has formally taken title.", 0.80, "Strong confidence, but a small percentage can be for other legal reasons."),
        Branch("upper(rp_instrument_type) in ('AFFT', 'QUITCLAIM DEED', 'GIFT DEED')", 20, "DEED_INFORMAL_XFER: An informal or intra-family transfer (Affidavit/Quitclaim) was filed.", 0.72, 'Moderate confidence; high variability in motivation for these "soft transfers".'),
        Branch("upper(rp_instrument_type) = 'TRUSTEE\\'S DEED'", 0, "DEED_NON_PROBATE: A foreclosure or trustee-related deed was found.", 0.85, "High confidence this is a non-probate event."),
        Branch("true", 30, "DEED_NONE_FOUND: No finalizing transfer deed was found, suggesting title is still with the estate.", 0.65, "Moderate confidence; absence of a record is a strong signal, but could also be a data lag."),
    ],
}
# What cannot all be true of one property.
CONTRADICTIONS = [
    "rule_11_output.score < 0 and mailing_location_type <> 'SAME_STATE'",
    "rule_15_output.score > 0 and upper(hcad_grade_adjustment) in ('A', 'B', 'A+', 'B+')",
    "hcad_total_base_sqft = 0 and hcad_bedrooms > 0",
    "hcad_lot_sqft_total > 7500 and hcad_land_market_value = 0",
    "hcad_garage_sqft = 0 and (lower(hcad_exterior_wall) like '%garage%' or lower(hcad_foundation_type) like '%garage%')",
]


def locate(leads: DataFrame) -> DataFrame:
    """States of the property and of its owner's mail, raw and checked, and where the mail goes."""
    raw = leads.withColumns({"property_state_raw": text.state_of(F.col("hcad_site_address")), "mailing_state_raw": text.state_of(F.col("hctax_owner_mailing_address"))})
    return raw.withColumns({"property_state": text.valid_state(F.col("property_state_raw")), "mailing_state": text.valid_state(F.col("mailing_state_raw")), "mailing_location_type": text.location_type(F.col("mailing_state_raw"))})


def apply(leads: DataFrame, as_of: str) -> DataFrame:
    """One output struct a rule, of a rule that does not fire score 0 and nulls."""
    silent = F.struct(F.lit(0).alias("score"), *[F.lit(None).cast(t).alias(n) for n, t in (("tag", "string"), ("reasoning", "string"), ("confidence", "double"), ("confidence_reason", "string"))])
    out = {}
    for rule, branches in RULES.items():
        c = None
        for b in branches:
            test = F.coalesce(F.expr(b.when.replace("{as_of}", f"date'{as_of}'")), F.lit(False))
            c = F.when(test, b.output()) if c is None else c.when(test, b.output())
        out[f"rule_{rule}_output"] = c.otherwise(silent).cast(OUTPUT)
    return leads.withColumns(out)


def total(ruled: DataFrame) -> DataFrame:
    """The sum of scores, the reasons in rule order, the confidence of each rule that counts, and contradictions."""
    outputs = [F.col(f"rule_{r}_output") for r in RULES]
    score = outputs[0]["score"]
    for o in outputs[1:]:
        score = score + o["score"]
    confident = [F.when(o["score"] != 0, F.struct(o["tag"].alias("tag"), o["confidence"].alias("confidence"), o["confidence_reason"].alias("reason"))) for o in outputs]
    wrong = F.lit(False)
    for c in CONTRADICTIONS:
        wrong = wrong | F.coalesce(F.expr(c), F.lit(False))
    return ruled.withColumns(
        {
            "r_score_acquisition": score,
            "reasoning_array": F.array_compact(F.array(*[o["reasoning"] for o in outputs])),
            "confidence_summary_array": F.array_compact(F.array(*confident)),
            "has_data_contradiction": wrong,
        }
    )


def score(leads: DataFrame, as_of: str) -> DataFrame:
    return total(apply(locate(leads), as_of))


def flat(scored: DataFrame) -> DataFrame:
    """Adds rN_score of each rule."""
    return scored.withColumns({f"r{r}_score": F.col(f"rule_{r}_output.score") for r in RULES})
