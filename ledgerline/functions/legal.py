"""Legal descriptions of land: parsing them, and searching by their parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import names
from .similarity import let
from .text import blank, no_nan, squeeze

# How each part of a printed legal description begins and what ends it.
PATTERNS = {
    "description": r"(?i)(?:DESC|DESCRIPTION)[:\s#-]*\s*(.*?)(?=\s*(?:LOT:|BLOCK:|SEC:|SECTION:|SUBD:|SUBDIVISION:|ABSTRACT:|SURVEY:|TRACT:|$))",
    "subdivision": r"(?i)(?:SUBD|SUBDIVISION)[:\s#-]*\s*(.*?)(?=\s*(?:LOT:|BLOCK:|SEC:|SECTION:|ABSTRACT:|SURVEY:|TRACT:|$))",
    "lot": r"(?i)LOT[:\s#-]*\s*([\w\s.-]+?)(?=\s*(?:BLOCK:|SEC:|SECTION:|COMMENT:|$))",
    "block": r"(?i)BLOCK[:\s#-]*\s*([\w\s.-]+?)(?=\s*(?:LOT:|SEC:|SECTION:|COMMENT:|$))",
    "sec": r"(?i)(?:SEC|SECTION)[:\s#-]*\s*([\w\s.-]+?)(?=\s*(?:LOT:|BLOCK:|COMMENT:|$))",
    "abstract": r"(?i)ABSTRACT[:\s#-]*\s*([\w\s.-]+?)(?=\s*(?:SURVEY:|TRACT:|$))",
    "survey": r"(?i)SURVEY[:\s#-]*\s*([\w\s.-]+?)(?=\s*(?:ABSTRACT:|TRACT:|$))",
    "tract": r"(?i)TRACT[:\s#-]*\s*([\w\s.-]+?)(?=\s*(?:ABSTRACT:|SURVEY:|$))",
}
# Roles of parties and the name that follows each.
PARTY_PATTERN = r"(?i)(Grantor|Grantee|Trustee|GTR|GTE|TR)[:\s]+\s*(.*?)(?=\s*(?:Grantor|Grantee|Trustee|GTR|GTE|TR|$))"
# Property searches in their order.
TIERS = ["T0_ExactLotBlockSubdivision", "T1_GranteeLastName_Subdivision", "T1_GrantorLastName_Subdivision", "T2_ExactLegal", "T3_DropSec", "Fallback_Owner_SubdivisionContains", "T4_Subdivision_Block"]
TOO_BROAD = "COMMON_SURNAME_TOO_BROAD"


def parse(text: Column) -> Column:
    """A struct of the parts of a plain legal text; the whole text is the description where no part but a section is found."""
    cut = lambda x: F.trim(F.split_part(x, F.lit("Related Docs"), F.lit(1)))
    part = {k: squeeze(F.regexp_extract(blank(text), p, 1)) for k, p in PATTERNS.items()}
    none = F.concat(*[part[k] for k in PATTERNS if k not in ("description", "sec")]) == ""
    part["description"] = F.when(none & (part["description"] == ""), blank(text)).otherwise(part["description"])
    related = lambda x: F.when(x.contains("Related Docs"), cut(x)).otherwise(x)
    return F.struct(*[related(x).alias(k) for k, x in part.items()])


def parties(text: Column) -> Column:
    """Array of (role, last, first) from a column of labelled names: grantors, then grantees, then trustees."""
    roles = F.regexp_extract_all(blank(text), F.lit(PARTY_PATTERN), F.lit(1))
    values = F.regexp_extract_all(blank(text), F.lit(PARTY_PATTERN), F.lit(2))

    def one(role: Column, value: Column) -> Column:
        r, who = F.lower(role), names.party(value)
        kind = F.when(r.isin("grantor", "gtr"), "Grantor").when(r.isin("grantee", "gte"), "Grantee").otherwise("Trustee")
        return F.struct(kind.alias("role"), who["last"].alias("last"), who["first"].alias("first"))

    found = F.filter(F.zip_with(roles, values, one), lambda p: p["last"] != "")
    in_role = lambda v, k: F.filter(v, lambda p: p["role"] == k)
    return let(found, lambda v: F.concat(*[in_role(v, k) for k in ("Grantor", "Grantee", "Trustee")]))


def table_parts(rows: Column) -> Column:
    """Parts from an array of (label, value) rows of a printed table; later rows win, comments and other labels are appended."""
    label = lambda r: F.upper(squeeze(r["label"]))
    rows = F.filter(F.transform(rows, lambda r: F.struct(squeeze(r["label"]).alias("label"), squeeze(r["value"]).alias("value"))), lambda r: r["value"] != "")
    tests = {
        "description": lambda t: t.contains("DESC:"),
        "block": lambda t: t.contains("BLOCK:"),
        "lot": lambda t: t.contains("LOT:"),
        "subdivision": lambda t: t.contains("SUBDIV"),
        "abstract": lambda t: t.contains("ABSTRACT"),
        "survey": lambda t: t.contains("SURVEY"),
        "tract": lambda t: t.contains("TRACT"),
        "sec": lambda t: t.contains("SEC:") | t.contains("SECTION:"),
        "comment": lambda t: t.contains("COMMENT:"),
    }

    def kind(t: Column) -> Column:
        out = F.when(tests["description"](t), "description")
        for k, test in list(tests.items())[1:]:
            out = out.when(test(t), k)
        return out.when(t != "", "other")

    typed = F.transform(rows, lambda r: F.struct(kind(label(r)).alias("kind"), r["label"].alias("label"), r["value"].alias("value")))
    last = lambda k: F.coalesce(F.try_element_at(F.transform(F.filter(typed, lambda r: r["kind"] == k), lambda r: r["value"]), F.lit(-1)), F.lit(""))
    join = lambda a, name, b: F.when(b == "", a).when(a == "", F.concat(F.lit(f"{name}: "), b)).otherwise(F.concat(a, F.lit(f" | {name}: "), b))
    comments = F.transform(F.filter(typed, lambda r: r["kind"] == "comment"), lambda r: r["value"])
    described = F.aggregate(comments, last("description"), lambda a, c: join(a, "COMMENT", c))
    other = F.array_join(F.transform(F.filter(typed, lambda r: r["kind"] == "other"), lambda r: F.concat(r["label"], F.lit(": "), r["value"])), " | ")
    return F.struct(join(described, "OTHER_LEGAL", other).alias("description"), *[last(k).alias(k) for k in tests if k not in ("description", "comment")])


def lots(lot: Column) -> Column:
    """Lots that a lot text stands for: a range, a list by commas, a list by ampersands, or itself."""
    t = F.trim(blank(lot))
    a, b = (F.regexp_extract(t, r"^(\d+)-(\d+)$", k).try_cast("int") for k in (1, 2))
    items = lambda sep: F.filter(F.transform(F.split(t, sep), lambda x: F.trim(x)), lambda x: x != "")
    several = F.when(t.contains(","), items(",")).when(t.contains("&"), items("&")).otherwise(F.array(t))
    several = F.when(F.size(several) == 0, F.array(F.lit(""))).otherwise(several)
    return F.when(t.rlike(r"^\d+-\d+$"), F.when(a <= b, F.transform(F.sequence(a, F.greatest(a, b)), lambda x: x.cast("string"))).otherwise(F.array(t))).otherwise(several)


def plain_lot(lot: Column) -> Column:
    """5.0 as 5; what is no whole number in capitals, as it is."""
    number = lot.try_cast("double")
    return F.when(F.trim(blank(lot)) == "", "").when(number == F.floor(number), number.cast("bigint").cast("string")).otherwise(no_nan(lot))


def joined(*parts: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*parts)), " ")


def labelled(name: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(f"{name} "), value))


def full_text(tract: Column, block: Column, subdivision: Column, lot: Column, section: Column) -> Column:
    t, b, s, x, c = map(no_nan, (tract, block, subdivision, lot, section))
    return joined(labelled("TR", t), labelled("BLK", b), F.when(s != "", s), labelled("LOT", x), labelled("SEC", c))


def normalized(tract: Column, block: Column, subdivision: Column, section: Column, lot: Column, grantee_last: Column, decedent_last: Column) -> Column:
    """What queries are made of, as a struct: to be bound once for all tiers of a lead."""
    x = plain_lot(lot)
    none = F.lit("")
    parts = {"tract": no_nan(tract), "block": no_nan(block), "subdivision": no_nan(subdivision), "section": no_nan(section), "lot": F.when(x == "NAN", "").otherwise(x)}
    return F.struct(*[v.alias(k) for k, v in parts.items()], F.nullif(no_nan(grantee_last), none).alias("grantee"), F.nullif(no_nan(decedent_last), none).alias("decedent"))


def query(tier: str, v: Column) -> Column:
    """(legal, owner) that a tier searches by, from normalized(); both null where it cannot. A common surname without block and tract is too broad."""
    t, b, s, c, x = (v[k] for k in ("tract", "block", "subdivision", "section", "lot"))
    who = v["grantee" if "Grantee" in tier else "decedent"]
    tr, blk, sub = labelled("TR", t), labelled("BLK", b), F.when(s != "", s)
    none = F.lit(None).cast("string")
    owner = none
    if tier == TIERS[0]:
        legal = F.when((x != "") & (b != "") & (s != "") & ~x.contains("-") & ~x.contains("/"), joined(labelled("LT", x), blk, s))
    elif tier in (TIERS[3], TIERS[4]):
        legal = joined(tr, blk, sub, labelled("SEC", c) if tier == TIERS[3] else none)
    elif tier == TIERS[6]:
        legal = joined(blk, sub)
    else:
        able = who.isNotNull() & (s != "")
        broad = able & who.isin(names.COMMON_SURNAMES) & (b == "") & (t == "")
        text = joined(s, F.coalesce(blk, tr)) if tier == TIERS[5] else joined(blk, sub, tr)
        legal = F.when(broad, TOO_BROAD).when(able, text)
        owner = F.when(able & ~broad, F.substring(who, 1, 26))
    return F.struct(F.substring(F.nullif(legal, F.lit("")), 1, 100).alias("legal"), owner.alias("owner"))
