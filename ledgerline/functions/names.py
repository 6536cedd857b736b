"""Names of people and firms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, empty_as_null, squeeze

# Words that end the name of a firm or an estate; those of them that mark a firm; words that mark an entity.
NOT_SURNAMES = ["JR", "SR", "II", "III", "IV", "V", "TRUST", "ESTATE", "EST", "LLC", "INC", "LP", "LTD", "CO", "BANK"]
FIRM_WORDS = ["LLC", "INC", "LP", "LTD", "CO", "BANK", "TRUST", "ESTATE", "EST"]
ENTITY_WORDS = ["LLC", "INC", "LP", "LTD", "CORP", "CO ", "TRUST", "BANK", "ESTATE", "EST ", "PROPERTIES", "INVESTMENTS", "FUND", "GROUP", "REALTY", "HOLDINGS", "ASSOCIATION", "ASSN", "VENTURES", "LLP"]
# Surnames too common to search for by themselves, in a property search and in a deed search.
COMMON_SURNAMES = [
    "SMITH", "JOHNSON", "WILLIAMS", "BROWN", "JONES", "GARCIA", "MILLER", "DAVIS", "RODRIGUEZ", "MARTINEZ", "HERNANDEZ", "LOPEZ", "GONZALEZ",
    "WILSON", "ANDERSON", "THOMAS", "TAYLOR", "MOORE", "JACKSON", "MARTIN", "LEE", "PEREZ", "THOMPSON", "WHITE", "HARRIS",
]
COMMON_DEED_SURNAMES = [
    "SMITH", "TAYLOR", "JOHNSON", "WILLIAMS", "JONES", "BROWN", "DAVIS", "MILLER", "WILSON", "MOORE", "ANDERSON", "THOMAS", "JACKSON", "WHITE",
    "HARRIS", "MARTIN", "THOMPSON", "GARCIA", "MARTINEZ", "ROBINSON",
]
# First names and what people with them are called.
NICKNAMES = {
    "JOHN": ["JOHNNY", "JOHNNIE", "JON"],
    "WILLIAM": ["BILL", "BILLY", "WILL", "WILLIE", "LIAM"],
    "ROBERT": ["BOB", "ROBBIE", "ROBBY", "BERT", "ROB"],
    "JAMES": ["JIM", "JIMMY"],
    "RICHARD": ["DICK", "RICH", "RICK", "RICKY"],
    "CHARLES": ["CHUCK", "CHARLIE", "CHAS"],
    "JOSEPH": ["JOE", "JOEY"],
    "THOMAS": ["TOM", "TOMMY"],
    "MICHAEL": ["MIKE", "MICKEY", "MICK"],
    "DAVID": ["DAVE", "DAVY"],
    "ELIZABETH": ["LIZ", "LIZZIE", "BETH", "BETTY", "LISA", "LIBBY", "ELLE"],
    "MARGARET": ["MAGGIE", "PEG", "PEGGY", "RITA", "DAISY"],
    "CATHERINE": ["KATE", "KATHY", "CATHY", "KITTY", "KATIE"],
    "KATHERINE": ["KATE", "KATHY", "CATHY", "KITTY", "KATIE"],
    "SUSAN": ["SUE", "SUZIE", "SUZY"],
    "PATRICIA": ["PAT", "PATTY", "TRISH", "TRICIA"],
}
# Phrases before a name in a caption, the longest that fits first; words that are no part of a name.
CAPTION_PHRASES = ["IN THE CONSERVATORSHIP OF", "IN THE GUARDIANSHIP OF", "IN THE GUARDIANSHIP", "IN THE MATTER OF", "RE ESTATE OF"]
CAPTION_FILLERS = ["ESTATE", "IN", "THE", "OF", "DECEASED"]
# A suffix at the end of a caption, the name of an estate's person, and a run of names.
CAPTION_SUFFIX = r"(?i)\s+(?:Jr\.?|Sr\.?|I{2,3}|IV)$"
CAPTION_ESTATE = r"(?i)ESTATE OF[:\s]*(.+?)(?:,|\s+DECEASED)"
CAPTION_RUN = "(?U)\\b[A-Za-z][A-Za-z'’\\-]+\u0001[A-Za-z'’\\-\u0001]+\\b"
#: Space between two words of names, which is marked first: a pattern that repeats words would go as deep as there are words.
CAPTION_SPACE = r"(?<=[A-Za-z'’\-][A-Za-z'’\-])\s+(?=[A-Za-z][A-Za-z'’\-])"
# Fixed value: a run of capitalized words, as the first edition looked for it; the space within is marked first, as above.
CAPITALIZED = "(?U)\\b[A-Z][a-z]+(?:\u0001[A-Z][a-z]+)+\\b"
CAPITALIZED_SPACE = r"(?<=[a-z])\s+(?=[A-Z][a-z])"
# What a name to search for drops, and the suffixes that its last name loses.
SEARCH_DROPS, SEARCH_SUFFIX = r"(?U)[^\w\s'-]", r"(?U)\s+(JR|SR|I{1,3}|IV|V|VI{0,3}|IX|X)$"


def words(x: Column) -> Column:
    return F.filter(F.split(F.trim(blank(x)), r"\s+"), lambda w: w != "")


def cleaned(x: Column) -> Column:
    """For matching: upper case, one suffix off the end, nothing but letters, digits, spaces, hyphens."""
    t = F.regexp_replace(F.upper(blank(x)), r"\s*\b(JR|SR|II|III|IV)\.?$", "")
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.trim(t), r"(?U)[^\w\s-]", "")), r"\s+", " "))


def searched(last: Column, first: Column) -> Column:
    """For searching: LAST FIRST, the last name without a suffix, the first word of the first name only."""
    trimmed = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    plain = lambda x: trimmed(F.upper(F.regexp_replace(blank(x), SEARCH_DROPS, "")))
    family = trimmed(F.regexp_replace(plain(last), SEARCH_SUFFIX, ""))
    return F.trim(F.concat(family, F.lit(" "), F.coalesce(F.get(F.split(plain(first), r"(?U)\s+"), 0), F.lit(""))))


def party(x: Column) -> Column:
    """(last, first) of a name that begins with the last one."""
    w = words(x)
    return F.struct(F.coalesce(F.get(w, 0), F.lit("")).alias("last"), F.array_join(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), " ").alias("first"))


def surname(full: Column) -> Column:
    """The last word that can be a surname; else the last word; else empty."""
    w = words(F.upper(full))
    fit = F.filter(w, lambda x: ~x.isin(NOT_SURNAMES))
    return F.when(F.size(fit) > 0, F.try_element_at(fit, F.lit(-1))).otherwise(F.coalesce(F.try_element_at(w, F.lit(-1)), F.lit("")))


def owner_surname(owner: Column) -> Column:
    """Owners are written last name first, firms not."""
    w = words(F.upper(owner))
    firm = F.arrays_overlap(w, F.array(*[F.lit(x) for x in FIRM_WORDS]))
    return F.when(~firm & (F.size(w) > 0), F.get(w, 0)).otherwise(surname(owner))


def is_person(name: Column) -> Column:
    """Not blank, and without a word of an entity. Two of those words are listed with a space after them and count only before another word."""
    alternatives = "|".join(ENTITY_WORDS)
    return F.when(F.trim(blank(name)) == "", False).otherwise(~F.upper(name).rlike(rf"\b({alternatives})\b"))


def full(first: Column, last: Column) -> Column:
    """First and last name, null if both are empty."""
    return empty_as_null(F.trim(F.concat(blank(first), F.lit(" "), blank(last))))


def nickname_variants(first: Column) -> Column:
    """Other forms of a first name, sorted: its nicknames, or the names that it is short for with their other nicknames."""
    pairs: dict[str, set[str]] = {}
    for name, short in NICKNAMES.items():
        group = {name, *short}
        for x in group:
            pairs.setdefault(x, set()).update(group - {x})
    table = F.create_map(*[y for x, others in sorted(pairs.items()) for y in (F.lit(x), F.array(*[F.lit(o) for o in sorted(others)]))])
    return F.coalesce(F.try_element_at(table, F.upper(F.trim(first))), F.array().cast("array<string>"))


def titled(x: Column) -> Column:
    """A capital at the start of each run of letters, also after a hyphen or an apostrophe, the other letters small."""
    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1)), lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2))))), "")


def caption_text(caption: Column) -> Column:
    """What of a court caption may hold a name: a suffix goes, capitals are softened, one phrase before the name goes."""
    text = F.regexp_replace(F.trim(blank(caption)), CAPTION_SUFFIX, "")
    text = F.when(F.upper(caption) == caption, titled(text)).otherwise(text)
    strip = lambda t, p: F.when(F.upper(t).startswith(p), F.regexp_replace(F.substr(t, F.lit(len(p) + 1)), r"^[:, ]+|[:, ]+$", ""))
    return F.coalesce(*[strip(text, p) for p in CAPTION_PHRASES], text)


def decedent(caption: Column, person: Column | None = None, by_words: bool = False) -> Column:
    """(first, last) of the person that a court caption names.

    Of caption_text(): the person that a model has recognised, where one is given and not empty (operators.tagger; off by
    default); else what stands after ESTATE OF; else the longest run of words; else all words that are not fillers.
    by_words: runs are measured by their words, as an earlier edition did, not by their characters; of equal ones the first.
    """
    text = caption_text(caption)
    size = (lambda r: F.size(F.split(r, "\u0001"))) if by_words else F.length
    known = F.lit("") if person is None else F.coalesce(person, F.lit(""))
    estate = F.regexp_extract(text, CAPTION_ESTATE, 1)
    runs = F.regexp_extract_all(F.regexp_replace(text, CAPTION_SPACE, "\u0001"), F.lit(CAPTION_RUN), F.lit(0))
    longest = F.aggregate(runs, F.lit(""), lambda best, x: F.when((best == "") | (size(x) > size(best)), x).otherwise(best))
    rest = F.filter(words(F.regexp_replace(text, ",", " ")), lambda w: w.rlike(r"^\p{L}+$") & ~F.upper(w).isin(CAPTION_FILLERS))
    chosen = F.when(known != "", words(known)).when(estate != "", words(estate)).when(longest != "", F.split(longest, "\u0001")).when(F.size(rest) >= 2, rest).otherwise(F.array().cast("array<string>"))
    two = F.size(chosen) >= 2
    first = F.when(two, F.array_join(F.slice(chosen, 1, F.greatest(F.size(chosen) - 1, F.lit(0))), " ")).otherwise(F.coalesce(F.get(chosen, 0), F.lit("")))
    return F.struct(first.alias("first"), F.when(two, F.try_element_at(chosen, F.lit(-1))).otherwise("").alias("last"))


def decedent_by_ends(style: Column, parties: Column, person: Column | None = None) -> Column:
    """(first, last) as the first edition read them: the first and the last word alone, from a caption as it stands, else from the column of parties.

    Of a text: the person recognised in the caption, if given; else what stands after ESTATE OF; else the run of capitalized
    words with the most words, of equal ones the first.
    """
    known = F.lit("") if person is None else F.coalesce(person, F.lit(""))

    def found(text: Column, first: Column) -> Column:
        runs = F.transform(F.regexp_extract_all(F.regexp_replace(text, CAPITALIZED_SPACE, "\u0001"), F.lit(CAPITALIZED), F.lit(0)), lambda r: F.split(r, "\u0001"))
        run = F.aggregate(runs, F.array().cast("array<string>"), lambda best, r: F.when(F.size(r) > F.size(best), r).otherwise(best))
        estate = F.regexp_extract(text, CAPTION_ESTATE, 1)
        return F.when(first != "", words(first)).when(F.trim(estate) != "", words(estate)).otherwise(run)

    own, other = found(blank(style), known), found(blank(parties), F.lit(""))
    chosen = F.when(F.size(own) > 0, own).otherwise(other)
    return F.struct(F.coalesce(F.get(chosen, 0), F.lit("")).alias("first"), F.when(F.size(chosen) >= 2, F.try_element_at(chosen, F.lit(-1))).otherwise("").alias("last"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def tidy(x: Column) -> Column:
    return squeeze(x)
