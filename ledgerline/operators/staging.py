"""Records as JSON: packing them, and flattening them into the staging contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import numbers, similarity


def pack(rows: DataFrame, case: str, account: str, source: str, lot: str, loaded_at: str) -> DataFrame:
    """Rows for the load table: four scalars, the time of loading, and the whole row as JSON, nulls left out."""
    return rows.select(
        F.col(case).cast("string").alias("PROBATE_CASE_NUMBER"),
        F.col(account).cast("string").alias("HCAD_ACCOUNT_ID"),
        F.to_timestamp(F.lit(loaded_at)).alias("SCRAPE_TIMESTAMP"),
        F.lit(source).alias("SOURCE_FILENAME"),
        F.col(lot).try_cast("double").alias("HCAD_LOT_SQFT_TOTAL"),
        F.to_json(F.struct(*rows.columns)).alias("RAW_RECORD"),
    )


#: A number written with nothing but zeros after its point; inside a text too, where it does no harm.
_ZEROS = r"[:,\[]\s*-?\d+\.0+\s*[,}\]]"


def flatten(records: DataFrame, raw: str = "RAW_RECORD") -> DataFrame:
    """The staging contract from JSON records with a case number; what cannot be read as its type is null.

    A record is read once, as a struct of texts, written text as it stands and documents written out. Where a whole number
    may be written as 5.0, its text is 5, which a variant gives; such records alone are read column by column.
    """
    value = F.try_parse_json(F.col(raw))
    one_by_one = F.struct(*[F.try_variant_get(value, f"$.{c}", "string").alias(c) for c in schemas.STAGED])
    at_once = F.from_json(F.col(raw), ", ".join(f"{c} string" for c in schemas.STAGED), {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})
    # What a variant does not take, such as a name that comes twice, is no record. inline() has the struct made once.
    texts = records.filter(value.isNotNull()).select(F.inline(F.array(F.when(F.col(raw).rlike(_ZEROS), one_by_one).otherwise(at_once))))
    found = texts.filter(F.coalesce(F.col(schemas.KEY), F.lit("")) != "")
    read = _read({c: F.col(c) for c in schemas.STAGED})
    return found.select(*[read.get(c, F.col(c)).alias(c) for c in schemas.STAGED])


def _read(text: dict[str, Column]) -> dict[str, Column]:
    """What is no text, from text, by column."""
    out = {c: F.try_to_timestamp(text[c], F.lit("yyyy-MM-dd")).cast("date") for c in schemas.DATES}
    out |= {c: numbers.flag(text[c]) for c in schemas.FLAGS}
    return out | {c: numbers.whole(text[c]) for c in schemas.NUMBERS}


def failures(records: DataFrame, raw: str = "RAW_RECORD") -> DataFrame:
    """Records with parsing_error: what of each cannot be read, null if all can. Nothing stops at a record that fails.

    'not JSON'; 'no case number'; else the columns, in order, whose text is there and cannot be read as its type.
    """
    kinds = [*schemas.DATES, *schemas.FLAGS, *schemas.NUMBERS]

    def reason(v: Column, text: Column) -> Column:
        read = _read({c: text[c] for c in kinds})
        bad = F.array_join(F.array_compact(F.array(*[F.when(text[c].isNotNull() & read[c].isNull(), F.lit(c)) for c in sorted(kinds)])), ",")
        return F.when(v.isNull(), "not JSON").when(F.coalesce(text[schemas.KEY], F.lit("")) == "", "no case number").otherwise(F.nullif(bad, F.lit("")))

    texts = lambda v: F.struct(*[F.try_variant_get(v, f"$.{c}", "string").alias(c) for c in (schemas.KEY, *kinds)])
    return records.withColumn("parsing_error", similarity.let(F.try_parse_json(F.col(raw)), lambda v: similarity.let(texts(v), lambda text: reason(v, text))))
