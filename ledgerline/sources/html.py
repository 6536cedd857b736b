"""Rows from saved pages. Pages need not be well formed, so patterns find the parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import account_in, label_key, squeeze


def text_of(html: Column) -> Column:
    """Text without tags, comments and scripts; the five named characters restored."""
    x = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    for name, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(c))
    return squeeze(x)


def pieces(html: Column, tag: str) -> Column:
    """Contents of all elements of a name; an element that is not closed ends at the next one."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?=</{tag}>|<{tag}[\s>]|$)"), F.lit(1))


def cells(row: Column) -> Column:
    return F.transform(pieces(row, "td"), text_of)


def rows_by_header(pages: DataFrame, html: str, wanted: list[str]) -> DataFrame:
    """A row a table row: the cells that stand under the wanted headers, empty where a row is short."""
    trs = pages.withColumn("__tr", pieces(F.col(html), "tr"))
    heads = F.transform(F.flatten(F.transform("__tr", lambda r: pieces(r, "th"))), lambda h: F.lower(text_of(h)))
    out = trs.withColumn("__heads", heads).select("*", F.posexplode("__tr").alias("row_no", "__row")).withColumn("__cells", cells(F.col("__row"))).filter(F.size("__cells") > 0)
    at = lambda h: F.array_position("__heads", h.lower()).cast("int")
    named = {h: F.when(at(h) > 0, F.coalesce(F.get("__cells", at(h) - 1), F.lit(""))).otherwise("") for h in wanted}
    return out.withColumns(named).drop("__tr", "__heads", "__row", "__cells", html)


def links(html: Column) -> Column:
    """(href, text) of all links."""
    one = r"(?is)<a\s[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>"
    return F.zip_with(F.regexp_extract_all(html, F.lit(one), F.lit(1)), F.regexp_extract_all(html, F.lit(one), F.lit(2)), lambda h, t: F.struct(h.alias("href"), text_of(t).alias("text")))


def grid_rows(pages: DataFrame, html: str) -> DataFrame:
    """(row_no, cells, is_main) of a grid: main rows have five cells or more, one of the first three a file number."""
    out = pages.select("*", F.posexplode(pieces(F.col(html), "tr")).alias("row_no", "__row")).withColumn("cells", cells(F.col("__row")))
    number = F.exists(F.slice("cells", 1, 3), lambda c: c.rlike(r"^(RP-|RM-|RT-)"))
    return out.withColumn("is_main", (F.size("cells") >= 5) & number).drop("__row", html)


def candidates(pages: DataFrame, html: str) -> DataFrame:
    """Rows of a result list of seven columns: account, owner, address, ZIP code, area, two values, and the link with its account."""
    from ledgerline.functions import numbers

    rows = pages.select("*", F.posexplode(pieces(F.col(html), "tr")).alias("ord", "__row")).withColumn("c", cells(F.col("__row"))).filter(F.size("c") >= 7)
    url = F.get(links(F.col("__row")), 0)["href"]
    text = {k: F.get("c", i) for i, k in enumerate(("hcad_account_summary", "hcad_owner_summary", "hcad_address_summary", "hcad_zip_summary"))}
    value = {k: numbers.currency(F.get("c", i)) for i, k in enumerate(("hcad_sqft_summary", "hcad_market_value_summary", "hcad_appraised_value_summary"), 4)}
    return rows.withColumns(text | value | {"hcad_detail_url": url, "hcad_account_url": account_in(url)}).drop("__row", "c", html)


def labelled(html: Column) -> Column:
    """(label, value) of table rows of two cells."""
    two = F.filter(F.transform(pieces(html, "tr"), cells), lambda c: F.size(c) == 2)
    return F.transform(two, lambda c: F.struct(c[0].alias("label"), c[1].alias("value")))


def characteristics(html: Column) -> Column:
    """Labels and values as a map, labels as field names; of equal ones the last."""
    pairs = F.filter(F.transform(labelled(html), lambda r: F.struct(label_key(r["label"]).alias("key"), r["value"].alias("value"))), lambda r: r["key"] != "")
    keys = F.array_distinct(F.transform(pairs, lambda r: r["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.try_element_at(F.transform(F.filter(pairs, lambda r: r["key"] == k), lambda r: r["value"]), F.lit(-1))))


def detail(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Adds record, a struct of schemas.DETAIL as text: what a page's labelled rows give by field name, the rest null.

    A page without any labelled row has parsing_error; a page that fails stops no other.
    """
    from ledgerline import schemas

    found = F.transform_keys(characteristics(F.col(html)), lambda k, v: F.when(k.startswith("hcad_"), k).otherwise(F.concat(F.lit("hcad_"), k)))
    value = {c: F.nullif(F.try_element_at("__found", F.lit(c)), F.lit("")) for c in schemas.DETAIL}
    value["hcad_detail_url_visited"] = F.col(url)
    value["parsing_error"] = F.when(F.coalesce(F.size("__found"), F.lit(0)) == 0, "no labelled rows")
    return pages.withColumn("__found", found).withColumn("record", F.struct(*[v.cast("string").alias(c) for c, v in value.items()])).drop("__found")


def column_under(html: Column, header: str) -> Column:
    """Values of the column whose header is the one asked for."""
    rows = pieces(html, "tr")
    heads = F.transform(F.flatten(F.transform(rows, lambda r: pieces(r, "th"))), lambda h: F.lower(text_of(h)))
    at = F.array_position(heads, header.lower()).cast("int")
    return F.when(at > 0, F.transform(F.filter(F.transform(rows, cells), lambda c: F.size(c) > 0), lambda c: F.get(c, at - 1))).otherwise(F.array().cast("array<string>"))
