"""Recipes over frames: defaults, column order, first rows, groups of followers, lists, tiers of names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import dates, names, numbers
from ledgerline.functions.similarity import let
from ledgerline.sources import files

from . import beginnings
from .running import Before, Sum, running

#: Leads that a deed meets at once, at most.
CELL = 4096


def ensure_columns(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """Adds columns that are missing: name -> (type, default)."""
    return df.withColumns({k: F.lit(v).cast(t) for k, (t, v) in defaults.items() if k not in df.columns})


def zeroed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns as numbers, 0 for what is none."""
    return df.withColumns({k: numbers.or_zero(F.col(k)) for k in columns})


def ordered(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """Columns in an order as far as they are there, the rest after them."""
    first = [c for c in order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the least in an ascending order: an aggregate that is combined before the shuffle, not a window."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(rank).alias("r")).select(*keys, "r.row.*").select(*df.columns)


def groups_of_followers(rows: DataFrame, page: str, place: str, is_main: Column) -> DataFrame:
    """A number for each main row and the rows after it on its page; 0 before the first. A page may have any number of rows."""
    return running(rows, [page], [place], {"group_no": Sum(F.when(is_main, 1).otherwise(0))})


def new_pages(pages: DataFrame, scan: str, page: str, first_key: str) -> DataFrame:
    """Pages of a scan that do not begin like the page before. A scan may have any number of pages."""
    own = running(pages, [scan], [page], {"__before": Before(F.col(first_key))})
    return own.filter(~F.col("__before").eqNullSafe(F.col(first_key)) | F.col(first_key).isNull()).drop("__before")


def pages_read(pages: DataFrame, scan: str, page: str, first_key: str, rows: str, empty: int, most: int) -> DataFrame:
    """The pages that a scan reads before it stops: at one that begins like the page before, at so many empty ones in a row, or after the most that it may.

    A page that ends the scan is not read, but for empty ones, which are read and give nothing. Pages are numbered in two
    passes; no later one than the most that a scan may read gets into a window.
    """
    pages = running(pages, [scan], [page], {"__nth": Sum(F.lit(1))}).filter(F.col("__nth") <= most)
    order = Window.partitionBy(scan).orderBy(page)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none = F.coalesce(F.col(rows), F.lit(0)) == 0
    again = F.coalesce(F.lag(first_key).over(order) == F.col(first_key), F.lit(False)) & ~none
    numbered = pages.withColumns({"__again": again, "__full": F.sum(F.when(none, 0).otherwise(1)).over(upto)})
    run = F.sum(F.when(none, 1).otherwise(0)).over(Window.partitionBy(scan, "__full").orderBy(page).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stops = numbered.withColumn("__run", run)
    stopped = F.max(F.when(F.col("__again") | (F.lag("__run").over(order) >= empty), 1).otherwise(0)).over(upto)
    return stops.withColumn("__stopped", stopped).filter(F.col("__stopped") == 0).drop("__nth", "__again", "__full", "__run", "__stopped")


def listed(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Values of a key in order, as often as they come, blanks left out."""
    there = df.filter(F.trim(F.coalesce(F.col(value), F.lit(""))) != "")
    own = F.array_sort(F.collect_list(F.struct(order, value)))
    return there.groupBy(key).agg(own.alias("l")).select(key, F.transform("l", lambda x: x[value]).alias(name))


def with_lists(primary: DataFrame, lists: DataFrame, key: str, name: str) -> DataFrame:
    return primary.join(lists, key, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def right_wins(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which a column that both have is the right one's where the right side has the key."""
    both = [c for c in right.columns if c in left.columns and c != key]
    marked = right.select(key, F.lit(True).alias("__there"), *[F.col(c).alias(f"__{c}" if c in both else c) for c in right.columns if c != key])
    out = left.join(marked, key, "left")
    return out.withColumns({c: F.when(F.col("__there"), F.col(f"__{c}")).otherwise(F.col(c)) for c in both}).drop("__there", *[f"__{c}" for c in both])


def beginning_with(terms: DataFrame, rows: DataFrame, term: str, name: str) -> DataFrame:
    """terms and rows of which the name begins with the term; empty and null terms find nothing.

    Each different term is met once, as beginnings.matches; then the terms' own columns come by equality.
    """
    found = beginnings.matches(terms, rows, term, name).withColumnRenamed(term, "__term")
    return terms.join(found, F.col(term) == F.col("__term")).drop("__term")


def near_dates(leads: DataFrame, deeds: DataFrame, term: str, name: str, filed: str, recorded: str, days: int = 365) -> DataFrame:
    """Leads and deeds whose name begins with a lead's search term, recorded within so many days of the filing.

    Different names, had once, are searched for terms, not deeds: a deed moves with what it is asked for, not with its name.
    Besides the term, the sides meet on a stretch of a quarter of the days, so that a term with very many leads and deeds is
    dealt by time as well. The leads that a stretch may meet are rows of up to CELL, by day of filing: a deed meets a row of
    leads at once, and results come deed by deed, in order of their days, so that what is written of them repeats itself. Which
    leads a row holds, in which order, changes no result.
    """
    c = F.col
    number = lambda d: F.floor(F.unix_date(d) / max(1, days // 4))
    own = files.kept(deeds.select(name).distinct(), "names")
    begun = files.kept(beginnings.matches(leads, own, term, name).select(name, c(term).alias("__term")), "begun")
    reach = F.sequence(number(F.date_sub(filed, days)), number(F.date_add(filed, days)))
    asks = leads.filter(c(filed).isNotNull() & c(term).isNotNull()).withColumn("__stretch", F.explode(reach))
    nth = F.row_number().over(Window.partitionBy(term, "__stretch").orderBy(filed))
    asks = asks.withColumn("__part", F.floor((nth - 1) / CELL)).groupBy(c(term).alias("__asked"), c("__stretch"), "__part").agg(F.collect_list(F.struct(*leads.columns)).alias("__asks"))
    right = deeds.join(begun, name).withColumn("__recorded", number(c(recorded)))
    # What a join does not need of an order it drops, unless rows are numbered in it.
    right = right.repartition("__term", "__recorded").sortWithinPartitions("__term", "__recorded", recorded).withColumn("__nth", F.monotonically_increasing_id())
    met = right.hint("merge").join(files.kept(asks, "asks"), (c("__term") == c("__asked")) & (c("__recorded") == c("__stretch"))).filter("__nth >= 0")
    met = met.select(*deeds.columns, F.explode("__asks").alias("__a")).select("__a.*", *deeds.columns)
    return met.filter(dates.within(c(recorded), c(filed), days))


def tiered_names(leads: DataFrame, parties: DataFrame, variants: int = 3, last_names: bool = False) -> DataFrame:
    """Parties by name, tier by tier: the name itself; up to so many other forms of the first name; then, where nothing was found and the
    surname is rare, the surname alone (off by default). A name that has been searched for is not searched for again.

    leads: lead_id, last, first, as written; terms are standardized. parties: party_last, party_first and more; a party is
    found whose name begins with the term. Returns both with the term and the tier.
    """
    c = F.col
    base = leads.withColumn("term1", names.searched(c("last"), c("first")))
    one = base.select("*", c("term1").alias("search_term"), F.lit("TIER_1_EXACT_STD").alias("tier"))
    other = F.transform(names.nickname_variants(c("first")), lambda v: F.struct(v.alias("nick"), names.searched(c("last"), v).alias("term")))
    fresh = F.filter(other, lambda o: o["term"] != c("term1"))
    two = base.withColumn("o", F.explode(F.slice(fresh, 1, variants))).select(*base.columns, c("o.term").alias("search_term"), F.concat(F.lit("TIER_2_NICK_"), "o.nick").alias("tier"))
    named = parties.withColumn("party_name", F.upper(F.trim(F.concat("party_last", F.lit(" "), F.coalesce("party_first", F.lit(""))))))
    found = beginning_with(one.unionByName(two), named, "search_term", "party_name")
    if last_names:
        none = base.join(found.select("lead_id").distinct(), "lead_id", "left_anti").filter(~F.upper(F.trim("last")).isin(names.COMMON_DEED_SURNAMES))
        three = none.select("*", names.searched(c("last"), F.lit("")).alias("search_term"), F.lit("TIER_3_RARE_LN_ONLY").alias("tier")).filter("search_term <> term1")
        found = found.unionByName(beginning_with(three, named, "search_term", "party_name"))
    return found.drop("term1", "party_name")


def by_initial(leads: DataFrame, parties: DataFrame) -> DataFrame:
    """The earlier way: the full name, then the first initial, then a rare surname alone, stopping at the first tier with a hit.

    Each tier is an equi-join of the leads that none before has found anything for.
    """
    c = F.col
    left = leads.withColumn("initial", F.substring("first", 1, 1))
    named = parties.withColumn("party_initial", F.substring("party_first", 1, 1))
    tests = [(c("last") == c("party_last")) & (c("first") == c("party_first")), (c("last") == c("party_last")) & (c("initial") == c("party_initial")), c("last") == c("party_last")]
    found = None
    for k, test in enumerate(tests, 1):
        some = left if k < 3 else left.filter(~c("last").isin(names.COMMON_DEED_SURNAMES))
        hits = some.join(named, test).drop("initial", "party_initial").withColumn("tier_no", F.lit(k))
        found = hits if found is None else found.unionByName(hits)
        left = left.join(hits.select("lead_id").distinct(), "lead_id", "left_anti")
    return found


def exploded(record: DataFrame, lots: Column, parties: Column) -> DataFrame:
    """A row a lot and party; without parties one row a lot, its role N/A."""
    none = F.array(F.struct(F.lit("N/A").alias("role"), F.lit("").alias("last"), F.lit("").alias("first")))
    out = record.withColumn("lot_no", F.explode(lots)).withColumn("p", F.explode(let(parties, lambda v: F.when(F.size(v) > 0, v).otherwise(none))))
    return out.select("*", F.col("p.role").alias("party_role"), F.col("p.last").alias("party_last"), F.col("p.first").alias("party_first")).drop("p")


def land_totals(rows: Column) -> Column:
    """Of an array (land_use, unit_type, units, market_value): square feet where the unit is SF, value, number of lines."""
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + F.coalesce(x[f], F.lit(0.0)))
    return F.struct(total(F.filter(rows, lambda r: r["unit_type"] == "SF"), "units").alias("lot_sqft"), total(rows, "market_value").alias("land_value"), F.size(rows).alias("lines"))


def area_totals(rows: Column) -> Column:
    """Of an array (type, area): base, structure (all) and garage areas, number of lines."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x["area"], F.lit(0)).cast("bigint"))
    of = lambda word: total(F.filter(rows, lambda r: F.upper(r["type"]).contains(word)))
    return F.struct(of("BASE").alias("base"), total(rows).alias("structure"), of("GARAGE").alias("garage"), F.size(rows).alias("lines"))


def split_known(pairs: Column, known: list[str]) -> Column:
    """A map's known keys, and the others as JSON text, null if there are none."""
    other = F.map_filter(pairs, lambda k, v: ~k.isin(known))
    return F.struct(F.map_filter(pairs, lambda k, v: k.isin(known)).alias("known"), F.when(F.size(other) > 0, F.to_json(other)).alias("other"))


def json_or_null(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.to_json(items))


def zones(columns: list[str], named: dict[str, list[str]]) -> list[tuple[str, int, str]]:
    """(zone, place, column) of a frame's columns in the order of zones; those of no zone last."""
    out = [(z, k, c) for z, cs in named.items() for k, c in enumerate(cs) if c in columns]
    seen = {c for _, _, c in out}
    return out + [("7 Other", k, c) for k, c in enumerate(c for c in columns if c not in seen)]
