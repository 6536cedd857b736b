"""Property candidates of a lead: search by tiers, scores, the choice among several, and the fall-back from tier to tier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import legal, names, similarity
from ledgerline.functions.text import account_in, blank, no_nan
from ledgerline.sources import files

PAGE = 20
#: Properties of one search that meet some of its leads in one place, about.
CELL = 8192
#: Leads in such a place, about: few enough that what is written of a property with each of them repeats itself within a page's compression.
LIST = 2048
# Thresholds of the choice.
SUMMARY_LEAST, SUMMARY_GAP, DETAILS = 60, 20, 3
SURE_LEAST, SURE_GAP, LOOSE_LEAST, LOOSE_GAP, AT_ONCE = 70, 15, 50, 10, 90


def queries(leads: DataFrame) -> DataFrame:
    """A row a lead and tier: tier, ord, legal and owner query, and the query's state."""
    c = F.col
    args = (c("rp_legal_tract"), c("rp_legal_block"), c("rp_legal_description_text"), c("rp_legal_sec"), c("rp_legal_lot"), c("grantee_last"), c("probate_lead_decedent_last"))
    each = similarity.let(legal.normalized(*args), lambda v: F.array(*[F.struct(F.lit(k).alias("ord"), F.lit(t).alias("tier"), legal.query(t, v).alias("q")) for k, t in enumerate(legal.TIERS)]))
    rows = leads.withColumn("t", F.explode(each)).select("*", "t.ord", "t.tier", c("t.q.legal").alias("legal_query"), c("t.q.owner").alias("owner_query")).drop("t")
    state = F.when(c("legal_query") == legal.TOO_BROAD, legal.TOO_BROAD).when(c("legal_query").isNull() & c("owner_query").isNull(), "NO_QUERY_FORMED").otherwise("READY")
    return rows.withColumn("query_state", state)


def eligible(queried: DataFrame, key: str = "lead_id") -> DataFrame:
    """Per lead: whether any tier can be searched by."""
    return queried.groupBy(key).agg(F.coalesce(F.bool_or(F.col("query_state") == "READY"), F.lit(False)).alias("eligible"))


def grams(x: Column, n: int) -> Column:
    """Distinct stretches of n characters."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - (n - 1), F.lit(1))), lambda i: F.substring(x, i, n)))


def by_rarest(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """(legal_query, legal): different texts that contain different queries.

    A text that contains a query contains all its stretches of three characters. The two sides meet, by equality, on
    the stretch of the query that the fewest texts have; queries too short for that meet on their first character. The
    contains test decides, so nothing is lost.
    """
    c = F.col
    index = texts.select("legal", F.explode(grams(c("legal"), 3)).alias("gram"))
    wanted = asked.filter(F.length("legal_query") >= 3).select("legal_query", F.explode(grams(c("legal_query"), 3)).alias("gram")).hint("merge").join(index.groupBy("gram").count(), "gram", "left")
    rare = wanted.groupBy("legal_query").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "gram")).alias("r")).select("legal_query", c("r.gram").alias("gram"))
    short = asked.filter(F.length("legal_query") < 3).withColumn("gram", F.substring("legal_query", 1, 1))
    pairs = rare.hint("merge").join(index, "gram").unionByName(short.hint("merge").join(texts.select("legal", F.explode(grams(c("legal"), 1)).alias("gram")), "gram"))
    return pairs.filter(c("legal").contains(c("legal_query"))).select("legal_query", "legal")


def _same(a: DataFrame, b: DataFrame, by: list[str]):
    """Equality of columns of one name, nulls alike."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in by])


def meetings(queried: DataFrame, properties: DataFrame, meet=by_rarest) -> DataFrame:
    """(legal_query, owner_query, legal, owner_name, n): different searches with the different kinds of property that they find, and how many are of the kind.

    Leads ask alike and properties are described alike: what is alike is compared once, however many rows it stands for.
    meet(asked, texts) gives the legal texts that contain a query. Rows by kinds are had from hits(), no lead and no
    property is met one by one before. Written, as it is small and read more than once.
    """
    c = F.col
    asked = queried.filter("query_state = 'READY'").select("legal_query", "owner_query").distinct()
    kinds = files.kept(described(properties).groupBy("legal", "owner_name").agg(F.count("*").alias("n")), "kinds")
    pairs = meet(asked.select("legal_query").distinct(), kinds.select("legal").distinct())
    found = asked.hint("merge").join(pairs, "legal_query").hint("merge").join(kinds, "legal").filter(c("owner_query").isNull() | F.upper(blank(c("owner_name"))).contains(c("owner_query")))
    return files.kept(found.select("legal_query", "owner_query", "legal", "owner_name", "n"), "meetings")


def described(properties: DataFrame) -> DataFrame:
    """Properties with the text that is searched, in capitals."""
    return properties.withColumn("legal", F.upper(blank(F.col("legal_text"))))


def hits(queried: DataFrame, properties: DataFrame, met: DataFrame) -> DataFrame:
    """Each lead and tier with each property that it finds, by meetings().

    Properties are dealt to the searches that find their kind. A search's leads and its properties are each dealt into
    parts of about LIST and CELL; a part of one meets each part of the other in a cell of their own, so that no task holds
    all of either side; a property moves once for LIST hits, a lead once for CELL. Searches go by a number, their texts do
    not move with each property. Both sides of these joins may be large, so neither is broadcast.
    Rows hold the columns of both sides: fewer of them are cheaper.
    """
    c, by = F.col, ["legal_query", "owner_query"]
    ready = queried.filter("query_state = 'READY'")
    parts = lambda n, most: F.ceil(c(n) / most).cast("int")
    many = ready.groupBy(*by).agg(F.count("*").alias("leads"))
    found = met.groupBy(*by).agg(F.sum("n").alias("finds"))
    sizes = many.join(found, _same(many, found, by)).select(*[many[k].alias(f"__{k}") for k in by], parts("leads", min(LIST, CELL)).alias("__is"), parts("finds", CELL).alias("__js"))
    sizes = files.kept(sizes.withColumn("__s", F.monotonically_increasing_id()), "searches")
    searched = lambda df: reduce(lambda x, y: x & y, [df[k].eqNullSafe(c(f"__{k}")) for k in by])
    kinds = met.join(sizes, searched(met)).select("__s", "__is", "__js", c("legal").alias("__legal"), c("owner_name").alias("__owner_name"))
    own = described(properties)
    finds = kinds.hint("merge").join(own, (c("legal") == c("__legal")) & c("owner_name").eqNullSafe(c("__owner_name")))
    finds = finds.select(*properties.columns, c("__s").alias("__f_s"), F.pmod(F.xxhash64("property_id"), "__js").cast("int").alias("__f_j"), F.explode(F.sequence(F.lit(0), c("__is") - 1)).alias("__f_i"))
    # A part of the leads is one row: what is made of a cell is made by one loop, without a row of the join for each hit.
    others = [k for k in ready.columns if k not in by]
    asks = ready.join(sizes, searched(ready)).withColumn("__i", F.pmod(F.xxhash64("lead_id", "tier"), "__is").cast("int"))
    asks = asks.groupBy(*[f"__{k}" for k in by], "__s", "__js", "__i").agg(F.collect_list(F.struct(*others)).alias("__asks"))
    asks = asks.withColumn("__j", F.explode(F.sequence(F.lit(0), c("__js") - 1)))
    cell = (c("__s") == c("__f_s")) & (c("__i") == c("__f_i")) & (c("__j") == c("__f_j"))
    # Properties come first: the join puts out what one row of its first side makes before it rests.
    met = finds.hint("merge").join(asks, cell).select(*[f"__{k}" for k in by], *properties.columns, F.explode("__asks").alias("__a"))
    return met.select(*[c(f"__{k}" if k in by else f"__a.{k}").alias(k) for k in ready.columns], *properties.columns)


def search(queried: DataFrame, properties: DataFrame, meet=by_rarest) -> DataFrame:
    """Properties whose legal text contains the legal query and whose owner contains the owner query: a row a lead, tier and property."""
    return hits(queried, properties, meetings(queried, properties, meet))


def first_hits(queried: DataFrame, properties: DataFrame, met: DataFrame, most: int) -> DataFrame:
    """Of hits(), the first so many of each lead and tier by property_id, as (lead_id, tier, property_id): found once a search, by the first of each kind."""
    c, by = F.col, ["legal_query", "owner_query"]
    least = lambda df, keys: df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("property_id"))).filter(c("__n") <= most).drop("__n")
    own = least(described(properties).select(c("legal").alias("__legal"), c("owner_name").alias("__owner_name"), "property_id"), ["__legal", "__owner_name"])
    found = met.hint("merge").join(own, (c("legal") == c("__legal")) & c("owner_name").eqNullSafe(c("__owner_name"))).select(*by, "property_id")
    found = least(found, by).groupBy(*by).agg(F.array_sort(F.collect_list("property_id")).alias("__ids"))
    ready = queried.filter("query_state = 'READY'")
    return ready.join(found, _same(ready, found, by)).select("lead_id", "tier", F.explode("__ids").alias("property_id"))


def outcomes(queried: DataFrame, met: DataFrame) -> DataFrame:
    """A row a lead and tier: how many properties it finds and the least owner's name among them, by meetings(); no hit is made for it."""
    by = ["legal_query", "owner_query"]
    found = met.groupBy(*by).agg(F.sum("n").alias("n"), F.min("owner_name").alias("owner_name"))
    ready = F.col("query_state") == "READY"
    rows = queried.join(found, ready & _same(queried, found, by), "left").select(*[queried[k] for k in queried.columns], F.coalesce("n", F.lit(0).cast("long")).alias("n"), "owner_name")
    return rows


def status(found: Column, error: Column) -> Column:
    """A search's outcome by the number of hits."""
    # The names of outcomes, here and in fall_back().
    return F.when(error, "ERROR").when(found.isNull(), "NO_HITS_OR_UNKNOWN_PAGE").when(found == 0, "NO_HITS").when(found == 1, "UNIQUE_HIT").when(found > PAGE, "PAGINATION_TOO_LARGE").otherwise("MULTIPLE_HITS")


def target(tier: Column, grantee: Column, decedent_first: Column, decedent_last: Column, party_first: Column, party_last: Column) -> Column:
    """The full name that a property's owner is compared with, by tier; null if there is none."""
    dec, par = (F.nullif(F.trim(F.concat(F.upper(F.trim(blank(a))), F.lit(" "), F.upper(F.trim(blank(b))))), F.lit("")) for a, b in ((decedent_first, decedent_last), (party_first, party_last)))
    other = F.when(blank(party_last) != "", par).otherwise(dec)
    return F.when(tier.contains("GranteeLastName"), F.nullif(F.upper(F.trim(grantee)), F.lit(""))).when(tier.contains("DecedentLastName") | tier.contains("Fallback_Owner"), dec).otherwise(other)


def summary_score(tier: Column, grantee_last: Column, decedent_last: Column, owner: Column, subdivision: Column, address: Column, full_legal: Column, by=similarity) -> Column:
    """Owner and subdivision in equal parts; in two tiers a close legal text adds a fifth of its ratio. by: what compares."""
    last = F.when(tier.contains("GranteeLastName"), F.upper(F.trim(blank(grantee_last)))).when(tier.contains("DecedentLastName") | tier.contains("Fallback_Owner"), F.upper(F.trim(blank(decedent_last)))).otherwise("")
    own, sub, addr = F.upper(F.trim(blank(owner))), no_nan(subdivision), F.upper(F.trim(blank(address)))
    named, placed = (last != "") & (own != ""), (sub != "") & (addr != "")
    part = F.when(named, by.token_set_ratio(F.when(named, last), F.when(named, own))).otherwise(0.0) * 0.5
    part = part + F.when(placed, by.token_set_ratio(F.when(placed, sub), F.when(placed, addr))).otherwise(0.0) * 0.5
    whole = tier.isin(legal.TIERS[3], legal.TIERS[4]) & (blank(full_legal) != "") & (addr != "")
    close = F.when(whole, by.partial_ratio(F.when(whole, full_legal), F.when(whole, addr)))
    return part + F.when(close > 70, close * 0.2).otherwise(0.0)


def detail_score(tier: Column, tract: Column, block: Column, lot: Column, section: Column, subdivision: Column, target_name: Column, detail_legal: Column, owner: Column, by=similarity) -> Column:
    """Seven parts legal text to three parts owner, 0 to 100. by: what compares."""
    text, own = F.upper(F.trim(blank(detail_legal))), F.upper(F.trim(blank(owner)))
    t, b, x, s, d = map(no_nan, (tract, block, lot, section, subdivision))
    has = lambda name, v, points: F.when((v != "") & text.contains(F.concat(F.lit(f"{name} "), v)), points).otherwise(0.0)
    lots = F.when((x != "") & (text.contains(F.concat(F.lit("LT "), x)) | text.contains(F.concat(F.lit("LOT "), x))), 20.0).otherwise(0.0)
    parts = has("TR", t, 40.0) + has("BLK", b, 30.0) + lots + has("SEC", s, 10.0)
    placed = (d != "") & (text != "")
    parts = parts + F.when(placed, by.token_set_ratio(F.when(placed, d), F.when(placed, text)) / 100.0 * 30).otherwise(0.0)
    whole = legal.full_text(tract, block, subdivision, lot, section)
    last = (tier == legal.TIERS[6]) & (whole != "") & (text != "")
    raw = F.when(tier == legal.TIERS[6], F.when(last, by.ratio(F.when(last, whole), F.when(last, text))).otherwise(0.0)).otherwise(parts)
    legal_part = F.least(F.lit(100.0), raw / 130.0 * 100.0)
    alike = by.token_set_ratio(target_name, own)
    alike = F.when((alike < 60) & (tier.startswith("T1_") | tier.contains("Fallback_Owner")), F.greatest(F.lit(0.0), alike - 20)).otherwise(alike)
    there = blank(target_name) != ""
    owner_part = F.when((own != "") & there, alike).when(there, 20.0).when(own != "", 30.0).otherwise(50.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), legal_part * 0.70 + owner_part * 0.30))


def choose(candidates: DataFrame, key: str = "lead_id") -> DataFrame:
    """The candidate that wins, a row a lead: (key, ord, chosen_by, score), no row where none does.

    candidates: (key, ord, confidence, summary, detail), detail null where details cannot be had. First: a clear best
    summary. Else the best three by summary get their details: the first at AT_ONCE wins; else the best, if good
    enough for the lead's confidence and clear of the second.
    """
    by_summary = Window.partitionBy(key).orderBy(F.desc("summary"), F.asc("ord"))
    c = F.col
    ranked = candidates.withColumn("rank", F.row_number().over(by_summary)).filter(c("rank") <= max(2, DETAILS))
    scored = F.coalesce("detail", "summary")
    folded = ranked.groupBy(key).agg(F.first("confidence").alias("confidence"), F.array_sort(F.collect_list(F.struct("rank", "ord", "summary", scored.alias("score"), c("detail").isNotNull().alias("detailed")))).alias("all"))
    a = c("all")
    first, second = F.get(a, 0), F.get(a, 1)
    clear = (first["summary"] >= SUMMARY_LEAST) & (second.isNull() | (first["summary"] - second["summary"] >= SUMMARY_GAP))
    at_once = F.get(F.filter(F.slice(a, 1, DETAILS), lambda x: x["detailed"] & (x["score"] >= AT_ONCE)), 0)
    order = F.array_sort(F.transform(F.slice(a, 1, DETAILS), lambda x: F.struct((-x["score"]).alias("s"), x["rank"].alias("rank"), x["ord"].alias("ord"))))
    best, next_ = F.get(order, 0), F.get(order, 1)
    sure = c("confidence") == "High"
    least, gap = F.when(sure, SURE_LEAST).otherwise(LOOSE_LEAST), F.when(sure, SURE_GAP).otherwise(LOOSE_GAP)
    good = (-best["s"] >= least) & (next_.isNull() | (next_["s"] - best["s"] >= gap)) & ~(sure & (best["s"] == 0))
    pick = (
        F.when(clear, F.struct(first["ord"].alias("ord"), F.lit("summary").alias("chosen_by"), first["score"].alias("score")))
        .when(at_once.isNotNull(), F.struct(at_once["ord"].alias("ord"), F.lit("at_once").alias("chosen_by"), at_once["score"].alias("score")))
        .when(good, F.struct(best["ord"].alias("ord"), F.lit("detail").alias("chosen_by"), (-best["s"]).alias("score")))
    )
    return folded.withColumn("p", pick).filter("p is not null").select(key, "p.ord", "p.chosen_by", "p.score")


def with_details(hits: DataFrame, details: DataFrame) -> DataFrame:
    """Details of hits by the account in their link, else by the account listed; each account is looked up once."""
    keyed = hits.withColumn("detail_key", F.coalesce(account_in(F.col("hcad_detail_url")), F.col("hcad_account_summary")))
    return keyed.join(details.withColumnRenamed("hcad_account", "detail_key"), "detail_key", "left")


def fall_back(tiers: DataFrame, key: str = "lead_id") -> DataFrame:
    """The outcome of searching tier after tier, folded in order: (key, hcad_search_status, hcad_final_tier_hit, first_page).

    tiers: a row a lead and tier (ord, tier, status, chosen: whether a candidate was found or won, named: whether the
    owner's name confirms it, subdivision). A success ends the search, but a first-tier unique hit whose owner does not
    confirm it goes on, and keeps its standing only if no later tier is searched. A search with too many hits bars the
    broader tiers of the same subdivision.
    """
    row = F.struct("ord", "tier", "status", "chosen", "named", "subdivision")
    folded = tiers.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("all"))
    start = F.struct(F.lit("NO_HCAD_MATCH_FOUND_ALL_TIERS").alias("s"), F.lit("N/A").alias("t"), F.lit(False).alias("ended"), F.lit(False).alias("broad"), F.lit(False).alias("found"))

    def step(at: Column, x: Column) -> Column:
        later = x["tier"].isin(legal.TIERS[3], legal.TIERS[4], legal.TIERS[6])
        skip = later & at["broad"] & (x["subdivision"] != "")
        s, first = x["status"], x["tier"] == legal.TIERS[0]
        hit = s.isin("UNIQUE_HIT", "SINGLE_ITEM_IN_LIST")
        won = hit & x["chosen"] | (s == "MULTIPLE_HITS") & x["chosen"]
        weak = hit & x["chosen"] & first & ~x["named"]
        name = (
            F.when(skip, "SKIPPED_DUE_TO_BROAD_SEARCH")
            .when(weak, "SUCCESS_T0_NEEDS_NAME_CONFIRM")
            .when(won, "SUCCESS")
            .when(hit, "DETAIL_PARSE_FAILED")
            .when(s == "MULTIPLE_HITS", F.concat(F.lit("MULTIPLE_HITS_NO_WINNER_TIER_"), x["tier"]))
            .when(s == "ERROR", F.concat(F.lit("ERROR_IN_TIER_"), x["tier"]))
            .otherwise(s)
        )
        ends = ~skip & ((won & ~weak) | (hit & ~x["chosen"]) | (s == "ERROR") | (s == "SINGLE_ITEM_IN_LIST"))
        new = F.struct(
            name.alias("s"),
            F.when(won & ~skip, x["tier"]).otherwise(at["t"]).alias("t"),
            ends.alias("ended"),
            (at["broad"] | (~skip & (s == "PAGINATION_TOO_LARGE") & (x["subdivision"] != ""))).alias("broad"),
            (at["found"] | (won & ~skip)).alias("found"),
        )
        return F.when(at["ended"], at).otherwise(new)

    done = folded.withColumn("at", F.aggregate("all", start, step))
    s = F.col("at.s")
    tier = F.when(s == "SUCCESS", F.col("at.t")).when(s == "PAGINATION_TOO_LARGE", F.col("at.t")).when((s == "SUCCESS_T0_NEEDS_NAME_CONFIRM") & F.col("at.found"), legal.TIERS[0]).otherwise("N/A")
    return done.select(key, s.alias("hcad_search_status"), tier.alias("hcad_final_tier_hit"))


def name_confirms(owner: Column, decedent_last: Column, party_last: Column) -> Column:
    o, d, p = (F.upper(F.trim(blank(x))) for x in (owner, decedent_last, party_last))
    return (o != "") & (((d != "") & o.contains(d)) | ((p != "") & o.contains(p)))


def too_common(last: Column, block: Column, tract: Column) -> Column:
    return F.upper(last).isin(names.COMMON_SURNAMES) & (no_nan(block) == "") & (no_nan(tract) == "")
