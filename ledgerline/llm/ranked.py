"""Operator 12, exact ranked search over a tiered index.

The index holds all words of all documents. A posting's impact, what it gives a score but for its term's weight, hangs on the
collection alone, so postings are laid down by impact: of each term the highest TOP are the first tier, the next ones up to
FACTOR times as many the second, and so on. What a term can still give to a document that its upper tiers do not name is at
most the highest impact below them, its residual bound.

A search reads the first tier. An item's K-th best score so far is what a document must reach. Where the residual bounds of
its terms together stay under that, no document outside the tiers read can be among the best: that is the proof, and only
the few documents that might still rise are looked up in the lower tiers, by block. Items without the proof fall through to
the next tier, to the last one if need be, where nothing is left to bound.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .decontam import words

K = 10
#: Postings of a term in the first tier; how many times as many each next tier reaches.
TOP, FACTOR = 512, 8
#: Words of a segment, but for one document that has more, and documents of it at most.
WORDS, DOCS = 1 << 22, 1 << 16
#: An item with more documents left to look up reads the next tier first. This is about cost alone.
MOST = 1000
#: Share of a segment's documents beyond which a term's postings there are dealt by term and segment, not by term.
HOT = 8

SEGMENT = "segment bigint, doc_ids array<bigint>, n_docs bigint, n_all bigint, n_words binary, terms binary, counts binary, slots binary, tfs binary"
PART = "bucket int, hot boolean, segment bigint, terms binary, counts binary, slots binary, impacts binary"
LIST = "term binary, tier int, block bigint, n bigint, top bigint, dids binary, impacts binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


@dataclass(frozen=True)
class Index:
    """segments: whole documents and their terms. lists: postings by term, tier and block. n_docs, n_words: documents with a term, all their terms."""

    segments: DataFrame
    lists: DataFrame
    n_docs: int
    n_words: int


class _Known(dict):
    def __missing__(self, word):
        out = self[word] = len(self)
        return out


def _segments(docs: DataFrame, column: str) -> DataFrame:
    import pyarrow as pa
    from pyspark import TaskContext

    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), *[pa.binary()] * 5]

    def run(batches):
        segment, known, ids, doc_ids, sizes, held = TaskContext.get().partitionId() << 20, _Known(), [], [], [], 0

        def flush():
            n = np.array(sizes, np.int64)
            key = np.concatenate(ids).astype(np.int64) << 16 | np.repeat(np.arange(len(n)), n)
            key, tf = np.unique(key, return_counts=True)
            row = [segment, doc_ids, int((n > 0).sum()), int(n.sum()), common.planes(n, "<u4"), common.pressed(b" ".join(known)), common.planes(np.bincount(key >> 16, minlength=len(known)), "<u4"), common.planes(key & 0xFFFF, "<u2"), common.planes(tf, "<u4")]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], _names(SEGMENT))

        for b in common.sliced(batches):
            for d, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                own = words(text)
                if doc_ids and (held + len(own) > WORDS or len(doc_ids) == DOCS):
                    yield flush()
                    segment, known, ids, doc_ids, sizes, held = segment + 1, _Known(), [], [], [], 0
                ids.append(np.fromiter(map(known.__getitem__, own), np.int32, len(own)))
                doc_ids.append(d)
                sizes.append(len(own))
                held += len(own)
        if doc_ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("string").alias("text")).mapInArrow(run, SEGMENT)


def _parts(segments: DataFrame, n_docs: int, n_words: int, buckets: int) -> DataFrame:
    """Each segment's postings with their impacts, dealt by term; those of its hot terms by term and segment."""
    import pyarrow as pa

    kinds = [pa.int32(), pa.bool_(), pa.int64(), *[pa.binary()] * 4]

    def run(batches):
        for b in batches:
            for segment, sizes, terms, counts, slots, tfs in zip(*(b.column(i).to_pylist() for i in (0, 4, 5, 6, 7, 8))):
                names = common.plain(terms)
                names = names.split(b" ") if names else []
                n, counts = common.from_planes(sizes, "<u4").astype(np.int64), common.from_planes(counts, "<u4").astype(np.int64)
                slots, tf = common.from_planes(slots, "<u2"), common.from_planes(tfs, "<u4").astype(np.int64)
                m = 10 + 90 * n * n_docs // n_words
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[slots])
                hot = counts * HOT > len(n)
                hot &= counts > 64
                salt = b" %d" % segment
                bucket = np.array([zlib.crc32(t + salt if h else t) % buckets for t, h in zip(names, hot.tolist())], np.int64)
                cell = bucket * 2 + hot
                order = np.argsort(cell, kind="stable")
                ends = np.cumsum(counts)
                cuts = np.flatnonzero(np.diff(cell[order], prepend=-1, append=-1)) if len(order) else np.zeros(0, int)
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    own = order[x:y]
                    at = np.repeat(ends[own] - counts[own] - (np.cumsum(counts[own]) - counts[own]), counts[own]) + np.arange(counts[own].sum())
                    row = [int(bucket[own[0]]), bool(hot[own[0]]), segment, b" ".join(names[i] for i in own.tolist()), counts[own].astype("<u4").tobytes(), slots[at].astype("<u2").tobytes(), impact[at].astype("<u4").tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], _names(PART))

    return segments.mapInArrow(run, PART)


def tiers(terms: np.ndarray, dids: np.ndarray, impacts: np.ndarray, top: int) -> np.ndarray:
    """The tier of each posting: by its place among its term's, highest impact first, of equals the least did."""
    order = np.lexsort((dids, -impacts, terms))
    t = terms[order]
    place = np.empty(len(t), np.int64)
    place[order] = np.arange(len(t)) - np.searchsorted(t, t)
    cuts = [top]
    while len(t) and cuts[-1] <= place.max():
        cuts.append(cuts[-1] * FACTOR)
    return np.searchsorted(cuts, place, "right")


def _binary(flat: np.ndarray, ends: np.ndarray):
    """An Arrow column of the bytes of stretches of an array."""
    import pyarrow as pa

    offsets = np.concatenate([[0], ends]) * flat.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def _lists(parts: DataFrame, segments: int) -> DataFrame:
    """Rows of LIST. The first tier of a term is one row a bucket; lower ones have a row a block, which is a segment.

    A hot term's chunk has of each tier the share that its segments are of all.
    """
    import pyarrow as pa

    def solve(hot, held):
        known, terms, dids, impacts = _Known(), [], [], []
        for segment, names, counts, slots, own in held:
            counts = np.frombuffer(counts, "<u4").astype(np.int64)
            terms.append(np.repeat(np.fromiter(map(known.__getitem__, names.split(b" ")), np.int64, len(counts)), counts))
            dids.append(segment << 16 | np.frombuffer(slots, "<u2").astype(np.int64))
            impacts.append(np.frombuffer(own, "<u4").astype(np.int64))
        terms, dids, impacts = np.concatenate(terms), np.concatenate(dids), np.concatenate(impacts)
        tier = tiers(terms, dids, impacts, max(1, TOP * len(held) // segments) if hot else TOP)
        block = np.where(tier > 0, dids >> 16, -1)
        order = np.lexsort((dids, block, tier, terms))
        terms, tier, block, dids, impacts = (x[order] for x in (terms, tier, block, dids, impacts))
        new = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (tier[1:] != tier[:-1]) | (block[1:] != block[:-1])))
        ends = np.append(new[1:], len(terms))
        vocabulary = pa.array(list(known), pa.binary())
        cols = [vocabulary.take(pa.array(terms[new])), pa.array(tier[new].astype(np.int32)), pa.array(block[new]), pa.array(ends - new), pa.array(np.maximum.reduceat(impacts, new)), _binary(dids.astype("<i8"), ends), _binary(impacts.astype("<u4"), ends)]
        return pa.RecordBatch.from_arrays(cols, _names(LIST))

    def run(batches):
        at, held = None, []
        for b in batches:
            for bucket, hot, *row in zip(*(b.column(i).to_pylist() for i in range(7))):
                if (bucket, hot) != at:
                    if held:
                        yield from common.sliced([solve(at[1], held)], BLOCK_ROWS)
                    at, held = (bucket, hot), []
                held.append(row)
        if held:
            yield from common.sliced([solve(at[1], held)], BLOCK_ROWS)

    return parts.repartition("bucket").sortWithinPartitions("bucket", "hot").mapInArrow(run, LIST)


#: Rows of a batch that a task hands on.
BLOCK_ROWS = 8192


def build(docs: DataFrame, column: str = "text") -> Index:
    """The tiered index of a table, in the shared folder.

    A row is a document, whatever its doc_id: a null id stays null, rows repeated count each. Null and empty texts have no
    terms and are not counted as documents. Columns other than doc_id and the text are not read. An empty table has no lists.
    """
    spark = docs.sparkSession
    segments = common.keep(_segments(docs, column), "segments")
    n, n_docs, n_words = common.collect(segments.agg(F.count("*"), F.sum("n_docs"), F.sum("n_all")))[0]
    buckets = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    some = segments.filter("n_all > 0")
    lists = common.keep(_lists(_parts(some, n_docs or 0, n_words or 1, buckets), max(1, n)), "lists", by="tier")
    return Index(segments, lists, n_docs or 0, n_words or 0)


def _terms(items: DataFrame) -> DataFrame:
    """(item, term): the different terms of each item."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            rows = [(i, t) for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()) for t in dict.fromkeys(words(text))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["item", "term"])

    return items.mapInArrow(run, "item bigint, term binary").distinct()


def _postings(rows: DataFrame) -> DataFrame:
    """(item, did, score, bound) of each posting of rows (item, w, bound, dids, impacts): what it gives, and what its term is bound by below."""
    import pyarrow as pa

    names = ["item", "did", "score", "bound"]

    def run(batches):
        for b in common.sliced(batches):
            for item, w, bound, dids, impacts in zip(*(b.column(i).to_pylist() for i in range(5))):
                dids = np.frombuffer(dids, "<i8")
                whole = pa.RecordBatch.from_arrays([pa.array(np.full(len(dids), item, np.int64)), pa.array(dids), pa.array(w * np.frombuffer(impacts, "<u4").astype(np.int64)), pa.array(np.full(len(dids), w * bound, np.int64))], names)
                yield from common.sliced([whole], BLOCK_ROWS)

    return rows.select("item", "w", "bound", "dids", "impacts").mapInArrow(run, "item bigint, did bigint, score bigint, bound bigint")


def _found(rows: DataFrame) -> DataFrame:
    """(term, did, impact) of the postings of rows (term, wanted, dids, impacts) that are wanted."""
    import pyarrow as pa

    def run(batches):
        for b in common.sliced(batches):
            out = []
            for term, wanted, dids, impacts in zip(*(b.column(i).to_pylist() for i in range(4))):
                dids = np.frombuffer(dids, "<i8")
                at = np.flatnonzero(np.isin(dids, np.array(wanted, np.int64)))
                out += [(term, d, x) for d, x in zip(dids[at].tolist(), np.frombuffer(impacts, "<u4")[at].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.binary(), pa.int64(), pa.int64()))], ["term", "did", "impact"])

    return rows.select("term", "wanted", "dids", "impacts").mapInArrow(run, "term binary, did bigint, impact bigint")


def _weighed(index: Index, asked: DataFrame) -> DataFrame:
    """(term, w, tops): for the terms asked for their weights and, by tier, their highest impacts."""
    own = index.lists.select("term", "tier", "n", "top").join(asked.select("term").distinct(), "term", "left_semi")
    tops = own.groupBy("term", "tier").agg(F.sum("n").alias("n"), F.max("top").alias("top")).groupBy("term").agg(F.sum("n").alias("df"), F.collect_list(F.struct("tier", "top")).alias("tops"))
    ratio = (2 * F.lit(index.n_docs).cast("double") + 2) / (2 * F.col("df").cast("double") + 1)
    return tops.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"), "tops")


def _exact(index: Index, left: DataFrame, terms: DataFrame, tier: int) -> DataFrame:
    """Scores of the documents left over (item, did, score) with what lower tiers add; terms: (item, term, w, bound)."""
    needs = left.select("item", "did", F.shiftright("did", 16).alias("block")).join(terms.filter("bound > 0"), "item").select("item", "did", "block", "term", "w")
    needs = common.keep(needs, "needs")
    wanted = needs.groupBy("term", "block").agg(F.collect_set("did").alias("wanted"))  # at most a block's documents
    lower = index.lists.filter(F.col("tier") > tier).select("term", "block", "dids", "impacts").join(wanted, ["term", "block"])
    more = _found(lower).join(needs, ["term", "did"]).groupBy("item", "did").agg(F.sum(F.col("w") * F.col("impact")).alias("more"))
    return left.join(more, ["item", "did"], "left").select("item", "did", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score"))


def best(index: Index, items: DataFrame, k: int = K) -> tuple[DataFrame, list[int]]:
    """(item, did, score) of all documents that reach an item's k-th best score, and how many items each tier proved. items: (item long, text)."""
    from pyspark.sql import Window

    asked = common.keep(_terms(items), "asked")
    weighed = common.keep(_weighed(index, asked), "weighed")
    deepest = common.collect(weighed.select(F.explode("tops").alias("t")).agg(F.max("t.tier")))[0][0]
    out, proved, least = None, [], None
    active = asked.select("item").distinct()
    for tier in range(0 if deepest is None else deepest + 1):
        bound = F.coalesce(F.array_max(F.transform(F.filter("tops", lambda t: t["tier"] > tier), lambda t: t["top"])), F.lit(0))
        terms = common.keep(asked.join(active, "item", "left_semi").join(weighed.select("term", "w", bound.alias("bound")), "term"), "terms")
        rest = terms.groupBy("item").agg(F.sum(F.col("w") * F.col("bound")).alias("rest"))
        read = index.lists.filter(F.col("tier") <= tier).select("term", "dids", "impacts").join(terms, "term")
        seen = _postings(read).groupBy("item", "did").agg(F.sum("score").alias("score"), F.sum("bound").alias("bound")).join(rest, "item")
        seen = seen.select("item", "did", "score", (F.col("score") + F.col("rest") - F.col("bound")).alias("most"), "rest").filter("most > 0")
        if least is not None:  # what the tiers above have shown already
            seen = seen.join(least, "item", "left").filter("most >= coalesce(least, 0)").drop("least")
        seen = common.keep(seen, "seen")
        first = seen.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).filter(F.col("r") <= k)
        least = common.keep(first.groupBy("item").agg(F.when(F.count("*") == k, F.min("score")).otherwise(0).alias("least"), F.max("rest").alias("rest")), "least")
        left = seen.drop("rest").join(least, "item").filter("most >= least")
        sure = left.filter("rest = 0 or rest < least").groupBy("item", "rest").agg(F.count("*").alias("n")).filter(F.lit(tier == deepest) | (F.col("rest") == 0) | (F.col("n") <= MOST)).select("item")
        sure = common.keep(sure, "sure")
        done = left.join(sure, "item", "left_semi").select("item", "did", "score")
        done = common.keep(_exact(index, done, terms, tier), "done")
        out = done if out is None else out.union(done)
        proved.append(common.collect(sure.agg(F.count("*")))[0][0])
        active = common.keep(active.join(sure, "item", "left_anti"), "active")
        least = least.select("item", "least")
        common.drop(seen)
        if common.is_empty(active):
            break
    return (out if out is not None else items.sparkSession.createDataFrame([], "item bigint, did bigint, score bigint")), proved


def search(index: Index, items: DataFrame, k: int = K) -> DataFrame:
    """The k documents with the highest scores above 0 of each item (item_id, text): item_id, rank int (from 1), doc_id, score long.

    Exact; equal scores by ascending doc_id, a null one last. Rows that share an item_id, a null one too, are one item with
    all their terms, each once. Items without terms, or none of whose terms any document has, have no rows; nor has an
    empty table. Other columns are not read, whatever their names.
    """
    from pyspark.sql import Window

    named = common.keep(items.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    texts = items.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text")).join(named, F.col("id").eqNullSafe(F.col("item_id"))).select("item", "text")
    found, _ = best(index, texts, k)
    docs = index.segments.select("segment", F.posexplode("doc_ids").alias("slot", "doc_id")).select((F.shiftleft("segment", 16) + F.col("slot")).alias("did"), "doc_id")
    ranked = found.filter("score > 0").join(docs, "did").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))
    return ranked.filter(F.col("rank") <= k).join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """search() of all items in the index of all documents. Nulls, repeats and empty tables are as there and in build()."""
    return search(build(docs), items)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d),
m AS (SELECT doc_id, w, 10 + (90 * len(w) * s.n) // s.l AS m FROM d, s WHERE len(w) > 0),
p AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(w) AS term FROM m) GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, s.n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(t.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN t USING (term) JOIN p USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 10
"""
