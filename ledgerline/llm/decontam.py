"""Operator 1, benchmark decontamination by a distributed positional inverted index.

The index is a table of segments: whole documents of about a million words, their terms, and for each term the places at
which it stands. It holds all words, so it is built once and searched for any benchmark. A search never meets all segments
with all phrases: the collection's counts name each phrase's rarest term, a phrase with a term that is nowhere ends there,
and the others are joined to the segments that have their rarest term. In a segment a phrase is looked up from its rarest
term there on: the lists of places, each shifted by its term's offset in the phrase, are intersected by length.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
#: Words of a segment, but for one document that has more.
WORDS = 1 << 20
#: Bits of the filter that keeps terms of segments which no phrase has from being joined; a term that it lets through wrongly
#: joins nothing.
MARKS = 1 << 22

#: A-Z to a-z; every other byte that no word holds to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | bytes | None) -> list[bytes]:
    """Words of a text, in UTF-8."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_FOLD).split()


class Index:
    """A segment in memory. Places count through all its documents, with a gap after each, so no phrase crosses two."""

    def __init__(self, terms: list[bytes], counts: np.ndarray, places: np.ndarray, n_words: np.ndarray):
        self.of = {t: k for k, t in enumerate(terms)}
        self.counts, self.places = counts, places
        self.ends = np.cumsum(counts)
        self.starts = np.cumsum(n_words + 1) - (n_words + 1)

    def list(self, term: bytes) -> np.ndarray:
        k = self.of.get(term)
        return self.places[:0] if k is None else self.places[self.ends[k] - self.counts[k] : self.ends[k]]

    def phrase(self, terms: list[bytes]) -> np.ndarray:
        """Places at which the terms stand one after another."""
        order = sorted(range(len(terms)), key=lambda i: self.counts[self.of[terms[i]]] if terms[i] in self.of else 0)
        at = None
        for i in order:
            own = self.list(terms[i]) - i
            at = own if at is None else at[_in(at, own)]
            if not len(at):
                break
        return at if at is not None else np.zeros(0, np.int64)

    def near(self, terms: list[bytes], slop: int) -> list[tuple[int, int]]:
        """Least spans (first, last place) of at most len(terms) + slop words that hold all the distinct terms, in any order.

        Places of the rarest term are anchors, dropped term by term where none of the next rarest is in reach; only what
        is in reach of an anchor that is left is swept.
        """
        terms = list(dict.fromkeys(terms))
        reach = len(terms) + slop
        lists = sorted(map(self.list, terms), key=len)
        if not lists or not len(lists[0]):
            return []
        anchors = lists[0]
        for own in lists[1:]:
            anchors = anchors[_within(anchors, own, reach)]
        if not len(anchors):
            return []
        lists = [own[_within(own, anchors, reach)] for own in lists]
        place = np.concatenate(lists)
        which = np.concatenate([np.full(len(x), k) for k, x in enumerate(lists)])
        order = np.argsort(place, kind="stable")
        last, out = [-1] * len(terms), []
        for p, k in zip(place[order].tolist(), which[order].tolist()):
            last[k] = p
            first = min(last)
            if first >= 0 and p - first < reach and np.searchsorted(self.starts, first, "right") == np.searchsorted(self.starts, p, "right"):
                if out and out[-1][0] == first:
                    continue
                out.append((first, p))
        return out


def _within(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    """Which of a have one of b less than reach away; both ascending, b not empty."""
    i = np.searchsorted(b, a - reach, "right")
    return (i < len(b)) & (b[np.minimum(i, len(b) - 1)] < a + reach)


def _in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    i = np.searchsorted(b, a)
    return (i < len(b)) & (b[np.minimum(i, len(b) - 1)] == a)


SEGMENT = "segment bigint, doc_ids array<bigint>, n_words binary, terms binary, counts binary, places binary"


class _Known(dict):
    def __missing__(self, word):
        out = self[word] = len(self)
        return out


def build(docs: DataFrame, column: str = "text") -> DataFrame:
    """The index of a table, a row a segment, kept in the shared folder.

    A row of docs is a document, whatever its doc_id; null ids stay null, null and empty texts have no words, repeated
    rows are indexed as often as they come. Columns other than doc_id and the text are not read. An empty table has no
    segments.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    def index(batches):
        segment, known, ids, doc_ids, sizes, held = TaskContext.get().partitionId() << 32, _Known(), [], [], [], 0

        def flush():
            n, t = np.array(sizes, np.int64), np.concatenate(ids)
            place = np.arange(len(t)) + np.repeat(np.arange(len(n)), n)
            place = place[np.argsort(t, kind="stable")]
            counts = np.bincount(t, minlength=len(known))
            step, first = np.diff(place, prepend=0), np.cumsum(counts) - counts
            step[first] = place[first]
            cols = [[segment], [doc_ids], [common.planes(n, "<u4")], [common.pressed(b" ".join(known))], [common.planes(counts, "<u4")], [common.planes(step, "<u4")]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4])], [c.split()[0] for c in SEGMENT.split(", ")])

        for b in batches:
            for d, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                own = words(text)
                if held and held + len(own) > WORDS:
                    yield flush()
                    segment, known, ids, doc_ids, sizes, held = segment + 1, _Known(), [], [], [], 0
                ids.append(np.fromiter(map(known.__getitem__, own), np.int32, len(own)))
                doc_ids.append(d)
                sizes.append(len(own))
                held += len(own)
        if doc_ids:
            yield flush()

    return common.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), column).mapInArrow(index, SEGMENT), "index")


def load(n_words: bytes, terms: bytes, counts: bytes, places: bytes) -> Index:
    counts, step, terms = common.from_planes(counts, "<u4").astype(np.int64), common.from_planes(places, "<u4").astype(np.int64), common.plain(terms)
    upto, first = np.cumsum(step), np.cumsum(counts) - counts
    places = upto - np.repeat(upto[first] - step[first], counts)
    return Index(terms.split(b" ") if terms else [], counts, places, common.from_planes(n_words, "<u4").astype(np.int64))


def _hashes(terms: list[bytes]) -> list[int]:
    import xxhash

    return [x - (1 << 64) if x >> 63 else x for x in map(xxhash.xxh3_64_intdigest, terms)]


def _windows(items: DataFrame, n: int) -> DataFrame:
    """(item, key, words) of every window of the items (name, text)."""
    import pyarrow as pa

    def cut(batches):
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                own = words(text)
                rows = [b" ".join(own[i : i + n]) for i in range(max(1, len(own) - n + 1) if own else 0)]
                keys = [hashlib.blake2b(w, digest_size=16).digest() for w in rows]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())], ["item", "key", "words"])

    return common.keep(items.mapInArrow(cut, "item string, key binary, words binary"), "windows")


def _to_look_up(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(segment, key, words): each window whose terms are all somewhere, with every segment that has the rarest of them."""
    import pyarrow as pa

    def terms(batches):
        for b in batches:
            rows = [(k, len(own), h) for k, own in zip(b.column(0).to_pylist(), (sorted(set(w.split(b" "))) for w in b.column(1).to_pylist())) for h in _hashes(own)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 3, [pa.binary(), pa.int32(), pa.int64()])], ["key", "n", "h"])

    wanted = common.keep(windows.mapInArrow(terms, "key binary, n int, h bigint"), "terms")
    marks = np.zeros(MARKS, bool)
    marks[[r[0] for r in common.collect(wanted.select(F.col("h").bitwiseAND(MARKS - 1)).distinct())]] = True  # at most MARKS rows
    sent = index.sparkSession.sparkContext.broadcast(np.packbits(marks).tobytes())

    def post(batches):
        marks = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        for b in batches:
            for segment, names, counts in zip(*(b.column(i).to_pylist() for i in range(3))):
                names = common.plain(names)
                h = np.array(_hashes(names.split(b" ") if names else []), np.int64)
                at = np.flatnonzero(marks[h & (MARKS - 1)])
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(np.full(len(at), segment, np.int64)), pa.array(common.from_planes(counts, "<u4")[at].astype(np.int64))], ["h", "segment", "n"])

    postings = common.keep(index.select("segment", "terms", "counts").mapInArrow(post, "h bigint, segment bigint, n bigint"), "postings")
    totals = postings.groupBy("h").agg(F.sum("n").alias("total"))
    rarest = wanted.join(totals, "h").groupBy("key", "n").agg(F.count("*").alias("there"), F.min(F.struct("total", "h")).alias("r")).filter("there = n")
    return rarest.select("key", "r.h").join(windows, "key").join(postings.select("h", "segment").distinct(), "h").select("segment", "key", "words")


FOUND = "segment bigint, nth int, doc_id bigint, n_words bigint, n_hit bigint, keys array<binary>"


def search(index: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per document of an index: doc_id, n_words, n_hit words inside occurrences, items (sorted names of those with any).

    items: (name string, text). A text of fewer than n words, but not none, is one window. Nothing of either side is
    broadcast or gathered: windows go to segments by a join, and names to documents by another.
    """
    import pyarrow as pa

    cut = _windows(items, n)
    windows = common.keep(cut.groupBy("key").agg(F.first("words").alias("words")), "distinct")
    sent = _to_look_up(index, windows)

    def match(batches):
        state = None

        def told():
            segment, doc_ids, lengths, _, hits, found = state
            cols = [[segment] * len(doc_ids), range(len(doc_ids)), doc_ids, lengths.tolist(), [0 if h is None else int(h.sum()) for h in hits], [sorted(x) for x in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.binary())])], [c.split()[0] for c in FOUND.split(", ")])

        for b in batches:
            for segment, key, phrase, doc_ids, *own in zip(*(b.column(i).to_pylist() for i in (0, *range(2, 9)))):
                if key is None:
                    if state:
                        yield told()
                    state = segment, doc_ids, common.from_planes(own[0], "<u4").astype(np.int64), load(*own), [None] * len(doc_ids), [set() for _ in doc_ids]
                    continue
                _, _, lengths, seg, hits, found = state
                terms = phrase.split(b" ")
                for at in seg.phrase(terms).tolist():
                    d = int(np.searchsorted(seg.starts, at, "right")) - 1
                    if hits[d] is None:
                        hits[d] = np.zeros(lengths[d], bool)
                    hits[d][at - int(seg.starts[d]) :][: len(terms)] = True
                    found[d].add(key)
        if state:
            yield told()

    none = [f"cast(null as {'array<bigint>' if c == 'doc_ids' else 'binary'}) as {c}" for c in ("doc_ids", "n_words", "terms", "counts", "places")]
    rows = index.selectExpr("segment", "0 as kind", "cast(null as binary) as key", "cast(null as binary) as words", "doc_ids", "n_words", "terms", "counts", "places")
    rows = rows.union(sent.selectExpr("segment", "1 as kind", "key", "words", *none)).repartition("segment").sortWithinPartitions("segment", "kind")
    found = common.keep(rows.mapInArrow(match, FOUND), "found")
    hit = found.filter(F.size("keys") > 0).select("segment", "nth", F.explode("keys").alias("key"))
    named = hit.join(cut.select("key", "item").distinct(), "key").groupBy("segment", "nth").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return found.join(named, ["segment", "nth"], "left").select("doc_id", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def proximity(index: DataFrame, terms: str, slop: int) -> DataFrame:
    """Least spans that hold all words of ``terms`` within their number plus ``slop`` words: doc_id, first, last (word numbers).

    Words in any order, repeats counted once; no words, no spans. Documents are the index's rows, null ids among them.
    """
    import pyarrow as pa

    wanted = words(terms)

    def run(batches):
        for b in common.sliced(batches):
            out = []
            for doc_ids, *own in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
                seg = load(*own)
                for first, last in seg.near(wanted, slop):
                    d = int(np.searchsorted(seg.starts, first, "right")) - 1
                    out.append((doc_ids[d], first - int(seg.starts[d]), last - int(seg.starts[d])))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*out)) or [[], [], []])], ["doc_id", "first", "last"])

    return index.mapInArrow(run, "doc_id bigint, first bigint, last bigint")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (names), contaminated (n_hit > 0 and 20 n_hit >= n_words).

    Null and empty texts have no words and are clean. Equal rows are judged alike, each with a row of its own. A null
    item_id is named ''. Without documents there are no rows; without items no hits.
    """
    found = search(build(docs), benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text"))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return contaminated(docs, benchmark).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    bad = contaminated(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
q AS (SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS k
      FROM b, unnest(range(1, greatest(2, len(ws) - 11))) r(i) WHERE len(ws) > 0),
s AS (SELECT DISTINCT n FROM q),
w AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k FROM d, s, unnest(range(1, len(ws) - n + 2)) r(i)),
h AS (SELECT w.doc_id, w.i, w.n, q.item_id FROM w JOIN q ON w.k = q.k AND w.n = q.n),
c AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM h, unnest(range(0, n)) r(o) GROUP BY doc_id),
e AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY doc_id),
f AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(items, []) AS items FROM d LEFT JOIN c USING (doc_id) LEFT JOIN e USING (doc_id))
SELECT doc_id, n_words, n_hit, len(items)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
    n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM f
"""
