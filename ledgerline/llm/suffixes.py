"""Operator 3, removal of repeated strings by column-wise construction of a collection's Burrows-Wheeler transform.

Every string of LENGTH bytes that starts twice anywhere is covered. The transform is built as a collection grows from
its right end: each round inserts one symbol of every document, which re-sorts all by one step, and updates the common
prefixes of neighbours; columns, order and prefixes are read and written in sequence, in files. A string is repeated if
its suffix shares LENGTH symbols with a neighbour.

A whole corpus would need as many rounds as its longest document has bytes, so it is first dealt into collections of
short, aligned pieces, without loss. A string's anchor is the place of the least hash in it, so equal strings have
anchors at equal offsets. Strings of one anchor whose offsets lie in one stretch of WIDTH form a cell; all of them hold
the cell's core, so equal strings lie in cells with equal cores. Only cells whose core occurs twice matter: where two
are equal as a whole, all their strings are repeated; different ones with one core go through the construction, whose
documents they are, LENGTH + WIDTH - 1 columns wide. Cores are found by a rolling 64-bit hash, which only brings cells
together: two different cores of one hash meet in a construction, which compares bytes. That cells are equal as a whole is
decided by BLAKE2b of their bytes, 128 bits under a key drawn anew for each run, so that no text can be made to collide. A core with more than MEMBERS
different cells is dealt further by its strings themselves: a stretch of one string is its own core, and equal cores (by a
128-bit hash) are equal strings. The construction's sequential files are scratch of one task and are lost only with it.
"""

from __future__ import annotations

import hashlib
import secrets
import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, WIDTH, GRAM = 400, 64, 16
COLUMNS = LENGTH + WIDTH - 1
#: Documents of one construction.
MEMBERS = 1 << 14
#: Bytes whose strings are found at once; cells of a chunk.
SLICE, ENTRIES = 1 << 20, 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _table() -> np.ndarray:
    return np.frombuffer(hashlib.shake_128(b"bytes").digest(2048), "<u8")


_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, _U)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0x9FB21C651E98DF25)
    return h ^ (h >> _U(32))


def least(v: np.ndarray, w: int) -> np.ndarray:
    """Minima of all stretches of w values: two passes over blocks of w."""
    n = len(v)
    pad = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, v.dtype)
    pad[:n] = v
    grid = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def cells(texts: list[bytes], key: bytes = b""):
    """Cells of some texts: core (64-bit hash), whole (two halves of a keyed 128-bit hash of the bytes), text, first (string's start in its text), lo, hi (places in the stretch)."""
    held, size, first = [], 0, 0
    for k, t in enumerate(texts):
        at = 0
        while len(t) - at >= LENGTH:  # a long text in slices that share LENGTH - 1 bytes
            held.append((k, at, t[at : at + SLICE + LENGTH - 1]))
            size += len(held[-1][2])
            at += SLICE
            if size >= SLICE:
                yield _cells(held, key)
                held, size = [], 0
    if held:
        yield _cells(held, key)


def _cells(held: list[tuple[int, int, bytes]], key: bytes):
    sizes = np.array([len(t) for _, _, t in held], np.int64)
    ends = np.cumsum(sizes)
    raw = b"".join(t for _, _, t in held)
    b = np.frombuffer(raw, np.uint8)
    n = len(b)
    up, down = _power(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(_table()[b] * up[:n], out=total[1:])

    def hashes(x, y):
        return (total[y] - total[x]) * down[x]

    at = np.arange(n - GRAM + 1, dtype=np.int64)
    gram = _mix((total[GRAM:] - total[: n - GRAM + 1]) * down[: n - GRAM + 1])
    packed = (gram & ~_U(0xFFFFFF)) | at.astype(_U)
    anchor = (least(packed, LENGTH - GRAM + 1) & _U(0xFFFFFF)).astype(np.int64)
    s = np.arange(len(anchor), dtype=np.int64)
    inside = np.repeat(ends, np.minimum(sizes, np.maximum(0, len(anchor) - (ends - sizes)))) >= s + LENGTH
    s = s[inside]
    anchor = anchor[inside]
    stretch = (anchor - s) // WIDTH
    new = np.ones(len(s), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (stretch[1:] != stretch[:-1]) | (s[1:] != s[:-1] + 1)
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(s)) - 1
    a, c, lo, hi = anchor[i], stretch[i], s[i], s[j]
    left = a - WIDTH * c - (WIDTH - 1)
    core = _mix(hashes(left + WIDTH - 1, left + LENGTH) + c.astype(_U) * _U(0xA24BAED4963EE407))
    digests = b"".join(hashlib.blake2b(raw[x:y], digest_size=16, key=key).digest() for x, y in zip(lo.tolist(), (hi + LENGTH).tolist()))
    whole = np.frombuffer(digests, "<u8").reshape(-1, 2).copy()
    whole[:, 0] ^= ((lo - left) * WIDTH + hi - left).astype(_U)  # equal bytes at other places in the stretch are another cell
    which = np.searchsorted(ends, lo, "right")
    first = lo - (ends - sizes)[which] + np.array([x for _, x, _ in held], np.int64)[which]
    return core, whole, np.array([k for k, _, _ in held], np.int64)[which], first, (lo - left).astype(np.uint8), (hi - left).astype(np.uint8)


class Columns:
    """A file of arrays of one length, read and written in sequence."""

    def __init__(self, kind: str, n: int):
        self.file, self.kind, self.n = tempfile.TemporaryFile(), np.dtype(kind), n

    def put(self, x: np.ndarray) -> None:
        self.file.write(np.ascontiguousarray(x, self.kind).tobytes())

    def back(self) -> None:
        self.file.seek(0)

    def get(self) -> np.ndarray:
        return np.frombuffer(self.file.read(self.kind.itemsize * self.n), self.kind)

    def close(self) -> None:
        self.file.close()


#: The symbol of a column that a document does not reach; equal to none, itself included.
NONE = 256


def construct(docs: list[tuple[int, bytes]], columns: int = COLUMNS, length: int = LENGTH, width: int = WIDTH) -> np.ndarray:
    """For aligned documents (columns missing at the left, bytes): whether the string at each of the first columns is repeated.

    Rounds go from the last column to the first. A round inserts each document's symbol before its suffix: sorted
    stably by that symbol, the old order gives the new one, in which the symbols before are the transform's next part.
    Neighbours with one symbol share one more than the least prefix between their old places.
    """
    n = len(docs)
    text = np.full((columns, n), NONE, np.uint16)
    for k, (left, b) in enumerate(docs):
        text[left : left + len(b), k] = np.frombuffer(b, np.uint8)
    source = Columns("<u2", n)
    for x in range(columns - 1, -1, -1):
        source.put(text[x])
    del text
    source.back()
    order, shared = Columns("<u4", n), Columns("<u2", n)
    order.put(np.arange(n))
    shared.put(np.zeros(n))
    out = np.zeros((n, width), bool)
    for x in range(columns - 1, -1, -1):
        order.back()
        shared.back()
        old, common_old = order.get(), shared.get().astype(np.int64)
        symbols = source.get()[old]
        step = np.argsort(symbols, kind="stable")
        new, s = old[step], symbols[step]
        same = np.zeros(n, bool)
        same[1:] = (s[1:] == s[:-1]) & (s[1:] != NONE)
        prefix = np.zeros(n, np.int64)
        at = np.flatnonzero(same)
        if len(at):
            prefix[at] = 1 + _range_min(common_old, step[at - 1] + 1, step[at] + 1)
        if x < width:
            far = prefix >= length
            hit = far.copy()
            hit[:-1] |= far[1:]
            out[new[hit], x] = True
        order.back()
        shared.back()
        order.put(new)
        shared.put(np.minimum(prefix, 65535))
    for f in (source, order, shared):
        f.close()
    return out


def _range_min(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of v[a:b], none empty: neighbours at first, then stretches that double."""
    out = v[a]
    size = b - a
    left, level, k = np.flatnonzero(size > 1), v, 0
    while len(left):
        # level[i] is the least of v[i : i + 2**k]
        done = left[size[left] < 2 << k]
        out[done] = np.minimum(level[a[done]], level[b[done] - (1 << k)])
        left = left[size[left] >= 2 << k]
        if len(left):
            level = np.minimum(level[: -(1 << k)], level[1 << k :])
            k += 1
    return out


_ENTRY = np.dtype([("core", "<u8"), ("whole", "<u8"), ("more", "<u8"), ("did", "<i8"), ("first", "<u4"), ("lo", "u1"), ("hi", "u1")])
_PLACE = np.dtype([("did", "<i8"), ("first", "<u4"), ("lo", "u1"), ("hi", "u1")])
_CELL = np.dtype([("core", "<u8"), ("whole", "<u8"), ("more", "<u8"), ("again", "u1")])
_ASK = np.dtype([("did", "<i8"), ("group", "<u8"), ("first", "<u4"), ("lo", "u1"), ("hi", "u1"), ("how", "u1")])
_RANGE = np.dtype([("did", "<i8"), ("lo", "<u4"), ("hi", "<u4")])
#: What is asked for: a cell to compare with, one to decide on, one of a core with too many cells.
WITH, ON, MANY = 0, 1, 2
#: In a reply: the cell is repeated; its bytes are asked for, as HOW more.
REPEATED, HOW = 1, 2
CHUNKS = "chunk bigint, own boolean, bucket int, cells binary, sizes binary, cuts binary, places binary"


def _other(x: np.ndarray) -> np.ndarray:
    """Of sorted cells, which differ from the one before."""
    out = np.ones(len(x), bool)
    out[1:] = (x["core"][1:] != x["core"][:-1]) | (x["whole"][1:] != x["whole"][:-1]) | (x["more"][1:] != x["more"][:-1])
    return out


def _batch(rows, names, kinds):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)


def _chunks(docs: DataFrame, buckets: int, key: bytes) -> DataFrame:
    """Cells, a chunk of ENTRIES at a time: one row with where all stand (own), and for each bucket its different cells, once each.

    However often a cell occurs in a chunk it is sent once, so a cell that is all over the corpus is sent once a chunk.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int32(), *[pa.binary()] * 4]

    def run(batches):
        held: list[np.ndarray] = []
        size, chunk = 0, TaskContext.get().partitionId() << 32

        def flush():
            e = np.concatenate(held)
            where = (e["core"] % _U(buckets)).astype(np.int64)
            order = np.lexsort((e["more"], e["whole"], e["core"], where))
            e, where = e[order], where[order]
            new = _other(e)
            at = np.flatnonzero(new)
            sizes = np.diff(np.append(at, len(e)))
            cell, place = np.empty(len(at), _CELL), np.empty(len(e), _PLACE)
            cell["core"], cell["whole"], cell["more"], cell["again"] = e["core"][at], e["whole"][at], e["more"][at], sizes > 1
            for k in _PLACE.names:
                place[k] = e[k]
            cuts = np.searchsorted(where[at], np.arange(buckets + 1))
            rows = [(chunk, True, None, None, sizes.astype("<u4").tobytes(), cuts.astype("<u4").tobytes(), place.tobytes())]
            rows += [(chunk, False, k, cell[x:y].tobytes(), None, None, None) for k, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x]
            return _batch(rows, names, kinds)

        for b in batches:
            dids = np.array(b.column(0).to_pylist(), np.int64)
            for core, whole, which, first, lo, hi in cells([t or b"" for t in b.column(1).to_pylist()], key):
                e = np.empty(len(core), _ENTRY)
                e["core"], e["whole"], e["more"], e["did"], e["first"], e["lo"], e["hi"] = core, whole[:, 0], whole[:, 1], dids[which], first, lo, hi
                held.append(e)
                size += len(e)
                if size >= ENTRIES:
                    yield flush()
                    held, size, chunk = [], 0, chunk + 1
        if size:
            yield flush()

    return docs.select("did", "text").mapInArrow(run, CHUNKS)


def _replies(chunks: DataFrame) -> DataFrame:
    """For each bucket of a chunk what becomes of its cells: a byte each, and the cores of those that are asked for."""
    import pyarrow as pa

    names, kinds = ["chunk", "bucket", "status", "cores"], [pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def solve(bucket, rows):
        parts = [np.frombuffer(raw, _CELL) for _, raw in rows]
        c = np.concatenate(parts)
        order = np.lexsort((c["more"], c["whole"], c["core"]))  # stable: of equal cells the first chunk's comes first
        c = c[order]
        new = np.ones(len(c), bool)
        new[1:] = c["core"][1:] != c["core"][:-1]
        one = _other(c)
        kind, group = np.cumsum(one) - 1, np.cumsum(new) - 1
        single = np.bincount(kind, 1 + c["again"].astype(np.int64)) == 1
        first = np.flatnonzero(one)
        kinds_of, open_of = np.bincount(group[first]), np.bincount(group[first], single)
        # One cell of each kind is asked for, where a core has two kinds or more and some are not yet decided.
        wanted = ((kinds_of > 1) & (open_of > 0))[group[first]]
        how = np.where(kinds_of[group[first]] > MEMBERS, MANY, np.where(single, ON, WITH))
        status = np.where(single[kind], 0, REPEATED).astype("u1")
        status[first[wanted]] += (HOW * (1 + how[wanted])).astype("u1")
        back, core = np.empty(len(c), "u1"), np.empty(len(c), "<u8")
        back[order], core[order] = status, c["core"]
        out, at = [], 0
        for (chunk, _), own in zip(rows, parts):
            s = back[at : at + len(own)]
            if s.any():
                out.append((chunk, bucket, s.tobytes(), core[at : at + len(own)][s >= HOW].tobytes()))
            at += len(own)
        return _batch(out, names, kinds)

    def run(batches):
        at, rows = None, []
        for b in batches:
            for bucket, *row in zip(*(b.column(i).to_pylist() for i in range(3))):
                if bucket != at:
                    if rows:
                        yield solve(at, rows)
                    at, rows = bucket, []
                rows.append(row)
        if rows:
            yield solve(at, rows)

    sent = chunks.filter("not own").select("bucket", "chunk", "cells").repartition("bucket").sortWithinPartitions("bucket", "chunk")
    return sent.mapInArrow(run, "chunk bigint, bucket int, status binary, cores binary")


def _dealt(x: np.ndarray, parts: int, kind: int):
    """Rows (part, kind, raw) of an array with did."""
    where = x["did"] % parts
    order = np.argsort(where, kind="stable")
    x, cuts = x[order], np.searchsorted(where[order], np.arange(parts + 1)).tolist()
    return [(k, kind, x[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]


def _decided(chunks: DataFrame, replies: DataFrame, parts: int) -> DataFrame:
    """Rows (part, kind, raw): ranges of repeated strings (kind 0) and cells whose bytes are asked for (kind 1)."""
    import pyarrow as pa

    names, kinds = ["part", "kind", "raw"], [pa.int32(), pa.int32(), pa.binary()]

    def solve(replied, sizes, cuts, places):
        sizes, cuts, place = np.frombuffer(sizes, "<u4").astype(np.int64), np.frombuffer(cuts, "<u4"), np.frombuffer(places, _PLACE)
        status, core = np.zeros(len(sizes), "u1"), np.zeros(len(sizes), "<u8")
        for bucket, s, cores in replied:
            own = slice(int(cuts[bucket]), int(cuts[bucket + 1]))
            status[own] = np.frombuffer(s, "u1")
            core[own][status[own] >= HOW] = np.frombuffer(cores, "<u8")
        own = place[np.repeat(status & REPEATED > 0, sizes)]
        r = np.empty(len(own), _RANGE)
        r["did"], r["lo"] = own["did"], own["first"]
        r["hi"] = own["first"] + (own["hi"].astype(np.int64) - own["lo"])
        asked = np.flatnonzero(status >= HOW)
        first = place[(np.cumsum(sizes) - sizes)[asked]]
        a = np.empty(len(asked), _ASK)
        for k in _PLACE.names:
            a[k] = first[k]
        a["group"], a["how"] = core[asked], status[asked] // HOW - 1
        return _batch(_dealt(r, parts, 0) + _dealt(a, parts, 1), names, kinds)

    def run(batches):
        replied = []
        for b in batches:
            for _, bucket, status, cores, *own in zip(*(b.column(i).to_pylist() for i in range(7))):
                if bucket is not None:
                    replied.append((bucket, status, cores))
                    continue
                yield solve(replied, *own)
                replied = []

    none = [F.lit(None).cast("binary").alias(c) for c in ("sizes", "cuts", "places")]
    own = chunks.filter("own").select("chunk", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("status"), F.lit(None).cast("binary").alias("cores"), "sizes", "cuts", "places")
    rows = replies.select("chunk", "bucket", "status", "cores", *none).union(own)
    return rows.repartition("chunk").sortWithinPartitions("chunk", F.col("bucket").asc_nulls_last()).mapInArrow(run, "part int, kind int, raw binary")


PIECES = "grp bigint, did bigint, first bigint, lo int, hi int, how int, gap int, raw binary, h1 bigint, h2 bigint"


def _with_docs(rows: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """Rows of parts and their documents, sorted so that a part's rows come before its documents."""
    own = docs.select(F.pmod("did", F.lit(parts)).cast("int").alias("part"), F.lit(9).alias("kind"), F.lit(None).cast("binary").alias("raw"), "did", "doc_id", "text")
    rows = rows.select("part", "kind", "raw", F.lit(None).cast("bigint").alias("did"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("text"))
    return rows.union(own).repartition("part").sortWithinPartitions("part", "kind")


def _gather(batches, kind: np.dtype):
    """(did, doc_id, text, rows of did) of each document of a partition that _with_docs has made."""
    at, held, x = None, [], np.zeros(0, kind)
    for b in batches:
        for part, _, raw, did, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(6))):
            if part != at:
                at, held, x = part, [], np.zeros(0, kind)
            if raw is not None:
                held.append(raw)
                continue
            if held:
                x = np.frombuffer(b"".join(held), kind)
                x, held = x[np.argsort(x["did"], kind="stable")], []
            i, j = np.searchsorted(x["did"], did), np.searchsorted(x["did"], did, "right")
            yield did, doc_id, text, x[i:j]


def _pieces(asked: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """The bytes of cells asked for; of a core with too many cells the hashes of its strings."""
    import pyarrow as pa

    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches):
        rows, done = [], set()
        for did, _, text, asks in _gather(batches, _ASK):
            if not len(asks) or did in done:
                continue
            done.add(did)
            for a in asks:
                first, lo, hi, how = int(a["first"]), int(a["lo"]), int(a["hi"]), int(a["how"])
                group = int(a["group"].astype(np.int64))
                if how == MANY:
                    for s in range(first, first + hi - lo + 1):
                        d = hashlib.blake2b(text[s : s + LENGTH], digest_size=16).digest()
                        rows.append((group, did, s, None, None, how, None, None, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
                else:
                    left = first - lo
                    rows.append((group, did, first, lo, hi, how, max(0, -left), text[max(0, left) : left + COLUMNS], None, None))
                if len(rows) >= 2048:
                    yield _batch(rows, names, kinds)
                    rows = []
        if rows:
            yield _batch(rows, names, kinds)

    return _with_docs(asked, docs, parts).mapInArrow(run, PIECES)


def _constructed(pieces: DataFrame, parts: int) -> DataFrame:
    """Ranges of the strings that the construction finds repeated."""
    import pyarrow as pa

    def run(batches):
        held, group, opened = [], None, []

        def solve():
            # Cells of different cores may be one place of one text; it goes in once, as it is no repeat of itself.
            places: dict[tuple[int, int], int] = {}
            at = [places.setdefault((did, first - lo), len(places)) for did, first, lo, *_ in held]
            pieces = {k: (gap, raw) for k, (*_, gap, raw) in zip(at, held)}
            out = construct([pieces[k] for k in range(len(places))])
            found = []
            for row, (did, first, lo, hi, how, _, _) in zip(out[at], held):
                if how == ON:
                    found += [(did, first + x - lo, first + x - lo) for x in np.flatnonzero(row[lo : hi + 1]).tolist() for x in (x + lo,)]
            return _batch(_dealt(np.array(found, _RANGE), parts, 0), ["part", "kind", "raw"], [pa.int32(), pa.int32(), pa.binary()])

        for b in batches:
            for g, *row in zip(*(b.column(i).to_pylist() for i in range(8))):
                if g != group:
                    if len(held) + len(opened) > MEMBERS and held:
                        yield solve()
                        held = []
                    held, opened, group = held + opened, [], g
                opened.append(row)
        if len(held) + len(opened) > MEMBERS and held:
            yield solve()
            held = []
        held = held + opened
        if held:
            yield solve()

    own = pieces.filter(f"how <> {MANY}").select("grp", "did", "first", "lo", "hi", "how", "gap", "raw")
    return own.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "part int, kind int, raw binary")


def _counted(pieces: DataFrame, parts: int) -> DataFrame:
    """Ranges of the strings of large cores that occur twice: counts are combined before they are dealt."""
    import pyarrow as pa

    rows = pieces.filter(f"how = {MANY}").select("h1", "h2", "did", "first")
    twice = rows.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")

    def run(batches):
        for b in batches:
            r = np.empty(b.num_rows, _RANGE)
            r["did"], r["lo"], r["hi"] = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(1).to_numpy()
            yield _batch(_dealt(r, parts, 0), ["part", "kind", "raw"], [pa.int32(), pa.int32(), pa.binary()])

    return rows.join(twice, ["h1", "h2"]).select("did", "first").mapInArrow(run, "part int, kind int, raw binary")


def ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """All ranges of starts of repeated strings, in rows by part; the documents with did; and the number of parts.

    did is a hash of doc_id and text. Rows equal in both share it, and are repeats of each other as a whole.
    """
    spark = docs.sparkSession
    buckets = parts = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = docs.select(F.xxhash64("doc_id", "text").alias("did"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    chunks = common.keep(_chunks(own, buckets, secrets.token_bytes(16)), "cells", by="own")
    replies = common.keep(_replies(chunks), "replies")
    common.drop(chunks, "own=false")
    decided = common.keep(_decided(chunks, replies, parts), "decided")
    common.drop(chunks)
    common.drop(replies)
    found = decided.filter("kind = 0")
    asked = decided.filter("kind = 1")
    if not common.is_empty(asked):
        pieces = common.keep(_pieces(asked, own, parts), "pieces")
        found = found.union(common.keep(_constructed(pieces, parts), "constructed"))
        if not common.is_empty(pieces.filter(f"how = {MANY}")):
            found = found.union(common.keep(_counted(pieces, parts), "counted"))
        common.drop(pieces)
    return found, own, parts


def _covered(n: int, own: np.ndarray) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, own["lo"].astype(np.int64), 1)
    np.add.at(change, own["hi"].astype(np.int64) + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def strip(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """A row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    Bytes are those of the text in UTF-8; a null text is empty. Texts of fewer than LENGTH bytes lose nothing. Equal
    rows are repeats of each other. Only doc_id and text are read. An empty table gives no rows.
    """
    import pyarrow as pa

    found, own, parts = ranges(docs)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text

    def run(batches):
        rows = []
        for _, doc_id, text, at in _gather(batches, _RANGE):
            removed = spans = 0
            kept = text
            if len(at):
                gone = _covered(len(text), at)
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((doc_id, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
            if len(rows) >= 256:
                yield _batch(rows, names, kinds)
                rows = []
        if rows:
            yield _batch(rows, names, kinds)

    extra = ", kept binary" if with_text else ""
    return _with_docs(found, own, parts).mapInArrow(run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string{extra}")
