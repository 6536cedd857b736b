"""Operator 4, token files coded by a static range asymmetric numeral system.

A segment holds whole documents. Its frequency table is shared by its blocks; each block is coded on its own, with
its lanes interleaved, and has an entry in the segment's list of checkpoints: its first token, its place and its
checksum. So blocks are decoded in parallel or alone. Segments are the rows of a table, which Spark's writers commit.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

MAGIC = b"RANS"
HEAD = struct.Struct("<4sHBBIIIIQ")  # magic, version, bits, 0, lanes, documents, symbols, blocks, tokens
POINT = np.dtype([("first", "<u8"), ("place", "<u8"), ("tokens", "<u4"), ("words", "<u4"), ("crc", "<u4")])
BITS, LANES, STEPS = 18, 2048, 128
LOW = np.uint64(1 << 31)
#: Tokens of a segment, but for one document that is longer.
SEGMENT = 1 << 20
#: Segments whose starts (24 bytes each) are broadcast; those of more are joined.
SENT = 1 << 18


class Damaged(ValueError):
    """A checksum does not hold."""


def table(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, each at least 1, from counts that are at least 1."""
    size, total = 1 << bits, int(counts.sum())
    if len(counts) > size:
        raise ValueError("more symbols than the table has places")
    f = np.maximum(1, counts.astype(np.float64) * size / total).astype(np.int64)
    over = int(f.sum()) - size
    order = np.argsort(-f, kind="stable")
    if over < 0:
        f[order[0]] -= over
    while over > 0:
        big = order[f[order] > 1]
        take = np.minimum(f[big] - 1, np.maximum(1, f[big] * over // size))
        take = np.where(np.cumsum(take) <= over, take, np.maximum(0, over - (np.cumsum(take) - take)))
        f[big] -= take
        over -= int(take.sum())
    return f.astype(np.uint64)


def _encode(symbols: np.ndarray, f: np.ndarray, c: np.ndarray, bits: int, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    steps = -(-len(symbols) // lanes)
    grid = np.zeros(steps * lanes, symbols.dtype)
    grid[: len(symbols)] = symbols
    grid = grid.reshape(steps, lanes)
    x = np.full(lanes, LOW, np.uint64)
    shift, room, half = np.uint64(bits), np.uint64(63 - bits), np.uint64(32)
    out = []
    for t in range(steps - 1, -1, -1):
        own = f[grid[t]]
        full = x >= own << room
        out.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        x = np.where(full, x >> half, x)
        q = x // own
        x = (q << shift) + (x - q * own) + c[grid[t]]
    return x, np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")


def _decode(n: int, x: np.ndarray, words: np.ndarray, f: np.ndarray, c: np.ndarray, look: np.ndarray, bits: int) -> np.ndarray:
    lanes, at = len(x), 0
    steps = -(-n // lanes)
    out = np.empty((steps, lanes), look.dtype)
    shift, mask, half = np.uint64(bits), np.uint64((1 << bits) - 1), np.uint64(32)
    words = words.astype(np.uint64)
    for t in range(steps):
        slot = x & mask
        s = look[slot]
        out[t] = s
        x = f[s] * (x >> shift) + slot - c[s]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << half) | words[at : at + len(low)]
            at += len(low)
    return out.reshape(-1)[:n]


def pack_segment(doc_ids: list[int | None], codes: list[bytes], bits: int = BITS, lanes: int = LANES, steps: int = STEPS) -> bytes:
    """One segment from documents' ids, each as little-endian unsigned 32-bit integers."""
    ids = np.frombuffer(b"".join(codes), "<u4")
    if len(ids) and int(ids.max()) < 1 << 22:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts).astype("<u4")
        rank = np.zeros(len(counts), np.int32)
        rank[symbols] = np.arange(len(symbols), dtype=np.int32)
        index, counts = rank[ids], counts[symbols]
    else:
        symbols, index, counts = np.unique(ids, return_inverse=True, return_counts=True)
    f = table(counts, bits) if len(ids) else np.zeros(0, np.uint64)
    c = np.cumsum(f) - f
    lanes = max(1, min(lanes, -(-len(ids) // 16)))
    size = lanes * steps
    points, blocks, place = [], [], 0
    for at in range(0, len(ids), size):
        x, words = _encode(index[at : at + size], f, c, bits, lanes)
        body = x.astype("<u8").tobytes() + words.tobytes()
        points.append((at, place, len(index[at : at + size]), len(words), zlib.crc32(body)))
        blocks.append(body)
        place += len(body)
    side = b"".join(
        [
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.array([len(x) // 4 for x in codes], "<u4").tobytes(),
            np.diff(symbols, prepend=symbols[:1] * 0).astype("<u4").tobytes(),
            f.astype("<u4").tobytes(),
            np.array(points, POINT).tobytes(),
        ]
    )
    side = zlib.compress(side, 1)
    head = HEAD.pack(MAGIC, 1, bits, 0, lanes, len(doc_ids), len(symbols), len(blocks), len(ids))
    return b"".join([head, struct.pack("<II", len(side), zlib.crc32(head + side)), side, *blocks])


class Segment:
    """Reads a segment; blocks are decoded when asked for."""

    def __init__(self, raw: bytes):
        magic, version, self.bits, _, self.lanes, docs, symbols, blocks, self.tokens = HEAD.unpack_from(raw)
        if magic != MAGIC or version != 1:
            raise Damaged("not a segment")
        size, crc = struct.unpack_from("<II", raw, HEAD.size)
        at = HEAD.size + 8
        side = raw[at : at + size]
        if zlib.crc32(raw[: HEAD.size] + side) != crc:
            raise Damaged("header")
        side, self.raw, self.body = zlib.decompress(side), memoryview(raw), at + size
        at = 0

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(side, kind, n, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]
        self.lengths = take("<u4", docs).astype(np.int64)
        self.symbols = np.cumsum(take("<u4", symbols), dtype=np.int64)
        self.f = take("<u4", symbols).astype(np.uint64)
        self.points = take(POINT, blocks)
        self.c = np.cumsum(self.f) - self.f
        self.look = np.repeat(np.arange(symbols, dtype=np.int32), self.f.astype(np.int64))

    def block(self, k: int) -> np.ndarray:
        p = self.points[k]
        at = self.body + int(p["place"])
        body = self.raw[at : at + 8 * self.lanes + 4 * int(p["words"])]
        if zlib.crc32(body) != int(p["crc"]):
            raise Damaged(f"block {k}")
        x = np.frombuffer(body, "<u8", self.lanes).copy()
        words = np.frombuffer(body, "<u4", int(p["words"]), 8 * self.lanes)
        return self.symbols[_decode(int(p["tokens"]), x, words, self.f, self.c, self.look, self.bits)].astype("<u4")

    def ids(self) -> np.ndarray:
        return np.concatenate([self.block(k) for k in range(len(self.points))]) if len(self.points) else np.zeros(0, "<u4")

    def document(self, i: int) -> np.ndarray:
        """Ids of one document, from the blocks that it lies in."""
        start = int(self.lengths[:i].sum())
        stop = start + int(self.lengths[i])
        ks = [k for k, p in enumerate(self.points) if p["first"] < stop and p["first"] + p["tokens"] > start]
        if not ks:
            return np.zeros(0, "<u4")
        first = int(self.points[ks[0]]["first"])
        return np.concatenate([self.block(k) for k in ks])[start - first : stop - first]


def write(docs: DataFrame, path: str, out: str, end: int = 2, segment: int = SEGMENT) -> None:
    """Write the token file of a table: rows (part, nth, n_docs, n_tokens, payload), documents in ascending doc_id order.

    doc_id is long, null first; rows with equal doc_id stand together, in an order by their texts alone. A null text is empty and has the end id alone.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    spark = docs.sparkSession
    spec = tokens.spec(spark, path)
    tail = int(end).to_bytes(4, "little")

    def encode(batches):
        run = tokens.encoder(spec.value)
        part, nth, ids, codes, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush():
            nonlocal nth, ids, codes, size
            made = pack_segment(ids, codes)
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "nth": pa.array([nth], pa.int32()), "n_docs": pa.array([len(ids)], pa.int64()), "n_tokens": pa.array([size // 4], pa.int64()), "payload": pa.array([made], pa.binary())})
            nth, ids, codes, size = nth + 1, [], [], 0
            return row

        for b in batches:
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                code = run(text or "") + tail
                if ids and size + len(code) > 4 * segment:
                    yield flush()
                ids.append(d)
                codes.append(code)
                size += len(code)
        if ids:
            yield flush()

    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows = placed.mapInArrow(encode, "part int, nth int, n_docs bigint, n_tokens bigint, payload binary")
    with common.tuned(spark):
        rows.write.option("compression", "none").parquet(out)


def read(spark, out: str, with_ids: bool = False) -> DataFrame:
    """Read a token file back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for."""
    import pyarrow as pa

    segments = spark.read.schema("part int, nth int, n_docs bigint, n_tokens bigint, payload binary").parquet(out)
    totals = sorted(tuple(r) for r in common.collect(segments.groupBy("part").agg(F.sum("n_tokens"), F.count("*"))))  # one a writing task
    base, at = {}, 0
    for part, n, _ in totals:
        base[part], at = at, at + n
    before = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("part", "nth", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))

    def decode(batches):
        for b in batches:
            cols = [[] for _ in range(4)]
            texts = []
            for part, before, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                s = Segment(raw)
                raw_ids = s.ids().tobytes()
                at = 0
                for d, n in zip(s.doc_ids, s.lengths.tolist()):
                    own = raw_ids[4 * at : 4 * (at + n)]
                    for c, v in zip(cols, (d, base[part] + before + at, n, zlib.crc32(own))):
                        c.append(v)
                    if with_ids:
                        texts.append(np.frombuffer(own, "<u4").astype(np.int32))
                    at += n
            arrays = [pa.array(c, pa.int64()) for c in cols]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(texts, pa.list_(pa.int32()))] if with_ids else []), ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    extra = ", ids array<int>" if with_ids else ""
    few = sum(n for *_, n in totals) <= SENT
    rows = segments.select("part", "nth", "payload").join(F.broadcast(starts) if few else starts, ["part", "nth"]).select("part", "before", "payload")
    return rows.mapInArrow(decode, f"doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint{extra}")


def digest(docs: DataFrame) -> DataFrame:
    import uuid

    import public_tokenizers

    spark = docs.sparkSession
    out = f"{common.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    common.own(spark, out)
    write(docs, public_tokenizers.path("word_bpe_49k.json"), out)
    return read(spark, out)
