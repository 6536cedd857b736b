"""Operator 6, language-model scoring by online logistic context mixing.

A word is coded bit by bit, bytes then an end sign; the empty word ends a text. Several predictors, each a table of bit
counts under a hashed context inside the word, give their odds; a gate, the longest context that was seen and how
often, picks the weights that mix them in the logistic domain; a last table, by gate and odds, refines the mixture. The
weights learn online, a batch of words after another; once they are settled, that table is filled from all training
words. Each word is predicted as if one occurrence of it had not been counted. For scoring all is frozen, so a text's
score does not hang on the order of texts, and the spelling of a word that recurs is scored once. Words of a batch that
begin alike are predicted once as far as they do, with the sum of their weights.

Across words, a predictor under the word before is mixed in: how often each pair of words occurs in all training text,
by a hash of both. How far it is trusted against the spelling hangs on how often the word before was seen, and is what
makes training text likeliest, each occurrence as if it had not been counted. Pairs are scored once a chunk.

Counts are of all training words: words are counted in chunks of documents, dealt by their hash, summed, and what is
known of each word goes back to the chunks that hold it. Words are dealt by their first OWN bytes, so counts under all
bytes before are exact where the words lie and need no table; below OWN bytes they are those of the table of five. The
other tables are sized by the contexts that the corpus has, at most half full, up to 2^MOST slots each, which bounds what
is broadcast; beyond that contexts of five bytes share slots, and what goes on growing are the exact counts: of words, of
their beginnings, of pairs of words.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Contexts and the least bits of their tables: place in the word; the last one, two, three and five bytes.
TABLES = (("place", 16), ("one", 16), ("two", 18), ("three", 20), ("five", 20))
BITS = tuple(b for _, b in TABLES)
SLOTS = sum(1 << b for b in BITS)
#: Predictors: the tables and all bytes before. Words of the same first OWN bytes are in one task and batch.
PREDICTORS, OWN = len(TABLES) + 1, 5
#: Contexts that are looked at to size the tables, one of so many; slots for each key, at least; bits of a table at most.
LOOKED, ROOM, MOST = 64, 2, 24
#: Slots of a piece of the tables as it is summed.
PIECE = 1 << 16
#: Words of a chunk of documents; bytes of words that are predicted at once when counting and when learning.
CHUNK, COUNTED, LEARNED = 1 << 21, 1 << 18, 1 << 16
#: Words of a task that counts or learns.
TASK_WORDS = 200_000
DELTA, RATE = 0.2, 0.15
#: Tables of up to so many bits are looked up as a whole.
READY = 20
#: Gates of a table, by the logarithm of how often its context was seen; odds told apart by the last table.
SEEN = 10
#: Learning weighs a word by this power of its count.
POWER = 0.75
#: Gates of the predictor under the word before, by the logarithm of that word's count; odds against the spelling, in
#: quarters of a nat from the least on, the first for none.
TRUST, ODDS, LEAST = 80, 200, -100
GATES, LEVELS = (PREDICTORS + 1) * SEEN, 33

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_U = np.uint64
#: Counts are looked up as two numbers of 16 bits, larger ones in proportion; their logarithms, and gates by their sum (-1 for none).
_FULL = (1 << 16) - 1
_LOG = np.log(np.arange(_FULL + 1) + DELTA).astype(np.float32)
_LEVEL = np.concatenate(([-1], np.minimum(SEEN - 1, np.log2(np.arange(1, 2 * _FULL + 1) + 0.5)))).astype(np.int8)


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(_FOLD).split()


def _contexts(flat: np.ndarray, pos: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """A 64-bit context of some bytes for each table. pos: places in their words; at: places in flat."""
    back = []
    for k in range(1, 6):
        b = flat[np.maximum(at - k, 0)].astype(_U) + _U(1)
        b[pos < k] = 0
        back.append(b)
    two = back[0] | back[1] << _U(9)
    three = two | back[2] << _U(18)
    five = three | back[3] << _U(27) | back[4] << _U(36)
    return [np.minimum(pos, 15).astype(_U), back[0], two, three, five]


def _before(flat: np.ndarray, pos: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit number for all bytes before each in its word: a sum of one for each byte and place, without the structure
    of powers of a base, under which Thue-Morse words are alike. start: where the byte's word begins."""
    own = (pos.astype(_U) << _U(8) | flat) * _U(0x9E3779B97F4A7C15) + _U(0xD6E8FEB86659FD93)
    own = (own ^ own >> _U(32)) * _U(0x9FB21C651E98DF25)
    own ^= own >> _U(29)
    own *= _U(0xA24BAED4963EE407)
    upto = np.cumsum(own) - own
    return upto - upto[start]


def _hashed(context: np.ndarray, k: int) -> np.ndarray:
    b = (context + _U(1)) * _U(0xD6E8FEB86659FD93 + 2 * k)
    return b ^ (b >> _U(29))


def offsets(bits=BITS) -> list[int]:
    return np.cumsum([0, *(1 << b for b in bits)]).tolist()


def _bytes(parts: list[bytes]):
    """Bytes of the words with their ends, the word of each, its place there, and a hash of all before."""
    joined = b"\n".join(parts) + b"\n"
    flat = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    word = np.repeat(np.arange(len(parts)), lengths)
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    pos = np.arange(len(flat)) - start
    return flat, word, pos, _hashed(_before(flat, pos, start), len(TABLES))


def _bases(flat, pos, at) -> list[np.ndarray]:
    """A hash of every context of some bytes, but of all before."""
    return [_hashed(c, k) for k, c in enumerate(_contexts(flat, pos, at))]


def _once(flat, base):
    """Of the bytes that share a beginning (all before, and the byte) one, and which of these each byte's is."""
    key = base + (flat + _U(1)) * _U(0xA24BAED4963EE407)
    order = np.argsort(key)
    new = np.diff(key[order], prepend=~key[order[:1]]) != 0
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _bits(flat, bases, bits):
    node = np.ones(len(flat), _U)
    for k in range(7, -1, -1):
        bit = flat >> np.uint8(k) & np.uint8(1)
        mark = node * _U(0xA24BAED4963EE407)
        slots = [((b + mark) * _U(0x9FB21C651E98DF25) >> _U(64 - size)).astype(np.int64) for b, size in zip(bases, bits)]
        yield slots, bit
        node = node << _U(1) | bit.astype(_U)


def steps(parts: list[bytes], bits=BITS):
    """For each bit of every byte of the words: slots (tables x bytes) and the bits; first the word of each byte, its place, the byte and a hash of all before."""
    flat, word, pos, base = _bytes(parts)
    return word, pos, flat, base, _bits(flat, _bases(flat, pos, np.arange(len(flat))), bits)


class Beginnings:
    """Of words with their ends, the different beginnings; a beginning is a byte and all before, and is coded alike in all words that have it.

    flat, pos, base: the byte, its place and a hash of all before. bits: for each bit, slots (tables x beginnings) and the bits.
    """

    def __init__(self, parts: list[bytes], bits=BITS):
        flat, self.word, pos, base = _bytes(parts)
        at, self.which = _once(flat, base)
        self.flat, self.pos, self.base = flat[at], pos[at], base[at]
        self.bits = _bits(self.flat, _bases(flat, self.pos, at), bits)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Of a number a word, the sum over the words of each beginning."""
        return np.bincount(self.which, x.astype(np.float64)[self.word], len(self.flat))


def looked_at(parts: list[bytes]) -> list[np.ndarray]:
    """Keys (context and node) of one in LOOKED contexts of each table."""
    flat, _, pos, base = _bytes(parts)
    at, _ = _once(flat, base)
    bases, flat = _bases(flat, pos[at], at), flat[at]
    out = []
    for b in bases:
        at = np.flatnonzero((b * _U(0x9FB21C651E98DF25) >> _U(40)) % _U(LOOKED) == 0)
        byte = flat[at].astype(_U)
        out.append(np.unique(np.concatenate([b[at] + (byte >> _U(8 - k) | _U(1 << k)) * _U(0xA24BAED4963EE407) for k in range(8)])))
    return out


def batches_of(parts: list[bytes], size: int):
    """Slices of a list of words of about ``size`` bytes."""
    a, held = 0, 0
    for b, w in enumerate(parts):
        held += len(w) + 1
        if held >= size:
            yield a, b + 1
            a, held = b + 1, 0
    if a < len(parts):
        yield a, len(parts)


def whole_batches(parts: list[bytes], size: int) -> list[np.ndarray]:
    """Places of words in batches of about ``size`` bytes or more; words of the same first OWN bytes are in one batch."""
    group = np.fromiter((zlib.crc32(w[:OWN]) for w in parts), np.int64, len(parts))
    order = np.argsort(group, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(group[order])) + 1, len(parts))
    held = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))[order] + 1)
    out, a, before = [], 0, 0
    for b in ends.tolist():
        if b > a and (held[b - 1] - before >= size or b == len(parts)):
            out.append(order[a:b])
            a, before = b, held[b - 1]
    return out


def count(parts: list[bytes], counts: np.ndarray, tables: np.ndarray, bits=BITS) -> None:
    """Add words, each as often as counted, to tables (slots x 2)."""
    flat, first = tables.reshape(-1), offsets(bits)
    for a, b in batches_of(parts, COUNTED):
        own = Beginnings(parts[a:b], bits)
        weight, seen = own.sums(counts[a:b]), list(own.bits)
        for k, size in enumerate(bits):
            at = np.concatenate([slots[k] * 2 + bit for slots, bit in seen])
            if size > 18:
                np.add.at(flat, at + 2 * first[k], np.tile(weight, 8).astype(flat.dtype))
            else:
                flat[2 * first[k] : 2 * first[k + 1]] += np.bincount(at, np.tile(weight, 8), 2 << size).astype(flat.dtype)


class Whole:
    """Counts under all bytes before, of the bytes that are OWN places in: exact, as all words that share them are here.

    Sorted once by what is before and the byte, bytes of the same leading bits under the same bytes are runs.
    """

    def __init__(self, base, flat, pos, weight):
        self.far = np.flatnonzero(pos >= OWN)
        order = np.argsort(base[self.far], kind="stable")
        byte, base = flat[self.far], base[self.far]
        order = order[np.argsort((np.cumsum(np.diff(base[order], prepend=base[order[:1]]) != 0) << 8) | byte[order], kind="stable")]
        self.byte, self.weight, self.order = byte[order], weight[self.far][order], order
        self.change = np.diff(base[order], prepend=base[order[:1]] + _U(1)) != 0

    def counts(self, k: int) -> np.ndarray:
        """Of the k-th bit from the least, a row for each of ``far``."""
        if not len(self.order):
            return np.zeros((0, 2))
        high = self.byte >> np.uint8(k) >> np.uint8(1)
        new = self.change.copy()
        new[1:] |= high[1:] != high[:-1]
        at = np.flatnonzero(new)
        bit = (self.byte >> np.uint8(k) & np.uint8(1)).astype(bool)
        one, both = np.add.reduceat(np.where(bit, self.weight, 0.0), at), np.add.reduceat(self.weight, at)
        out = np.empty((len(self.order), 2))
        out[self.order] = np.stack([both - one, one], axis=1)[np.cumsum(new) - 1]
        return out


def packed(tables: np.ndarray) -> np.ndarray:
    """Counts (slots x 2) as one number of 32 bits a slot; what is there stays there."""
    n = tables
    if tables.max(initial=0) > _FULL:
        n = tables * (_FULL / np.maximum(np.maximum(tables[:, 0], tables[:, 1]), _FULL))[:, None]
    n = np.maximum(np.rint(n), tables > 0).astype(np.uint32)
    return n[:, 0] | n[:, 1] << np.uint32(16)


def looked_up(n: np.ndarray, bit=None):
    """Odds of counts as packed() gives them, and their levels. bit: an occurrence of it is left out."""
    zero, one = n & np.uint32(_FULL), n >> np.uint32(16)
    if bit is not None:
        one -= np.minimum(one, bit)
        zero -= np.minimum(zero, bit ^ np.uint8(1))
    return _LOG[one] - _LOG[zero], _LEVEL[zero + one]


class Mixer:
    def __init__(self, tables: np.ndarray | None, weights: np.ndarray | None = None, refine: np.ndarray | None = None, bits=BITS):
        """tables: counts as packed() gives them. weights: a row a predictor, and one for a constant; a column a gate."""
        self.tables, self.bits, self.offsets = tables, bits, offsets(bits)
        self.weights = self.first_weights() if weights is None else weights
        self.refine = np.zeros((GATES * LEVELS, 2)) if refine is None else refine
        self.ready: dict = {}

    @staticmethod
    def first_weights() -> np.ndarray:
        """The longest context that was seen is trusted the more, the oftener it was; the next shorter one has the rest."""
        w = np.zeros((PREDICTORS + 1, GATES))
        for g in range(GATES):
            k, often = g // SEEN - 1, g % SEEN / (SEEN - 1)
            if k >= 0:
                w[k, g] = 0.5 + 0.5 * often
            if k >= 1:
                w[k - 1, g] = 0.5 - 0.5 * often
        return w

    def inputs(self, slots, own, far, bit=None):
        """Odds of the predictors (and a constant, x bytes) and the gates. own: counts under all bytes before, of ``far``. bit: an occurrence of it is left out."""
        odds = np.empty((PREDICTORS + 1, len(slots[0])), np.float32)
        gate = np.zeros(len(slots[0]), np.int64)
        for k in range(PREDICTORS):
            if k < len(slots) - 1 and self.bits[k] <= READY:  # counts of the last table are asked for below OWN bytes once more
                odds[k], level = self.of_small(k, slots[k], bit)
            else:
                if k < len(slots):
                    n = self.tables[slots[k] + self.offsets[k]]
                else:
                    n[far] = packed(own)
                odds[k], level = looked_up(n, bit)
            np.copyto(gate, level + np.int8(SEEN * (k + 1)), where=level >= 0)
        odds[-1] = 0.3
        return odds, gate

    def of_small(self, k, slots, bit):
        """looked_up() of slots of the k-th table, all of which are looked up once, with either bit left out."""
        own = self.ready.get((k, bit is None))
        if own is None:
            n = self.tables[self.offsets[k] : self.offsets[k + 1]]
            own = self.ready[k, bit is None] = looked_up(n) if bit is None else looked_up(np.repeat(n, 2), np.tile(np.array([0, 1], np.uint8), len(n)))
        at = slots if bit is None else 2 * slots + bit
        return own[0][at], own[1][at]

    def mix(self, odds, gate):
        z = np.zeros(len(gate), np.float32)
        for w, own in zip(self.weights.astype(np.float32), odds):
            z += w[gate] * own
        return np.clip(z, -12, 12)

    def learn(self, parts: list[bytes], counts: np.ndarray) -> float:
        """Learn from training words, online; returns the weight of what was learned from."""
        total, cuts = 0.0, whole_batches(parts, LEARNED)
        for nth, at in enumerate(cuts):
            own = Beginnings([parts[i] for i in at.tolist()], self.bits)
            whole = Whole(own.base, own.flat, own.pos, own.sums(counts[at]))
            weight = own.sums(counts[at] ** POWER)
            rate = RATE / (1 + nth / 8)
            for k, (slots, bit) in zip(range(7, -1, -1), own.bits):
                odds, gate = self.inputs(slots, whole.counts(k), whole.far, bit)
                z = self.mix(odds, gate)
                error = weight * (bit - 1 / (1 + np.exp(-z)))
                mass = np.bincount(gate, weight, GATES) + 1e-9
                for c in range(len(odds)):
                    self.weights[c] += rate * np.bincount(gate, error * odds[c], GATES) / mass
            total += float(weight.sum())
        return total

    def settle(self, parts: list[bytes], counts: np.ndarray) -> None:
        """Fill the last table from training words, all of them, with the weights as they are."""
        for at in whole_batches(parts, LEARNED):
            own = Beginnings([parts[i] for i in at.tolist()], self.bits)
            whole = Whole(own.base, own.flat, own.pos, own.sums(counts[at]))
            weight = own.sums(counts[at] ** POWER)
            for k, (slots, bit) in zip(range(7, -1, -1), own.bits):
                odds, gate = self.inputs(slots, whole.counts(k), whole.far, bit)
                cell = gate * LEVELS + self.level(self.mix(odds, gate))
                for v in (0, 1):
                    self.refine[:, v] += np.bincount(cell, weight * (bit == v), GATES * LEVELS)

    @staticmethod
    def level(z):
        return np.clip(np.rint(z * 2), -(LEVELS // 2), LEVELS // 2).astype(np.int64) + LEVELS // 2

    def score(self, parts: list[bytes], counts: np.ndarray | None = None) -> np.ndarray:
        """log10 of the probability of each word, its end included. counts: of training, over all words that share OWN first bytes with one of them."""
        out = np.zeros(len(parts))
        middle = (np.arange(GATES * LEVELS) % LEVELS - LEVELS // 2) / 2
        seen = self.refine.sum(axis=1)
        refined = np.log((self.refine[:, 1] + 8 / (1 + np.exp(-middle))) / (self.refine[:, 0] + 8 / (1 + np.exp(middle))))
        refined = np.clip(np.where(seen > 0, refined, middle), -12, 12)
        counts = np.zeros(len(parts)) if counts is None else counts
        for at in whole_batches(parts, LEARNED):
            own = Beginnings([parts[i] for i in at.tolist()], self.bits)
            whole = Whole(own.base, own.flat, own.pos, own.sums(counts[at]))
            lost = np.zeros(len(own.flat))
            for k, (slots, bit) in zip(range(7, -1, -1), own.bits):
                odds, gate = self.inputs(slots, whole.counts(k), whole.far)
                z = self.mix(odds, gate)
                z = (z + refined[gate * LEVELS + self.level(z)]) / 2
                lost += np.log1p(np.exp(np.where(bit == 1, -z, z)))
            out[at] = -np.bincount(own.word, lost[own.which], len(at)) / np.log(10)
        return out


#: Rows of a chunk: one of its documents (own), and one for each bucket with its words there.
CHUNKS = "chunk bigint, own boolean, bucket int, doc_ids array<bigint>, sizes binary, n_bytes binary, toks binary, hashes binary, rank binary, words binary, counts binary"
#: Rows of a bucket: its words (kind 0), and for each chunk where its words are among them (kind 1).
VOCABULARY = "bucket int, kind int, chunk bigint, n_train bigint, v_train bigint, n_words bigint, words binary, counts binary, places binary"


_pressed, _plain, _planes, _from_planes = common.pressed, common.plain, common.planes, common.from_planes


def _rows(rows: list[tuple], schema: str):
    """An Arrow batch of rows, or none of columns."""
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    names, own = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(list(zip(*rows)) or [[]] * len(own), own)], list(names))


def _chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents as numbers of their chunk's words with those words' hashes, and the chunk's words by bucket with training counts."""
    from pyspark import TaskContext

    class Local(dict):
        def __missing__(self, word):
            out = self[word] = len(self)
            return out

    def run(batches):
        import xxhash

        chunk, local, ids, sizes, n_bytes, toks = TaskContext.get().partitionId() << 32, Local(), [], [], [], []

        def flush():
            nonlocal chunk, local, ids, sizes, n_bytes, toks
            t = np.concatenate(toks) if toks else np.zeros(0, np.int64)
            n = np.array(sizes, np.int64)
            train = np.repeat(np.array([not is_held_out(d) for d in ids], bool), n)
            counts = np.bincount(t[train], minlength=len(local))
            own = list(local)
            where = np.fromiter((xxhash.xxh3_64_intdigest(w[:OWN]) % buckets for w in own), np.int64, len(own))
            order = np.argsort(where, kind="stable")
            rank = np.empty(len(own), np.int64)
            rank[order] = np.arange(len(own))
            cuts = np.searchsorted(where[order], np.arange(buckets + 1)).tolist()
            names_of = np.fromiter(map(xxhash.xxh3_64_intdigest, own), "<u8", len(own))
            rows = [(chunk, True, None, ids, _planes(n, "<u4"), _planes(np.array(n_bytes), "<u4"), _planes(t, "<u4"), names_of.tobytes(), _planes(rank, "<u4"), None, None)]
            for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                if y > x:
                    at = order[x:y]
                    rows.append((chunk, False, b, *[None] * 6, _pressed(b"\n".join([own[i] for i in at.tolist()])), _planes(counts[at], "<u4")))
            chunk, local, ids, sizes, n_bytes, toks = chunk + 1, Local(), [], [], [], []
            return _rows(rows, CHUNKS)

        held = 0
        for b in batches:
            texts = b.column(1).to_pylist()
            lists = [[*words(t), b""] for t in texts]
            size = sum(map(len, lists))
            toks.append(np.fromiter((i for x in lists for i in map(local.__getitem__, x)), np.int64, size).astype(np.int32))
            ids += b.column(0).to_pylist()
            sizes += map(len, lists)
            n_bytes += (len(t or b"") for t in texts)
            held += size
            if held >= CHUNK:
                yield flush()
                held = 0
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, CHUNKS)


def _vocabulary(chunks: DataFrame) -> DataFrame:
    """Of each bucket its words with their training counts over all chunks, and for each chunk where its words stand among them."""

    def solve(bucket, rows):
        known: dict = {}
        vidx = [np.fromiter((known.setdefault(w, len(known)) for w in _plain(parts).split(b"\n")), np.int64) for _, parts, _ in rows]
        total = np.zeros(len(known), np.int64)
        for v, (_, _, counts) in zip(vidx, rows):
            total[v] += _from_planes(counts, "<u4")
        yield _rows([(bucket, 0, None, int(total.sum()), int((total > 0).sum()), len(known), _pressed(b"\n".join(known)), _planes(total), None)], VOCABULARY)
        for at in range(0, len(rows), 256):
            yield _rows([(bucket, 1, chunk, *[None] * 5, _planes(v, "<u4")) for (chunk, _, _), v in zip(rows[at : at + 256], vidx[at : at + 256])], VOCABULARY)

    def run(batches):
        at, rows = None, []
        for b in batches:
            for bucket, *row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if bucket != at:
                    if rows:
                        yield from solve(at, rows)
                    at, rows = bucket, []
                rows.append(row)
        if rows:
            yield from solve(at, rows)

    own = chunks.filter("not own").select("bucket", "chunk", "words", "counts")
    return own.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(run, VOCABULARY)


def follows(sizes: np.ndarray, toks: np.ndarray):
    """Pairs of a word and the one before, which is the end at the start of a text: (before, word) of each distinct pair, and the pair of each token."""
    prev, ends = np.empty(len(toks), np.int64), np.cumsum(sizes)
    prev[1:], prev[ends - sizes] = toks[:-1], toks[ends - 1]
    size, bits = int(toks.max()) + 1, len(toks).bit_length()
    pairs = prev * size + toks
    if size * size >> 63 - bits:
        pairs, which = np.unique(pairs, return_inverse=True)
    else:  # pairs and their places in one number, as numbers alone are sorted ten times faster
        both = np.sort(pairs << bits | np.arange(len(pairs)))
        pairs = both >> bits
        new = np.diff(pairs, prepend=-1) != 0
        which = np.empty(len(pairs), np.int64)
        which[both & (1 << bits) - 1] = np.cumsum(new) - 1
        pairs = pairs[new]
    return pairs // size, pairs % size, which


def _named(before: np.ndarray, word: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    x = hashes[before] * _U(0x9E3779B97F4A7C15) ^ hashes[word]
    x = (x ^ x >> _U(32)) * _U(0xD6E8FEB86659FD93)
    return x ^ x >> _U(29)


def _pairs(chunks: DataFrame) -> DataFrame:
    """(chunk, bucket, n): how often each of a chunk's pairs occurs in all training text, in the order of their hashes."""
    own = chunks.filter("own").select("chunk", "doc_ids", "sizes", "toks", "hashes")
    # At least 256 buckets, and about two chunks' tokens a bucket.
    shift = 64 - max(8, (own.count() // 2).bit_length())

    def send(batches):
        for b in batches:
            for chunk, ids, sizes, toks, hashes in zip(*(b.column(i).to_pylist() for i in range(5))):
                sizes, toks = _from_planes(sizes, "<u4").astype(np.int64), _from_planes(toks, "<u4").astype(np.int64)
                before, word, which = follows(sizes, toks)
                train = np.repeat(np.array([not is_held_out(d) for d in ids], bool), sizes)
                n = np.bincount(which[train], minlength=len(word))
                key = _named(before, word, np.frombuffer(hashes, "<u8"))
                order = np.argsort(key, kind="stable")
                key, n = key[order], n[order]
                where = (key >> _U(shift)).astype(np.int64)
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(where)) + 1, [len(where)])).tolist()
                rows = [(chunk, int(where[x]), _planes(np.diff(key[x:y], prepend=_U(0)), "<u8"), _planes(n[x:y])) for x, y in zip(cuts[:-1], cuts[1:])]
                yield _rows(rows, "chunk bigint, bucket bigint, keys binary, n binary")

    def solve(at, rows):
        keys = [np.cumsum(_from_planes(raw, "<u8"), dtype=_U) for _, raw, _ in rows]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")  # merges the rows, which are in order
        every = every[order]
        new = np.concatenate(([True], every[1:] != every[:-1]))
        total = np.empty(len(every), np.int64)
        total[order] = np.add.reduceat(np.concatenate([_from_planes(n) for _, _, n in rows])[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        cuts = np.cumsum([0, *map(len, keys)]).tolist()
        out = [_planes(total[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
        return _rows([(r[0], at, n) for r, n in zip(rows, out)], "chunk bigint, bucket bigint, n binary")

    def run(batches):
        at, rows = None, []
        for b in batches:
            for bucket, *row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if bucket != at:
                    if rows:
                        yield solve(at, rows)
                    at, rows = bucket, []
                rows.append(row)
        if rows:
            yield solve(at, rows)

    sent = own.mapInArrow(send, "chunk bigint, bucket bigint, keys binary, n binary").select("bucket", "chunk", "keys", "n")
    return sent.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(run, "chunk bigint, bucket bigint, n binary")


def trust_gate(n: np.ndarray) -> np.ndarray:
    """By how often the word before was seen; 0 for never."""
    return np.minimum(TRUST - 1, (2 * np.log2(n + 1.0)).astype(np.int64))


def evidence(m: np.ndarray, before: np.ndarray, pair: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """Training occurrences (m of each pair) by gate and by odds of the pair's share against the spelling, one occurrence left out."""
    at = np.flatnonzero(m)
    n, c = before[at] - 1, pair[at] - 1
    odds = np.log(np.maximum(c, 1) / np.maximum(n, 1)) - lp[at] * np.log(10)
    cell = np.where(c > 0, np.clip(np.rint(4 * odds).astype(np.int64) - LEAST + 1, 1, ODDS - 1), 0)
    return np.bincount(trust_gate(n) * ODDS + cell, m[at], TRUST * ODDS).reshape(TRUST, ODDS)


def trusted(seen: np.ndarray, rounds: int = 200) -> np.ndarray:
    """For each gate the weight of the predictor under the word before that makes the evidence likeliest."""
    odds = np.exp((np.arange(ODDS) + LEAST - 1) / 4)
    odds[0] = 0
    total, share = seen.sum(axis=1), np.full(TRUST, 0.5)
    for _ in range(rounds):
        own = share[:, None] * odds
        share = (seen * own / (own + 1 - share[:, None])).sum(axis=1) / np.maximum(total, 1)
        share = np.clip(share, 0, 0.999)
    share[0] = 0
    return share


def _trust(joined: DataFrame) -> np.ndarray:
    import pyarrow as pa

    def run(batches):
        total = np.zeros(TRUST * ODDS)
        for b in batches:
            for raw in b.column(0).to_pylist():
                total += np.frombuffer(_plain(raw))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["seen"])

    rows = common.collect(joined.select("seen").mapInArrow(run, "seen binary"))
    return trusted(sum((np.frombuffer(r["seen"]) for r in rows), np.zeros(TRUST * ODDS)).reshape(TRUST, ODDS))


def _train_rows(b):
    for parts, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
        own, n = _plain(parts).split(b"\n"), _from_planes(raw)
        kept = np.flatnonzero(n)
        yield [own[i] for i in kept.tolist()], n[kept]


def _sized(vocabulary: DataFrame, tasks: int) -> tuple:
    """Bits of each table, so that the keys of training words fill at most one slot in ROOM."""
    import pyarrow as pa

    def run(batches):
        seen = [[np.zeros(0, _U)] for _ in TABLES]
        for b in batches:
            for parts, _ in _train_rows(b):
                for x, y in batches_of(parts, COUNTED):
                    for own, keys in zip(seen, looked_at(parts[x:y])):
                        own.append(keys)
        for k, own in enumerate(seen):
            keys = np.unique(np.concatenate(own)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys)], ["k", "key"])

    rows = common.collect(vocabulary.coalesce(tasks).mapInArrow(run, "k int, key bigint").distinct().groupBy("k").count())
    keys = {r["k"]: LOOKED * r["count"] for r in rows}
    return tuple(max(least, min(MOST, (ROOM * keys.get(k, 0)).bit_length())) for k, least in enumerate(BITS))


def _tables(vocabulary: DataFrame, tasks: int, bits: tuple) -> np.ndarray:
    """Counts of all tables, packed. Tasks count on their own and hand on the pieces that they have anything in."""
    total_slots = sum(1 << b for b in bits)

    def run(batches):
        tables = np.zeros((total_slots, 2), np.float32)
        for b in batches:
            for parts, n in _train_rows(b):
                count(parts, n, tables, bits)
        for k in range(0, total_slots // PIECE):
            own = tables[k * PIECE : (k + 1) * PIECE]
            if own.any():
                yield _rows([(k, _planes(own.reshape(-1), "<f4"))], "piece int, own binary")

    def add(batches):
        at, total = None, None
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != at:
                    if total is not None:
                        yield _rows([(at, _planes(packed(total.reshape(-1, 2)), "<u4"))], "piece int, own binary")
                    at, total = k, np.zeros(2 * PIECE)
                total += _from_planes(raw, "<f4")
        if total is not None:
            yield _rows([(at, _planes(packed(total.reshape(-1, 2)), "<u4"))], "piece int, own binary")

    pieces = vocabulary.coalesce(tasks).mapInArrow(run, "piece int, own binary")
    out = np.zeros(total_slots, np.uint32)
    with common.tuned(vocabulary.sparkSession):
        for r in pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(add, "piece int, own binary").toLocalIterator():  # 4 bytes a slot in all
            out[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = _from_planes(r["own"], "<u4")
    return out


def _learned(vocabulary: DataFrame, tasks: int, tables, bits: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Weights averaged over tasks, by what each learned from, and the last table of all training words under them."""
    import pyarrow as pa

    def run(batches):
        m, mass = Mixer(tables.value, bits=bits), 0.0
        for b in batches:
            for parts, n in _train_rows(b):
                mass += m.learn(parts, n)
        yield pa.RecordBatch.from_arrays([pa.array([mass]), pa.array([m.weights.tobytes()], pa.binary())], ["mass", "weights"])

    own = vocabulary.coalesce(tasks)
    rows = [r for r in common.collect(own.mapInArrow(run, "mass double, weights binary")) if r["mass"] > 0]
    if not rows:
        return Mixer(None).weights, Mixer(None).refine
    rows.sort(key=lambda r: bytes(r["weights"]))
    weights = sum(r["mass"] * np.frombuffer(r["weights"]).reshape(-1, GATES) for r in rows) / sum(r["mass"] for r in rows)

    def settle(batches):
        m = Mixer(tables.value, weights, bits=bits)
        for b in batches:
            for parts, n in _train_rows(b):
                m.settle(parts, n)
        yield _rows([(m.refine.tobytes(),)], "refine binary")

    refined = sorted(bytes(r["refine"]) for r in common.collect(own.mapInArrow(settle, "refine binary")))
    return weights, sum(np.frombuffer(r).reshape(-1, 2) for r in refined)


JOINED = "doc_ids array<bigint>, sizes binary, n_bytes binary, toks binary, n binary, lp binary, pair binary, seen binary"


def _joined(chunks: DataFrame, pairs: DataFrame, vocabulary: DataFrame, tables, learned, bits: tuple) -> DataFrame:
    """A row a chunk: its documents, with the count and the spelling's score of each word and the count of each pair."""

    def known(batches):
        m, n, lp = Mixer(tables.value, *learned.value, bits), None, None
        for b in batches:
            rows = []
            for bucket, kind, chunk, parts, counts, places in zip(*(b.column(i).to_pylist() for i in range(6))):
                if kind == 0:
                    n = _from_planes(counts)
                    lp = m.score(_plain(parts).split(b"\n"), n)
                else:
                    v = _from_planes(places, "<u4")
                    rows.append((chunk, bucket, _planes(n[v]), _planes(lp[v], "<f4")))
            yield _rows(rows, "chunk bigint, bucket bigint, n binary, lp binary")

    own = ("doc_ids", "sizes", "n_bytes", "toks", "hashes", "rank")
    none = [f"cast(null as {'array<bigint>' if c == 'doc_ids' else 'binary'}) as {c}" for c in own]
    sent = vocabulary.select("bucket", "kind", "chunk", "words", "counts", "places").repartition("bucket").sortWithinPartitions("bucket", "kind", "chunk")
    back = sent.mapInArrow(known, "chunk bigint, bucket bigint, n binary, lp binary").selectExpr("chunk", "0 as part", "bucket", "n", "lp", *none)
    counted = pairs.selectExpr("chunk", "1 as part", "bucket", "n", "cast(null as binary) as lp", *none)
    rows = chunks.filter("own").selectExpr("chunk", "2 as part", "0L as bucket", "cast(null as binary) as n", "cast(null as binary) as lp", *own)
    rows = back.union(counted).union(rows).repartition("chunk").sortWithinPartitions("chunk", "part", "bucket")

    def join(batches):
        ns, lps, counted = [], [], []
        for b in batches:
            for part, n, lp, ids, sizes, n_bytes, toks, hashes, rank in zip(*(b.column(i).to_pylist() for i in (1, *range(3, 11)))):
                if part == 0:
                    ns.append(_from_planes(n))
                    lps.append(_from_planes(lp, "<f4"))
                    continue
                if part == 1:
                    counted.append(_from_planes(n))
                    continue
                order = _from_planes(rank, "<u4")
                n, lp = np.concatenate(ns)[order], np.concatenate(lps)[order]
                lengths = _from_planes(sizes, "<u4").astype(np.int64)
                before, word, which = follows(lengths, _from_planes(toks, "<u4").astype(np.int64))
                pair = np.empty(len(word), np.int64)
                pair[np.argsort(_named(before, word, np.frombuffer(hashes, "<u8")), kind="stable")] = np.concatenate(counted)
                ns, lps, counted = [], [], []
                train = np.repeat(np.array([not is_held_out(d) for d in ids], bool), lengths)
                seen = evidence(np.bincount(which[train], minlength=len(word)), n[before], pair, lp[word])
                yield _rows([(ids, sizes, n_bytes, toks, _planes(n), _planes(lp, "<f4"), _planes(pair), _pressed(seen.tobytes()))], JOINED)

    return rows.mapInArrow(join, JOINED)


def score(docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Learned from documents that are not held out; a null doc_id counts as ''. Null and empty texts are the end alone.
    bits_per_byte: of the score over n_bytes and the end. With nothing to learn from, counts are 0, base scores 0 and
    every bit an even chance. Only doc_id and text are read; equal rows have equal scores; an empty table gives no rows.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    buckets = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = common.keep(_chunks(docs, buckets), "chunks", by="own")
    vocabulary = common.keep(_vocabulary(chunks), "vocabulary")
    common.drop(chunks, "own=false")
    pairs = common.keep(_pairs(chunks), "pairs")
    n_train, v_train, n_words = (x or 0 for x in common.collect(vocabulary.agg(F.sum("n_train"), F.sum("v_train"), F.sum("n_words")))[0])
    tasks = max(1, -(-n_words // TASK_WORDS))
    own = vocabulary.filter("kind = 0").select("words", "counts")
    bits = _sized(own, tasks)
    tables = spark.sparkContext.broadcast(_tables(own, tasks, bits))
    learned = spark.sparkContext.broadcast(_learned(own, tasks, tables, bits))
    joined = common.keep(_joined(chunks, pairs, vocabulary, tables, learned, bits), "joined")
    for kept in (pairs, chunks, vocabulary):
        common.drop(kept)
    share = _trust(joined)
    per = float(n_train + v_train + 1)

    def total(batches):
        for b in batches:
            for ids, sizes, n_bytes, toks, n, lp, pair in zip(*(b.column(i).to_pylist() for i in range(7))):
                sizes, toks = _from_planes(sizes, "<u4").astype(np.int64), _from_planes(toks, "<u4").astype(np.int64)
                n, lp, pair = _from_planes(n), _from_planes(lp, "<f4").astype(float), _from_planes(pair)
                before, word, which = follows(sizes, toks)
                own = share[trust_gate(n[before])]
                mixed = np.logaddexp(np.log(1 - own) + lp[word] * np.log(10), np.log(np.maximum(own * pair, 1e-300) / np.maximum(n[before], 1))) / np.log(10)
                mixed = np.where(own * pair > 0, mixed, np.log10(1 - own) + lp[word])
                at = np.cumsum(sizes) - sizes
                base = np.log10((n + 1) / per)
                cols = [np.add.reduceat(x, at) for x in ((n > 0).astype(np.int64)[toks], base[toks], mixed[which])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([is_held_out(d) for d in ids]), pa.array(sizes), pa.array(cols[0]), pa.array(np.full(len(ids), n_train, np.int64)), pa.array(cols[1]), pa.array(cols[2]), pa.array(_from_planes(n_bytes, "<u4").astype(np.int64))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"],
                )

    rows = joined.select("doc_ids", "sizes", "n_bytes", "toks", "n", "lp", "pair").mapInArrow(total, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint")
    return rows.withColumn("bits_per_byte", -F.col("score") / F.lit(np.log10(2).item()) / (F.col("n_bytes") + 1))


def bits_per_byte(scored: DataFrame) -> DataFrame:
    """Total bits over total bytes, ends included, apart for held-out documents and others."""
    return scored.groupBy("held_out").agg((-F.sum("score") / F.lit(np.log10(2).item()) / F.sum(F.col("n_bytes") + 1)).alias("bits_per_byte"))
