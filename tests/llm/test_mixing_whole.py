"""That the language model's counts grow with the corpus."""

import random

import numpy as np

from ledgerline.llm import mixing

from .fixtures import docs


def made(seed, n, letters="abcdefghij"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(n)]


def keys_of(known, k):
    """Distinct (last k bytes of the word, node) of words and their ends."""
    out = set()
    for w in known:
        w += b"\n"
        for i in range(len(w)):
            out |= {(w[max(0, i - k) : i], w[i] >> b | 1 << 8 - b) for b in range(1, 9)}
    return out


def test_keys_are_counted(monkeypatch):
    monkeypatch.setattr(mixing, "LOOKED", 1)
    known = sorted({w.encode() for w in made(1, 500)})
    assert [len(x) for x in mixing.looked_at(known)[1:]] == [len(keys_of(known, k)) for k in (1, 2, 3, 5)]


def test_tables_grow(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BITS", (4, 4, 4, 4, 4))
    texts = [" ".join(made(s, 100)) for s in range(60)]
    known = {w for i, t in enumerate(texts) if not mixing.is_held_out(i + 1) for w in [*mixing.words(t.encode()), b""]}
    bits = mixing._sized(mixing._vocabulary(mixing._chunks(docs(spark, texts), 8)).filter("kind = 0").select("words", "counts"), 2)
    # The keys are an estimate from one context in LOOKED.
    assert len(keys_of(known, 5)) <= 1 << bits[-1] <= 8 * len(keys_of(known, 5))


def test_counts_of_all_bytes_are_exact(monkeypatch):
    """Words of one beginning meet in one batch, however many there are, and no two contexts share a count."""
    monkeypatch.setattr(mixing, "LEARNED", 64)
    rng = random.Random(5)
    known = sorted({w.encode() for w in made(4, 400, "ab")})
    counts = np.array([rng.randint(0, 9) for _ in known])
    seen = {}
    for w, n in zip(known, counts.tolist()):
        for i, c in enumerate(w + b"\n"):
            for b in range(8):
                seen.setdefault((w[:i], c >> b + 1 | 1 << 7 - b), [0, 0])[c >> b & 1] += n
    places = []
    for at in mixing.whole_batches(known, mixing.LEARNED):
        own = [known[i] for i in at.tolist()]
        places += at.tolist()
        word, pos, flat, base, _ = mixing.steps(own)
        whole = mixing.Whole(base, flat, pos, counts[at].astype(float)[word])
        for b in range(8):
            for j, n in zip(whole.far.tolist(), whole.counts(b).tolist()):
                assert n == seen[own[word[j]][: pos[j]], flat[j] >> b + 1 | 1 << 7 - b]
    assert sorted(places) == list(range(len(known)))


def test_order_of_words_counts(spark):
    rng = random.Random(7)
    word = [f"{a}{b}" for a in ("al", "be", "ga", "de") for b in ("pha", "ta", "mma", "lta", "rus")]
    chain = {w: rng.sample(word, 2) for w in word}

    def walk(n):
        out = [rng.choice(word)]
        while len(out) < n:
            out.append(rng.choice(chain[out[-1]]))
        return out

    texts = [walk(40) for _ in range(150)]
    held = next(i for i in range(1000, 2000) if mixing.is_held_out(i) and mixing.is_held_out(i + 7))
    new = walk(60)
    mixed = sorted(new)
    rows = {r["doc_id"]: r for r in mixing.score(docs(spark, [*map(" ".join, texts), (held, " ".join(new)), (held + 7, " ".join(mixed))])).collect()}
    assert rows[held]["base_score"] == rows[held + 7]["base_score"] or abs(rows[held]["base_score"] - rows[held + 7]["base_score"]) < 1e-9
    assert rows[held]["score"] > 0.7 * rows[held + 7]["score"]


def test_pairs_are_counted_over_all_chunks(spark):
    texts = [*(" ".join(made(s, 30, "ab")) for s in range(40)), "", "a", "a a a"]
    seen = {}
    for i, t in enumerate(texts):
        own = [b"", *mixing.words(t.encode()), b""]
        for p in zip(own, own[1:]):
            seen[p] = seen.get(p, 0) + (not mixing.is_held_out(i + 1))
    chunks = mixing._chunks(docs(spark, texts).repartition(5), 8).cache()
    got = {}
    for r in mixing._pairs(chunks).orderBy("chunk", "bucket").collect():
        got.setdefault(r["chunk"], []).extend(mixing._from_planes(r["n"]).tolist())
    rows = chunks.orderBy("chunk", "bucket").collect()
    for r in rows:
        if r["own"]:
            own = [w for o in rows if o["chunk"] == r["chunk"] and not o["own"] for w in mixing._plain(o["words"]).split(b"\n")]
            local = [own[i] for i in mixing._from_planes(r["rank"], "<u4").tolist()]
            before, word, _ = mixing.follows(*(mixing._from_planes(r[k], "<u4").astype(np.int64) for k in ("sizes", "toks")))
            order = np.argsort(mixing._named(before, word, np.frombuffer(r["hashes"], "<u8")), kind="stable")
            assert got[r["chunk"]] == [seen[local[before[i]], local[word[i]]] for i in order.tolist()]


def test_counts_of_16_bits():
    """Large counts keep their proportion, and none that is there goes."""
    n = np.array([[0, 0], [3, 70000], [1e9, 1], [65535, 65535], [2e6, 1e6]])
    p = mixing.packed(n)
    zero, one = p & 0xFFFF, p >> 16
    assert zero.tolist() == [0, 3, 65535, 65535, 65535] and one.tolist()[:4] == [0, 65535, 1, 65535] and abs(int(one[4]) - 32767) <= 1


def test_last_table_has_all_words(spark):
    """However many batches there are, each bit of each training word is in it."""
    known = sorted({w.encode() for w in made(8, 12000)})
    counts = np.full(len(known), 3)
    assert len(mixing.whole_batches(known, mixing.LEARNED)) > 1
    tables = np.zeros((mixing.SLOTS, 2), np.float32)
    mixing.count(known, counts, tables)
    m = mixing.Mixer(mixing.packed(tables))
    m.learn(known, counts)
    m.settle(known, counts)
    assert np.isclose(m.refine.sum(), 8 * 3**mixing.POWER * sum(len(w) + 1 for w in known))


def test_beginnings_are_predicted_once(monkeypatch):
    """Words that begin alike share the bits of their beginning; counts, weights and scores are those of all bytes, one by one."""
    rng = random.Random(11)
    known = sorted({w.encode() for w in made(6, 900, "abc")})
    rng.shuffle(known)
    counts = np.array([rng.randint(0, 9) for _ in known])
    own = mixing.Beginnings(known)
    prefixes = {w[: i + 1] for w in (k + b"\n" for k in known) for i in range(len(w))}
    assert len(own.flat) == len(prefixes) < 0.5 * sum(len(w) + 1 for w in known)
    word, pos, flat, base, each = mixing.steps(known)
    assert all((a[own.which] == b).all() for a, b in ((own.flat, flat), (own.pos, pos), (own.base, base))) and (own.word == word).all()
    plain = np.zeros((mixing.SLOTS, 2))
    for (slots, bit), (few, own_bit) in zip(each, own.bits):
        assert all((a[own.which] == b).all() for a, b in zip([*few, own_bit], [*slots, bit]))
        for at, first in zip(slots, mixing.offsets()):
            np.add.at(plain, (at + first, bit), counts[word])
    tables = np.zeros((mixing.SLOTS, 2), np.float32)
    mixing.count(known, counts, tables)
    assert (tables == plain).all()
    seen = []
    whole = mixing.Mixer.inputs
    monkeypatch.setattr(mixing.Mixer, "inputs", lambda self, slots, *rest: seen.append(len(slots[0])) or whole(self, slots, *rest))
    m = mixing.Mixer(mixing.packed(tables))
    m.learn(known, counts)
    m.settle(known, counts)
    weights, refine = m.weights.copy(), m.refine.copy()
    together = m.score(known, counts)
    assert sum(seen) == 3 * 8 * len(prefixes)

    class Apart(mixing.Beginnings):
        """A beginning for every byte of every word."""

        def __init__(self, parts, bits=mixing.BITS):
            self.word, self.pos, self.flat, self.base, self.bits = mixing.steps(parts, bits)
            self.which = np.arange(len(self.flat))

        def sums(self, x):
            return np.asarray(x, float)[self.word]

    monkeypatch.setattr(mixing, "Beginnings", Apart)
    m = mixing.Mixer(mixing.packed(tables))
    m.learn(known, counts)
    m.settle(known, counts)
    assert np.allclose(m.weights, weights, rtol=0, atol=1e-9) and np.allclose(m.refine, refine, rtol=1e-9)
    assert np.allclose(m.score(known, counts), together, rtol=1e-9)


def test_small_tables_are_looked_up_as_before(monkeypatch):
    rng = random.Random(12)
    known = sorted({w.encode() for w in made(9, 300)})
    counts = np.array([rng.choice((0, 1, 2, 70000)) for _ in known])
    tables = np.zeros((mixing.SLOTS, 2), np.float32)
    mixing.count(known, counts, tables)
    out = []
    for most in (0, 30):
        monkeypatch.setattr(mixing, "READY", most)
        m = mixing.Mixer(mixing.packed(tables))
        m.learn(known, counts)
        m.settle(known, counts)
        out.append((m.weights, m.refine, m.score(known, counts)))
    assert all((a == b).all() for a, b in zip(*out))


def test_pairs_however_they_are_sorted():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 5, 1, 300, 2, 91])
    for toks in (rng.integers(0, 7, 400), rng.integers(0, 1 << 28, 400)):  # two of 28 bits and a place do not fit one number
        before, word, which = mixing.follows(sizes, toks)
        ends = np.cumsum(sizes)
        prev = np.concatenate([np.r_[toks[e - 1], toks[e - n : e - 1]] for e, n in zip(ends, sizes)])
        assert (before[which] == prev).all() and (word[which] == toks).all()
        assert list(zip(before.tolist(), word.tolist())) == sorted(set(zip(prev.tolist(), toks.tolist())))


def test_thue_morse_words_are_not_alike():
    one = np.array([ord("a")], np.uint8)
    for _ in range(12):
        one = np.concatenate([one, 195 - one])  # a and b
    known = [one.tobytes() + b"x", (195 - one).tobytes() + b"x"]
    own = mixing.Beginnings(known)
    assert len(own.flat) == sum(len(w) + 1 for w in known)
    word, pos, flat, base, _ = mixing.steps(known)
    whole = mixing.Whole(base, flat, pos, np.array([3.0, 5.0])[word])
    n = dict(zip(whole.far.tolist(), whole.counts(0).sum(axis=1).tolist()))
    assert [n[len(known[0]) - 1], n[2 * len(known[0])]] == [3, 5]
