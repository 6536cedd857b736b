import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing, tokenfile, tokens

from .fixtures import ODD, docs


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_the_whole(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        spec = f.read()
    own, plain = tokens.Encoder(spec), Tokenizer.from_str(spec)
    rng = random.Random(3)
    alphabet = "ab'sZ9 \n\t\r .,é́ß  \x0b\x1cİΣ漢<|>" + "  \n"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for t in texts:
        assert own(t) == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)
    assert own.dropped != bool(own.kept)


@pytest.mark.parametrize("kind", ["one", "few", "many", "skewed", "none"])
def test_round_trip_of_a_segment(kind):
    rng = np.random.default_rng(5)
    n = {"one": 5000, "none": 0}.get(kind, 60_000)
    ids = {"one": np.full(n, 7), "few": rng.integers(0, 3, n), "many": rng.integers(0, 49408, n), "skewed": np.minimum(rng.geometric(0.4, n), 60000), "none": np.zeros(0)}[kind].astype("<u4")
    cuts = sorted(rng.integers(0, n + 1, 5).tolist())
    parts = [ids[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
    names = [None, -5, 3, 3, 2**62, 9]
    raw = tokenfile.pack_segment(names, [p.tobytes() for p in parts], lanes=64, steps=16)
    s = tokenfile.Segment(raw)
    assert s.doc_ids == names and (s.ids() == ids).all() and int(s.f.sum()) in (0, 1 << s.bits)
    for i, p in enumerate(parts):
        assert (s.document(i) == p).all()
    if n:
        broken = bytearray(raw)
        broken[-1] ^= 1
        bad = tokenfile.Segment(bytes(broken))
        with pytest.raises(tokenfile.Damaged):
            bad.ids()
        if len(bad.points) > 1:
            bad.block(0)
        broken = bytearray(raw)
        broken[tokenfile.HEAD.size + 12] ^= 1
        with pytest.raises(tokenfile.Damaged):
            tokenfile.Segment(bytes(broken))


def reference_ids(name, text, end=2):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return t.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_file(spark):
    frame = docs(spark, [(5, "b a"), (None, "no id"), (2, None), (9, ""), (7, "x " * 3000), (5, "b a"), (-1, "first")])
    got = sorted((tuple(r) for r in tokenfile.digest(frame).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, -1, 2, 5, 5, 7, 9]
    at, texts = 0, {None: "no id", -1: "first", 2: None, 5: "b a", 7: "x " * 3000, 9: ""}
    for d, start, n, c in got:
        ids = reference_ids("word_bpe_49k.json", texts[d])
        assert (start, n, c) == (at, len(ids), crc(ids))
        at += n
    assert tokenfile.digest(docs(spark, [])).collect() == []


def check_packing(pieces, texts, cap):
    by_doc, bins = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for d, rows in by_doc.items():
        ids = reference_ids("byte_bpe_50k.json", texts[d])
        rows.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(rows):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == cap)
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids) and (len(ids) > cap or len(rows) == 1)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= cap
    return len(bins)


def test_packing(spark):
    rng = random.Random(1)
    texts = {i: t for i, t in enumerate([*ODD, *["word " * rng.randrange(900) for _ in range(150)], *["same text " * 40] * 60])}
    n = check_packing(packing.digest(docs(spark, list(texts.items()))).collect(), texts, 1024)
    total = sum(len(reference_ids("byte_bpe_50k.json", t)) for t in texts.values())
    assert n <= 1.03 * total / 1024 + 1
    assert packing.digest(docs(spark, [])).collect() == []
    twice = packing.digest(docs(spark, [(1, "same"), (1, "same"), (None, "x")])).collect()
    assert len(twice) == 3 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3


def test_sequences(spark):
    texts = {i: "some words " * (i * 7) for i in range(30)}
    pieces = packing.pack(docs(spark, list(texts.items())), public_tokenizers.path("byte_bpe_50k.json"), cap=64, with_ids=True)
    rows = packing.assemble(pieces).collect()
    assert all(len(r["ids"]) <= 64 for r in rows)
    assert sum(len(r["ids"]) for r in rows) == sum(len(reference_ids("byte_bpe_50k.json", t)) for t in texts.values())


def plain_best_two_fit(lengths, cap):
    """The same rule a bin at a time, over a list."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], cap
        rest = []
        for x in left:
            if x <= gap:
                own.append(x)
                gap -= x
            else:
                rest.append(x)
        if gap and len(own) > 1:
            least = own[-1]
            fits = [(a + b, i, j) for i, a in enumerate(rest) for j, b in enumerate(rest) if i < j and least < a + b <= gap + least]
            if fits:
                top = max(f[0] for f in fits)
                _, i, j = next(f for f in fits if f[0] == top)
                own = own[:-1] + [rest[i], rest[j]]
                rest = [x for k, x in enumerate(rest) if k not in (i, j)] + [least]
                rest.sort(reverse=True)
        bins.append(own)
        left = rest
    return bins


def test_plan_packs_all_and_as_well_as_a_bin_at_a_time():
    rng = random.Random(2)
    for _ in range(40):
        cap = rng.choice([10, 50, 200])
        lengths = [rng.randint(1, cap) for _ in range(rng.randrange(80))]
        counts = {x: lengths.count(x) for x in lengths}
        bins = packing.plan(counts, cap)
        assert sorted(x for b, n in bins for x in b * n) == sorted(lengths)
        assert all(sum(b) <= cap for b, _ in bins)
        assert abs(sum(n for _, n in bins) - len(plain_best_two_fit(lengths, cap))) <= 1


def test_words_with_signs_are_encoded_as_plain_words_once():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        run = tokens.Encoder(f.read())
    whole, asked = run.whole, []
    run.whole = lambda text: asked.append(text) or whole(text)
    for text in ["oak*** Oak*** elm*** OAK. (oak) \u00c9lan$$$ \u00e9lan", "a'** a's** x-- --x a.b. A<s> x\"' \u00f1and\u00fa...! a\u2019s a\u2014 e\u0301, fin.\u0301 <|endoftext|> a<|endoftext|>", "***"]:
        assert run(text) == whole(text)
    assert asked.count("***") == 1 and not any(len(x) > 3 and x.endswith("***") for x in asked)
