import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import suffixes

from .fixtures import ODD, docs


def brute(texts, length):
    """(removed, spans, hash of the rest) of each text, by counting all strings."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for s in range(len(b) - length + 1):
            k = b[s : s + length]
            seen[k] = seen.get(k, 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(120) for _ in range(3)]
    out = [prose(rng.randint(1, 400)) for _ in range(n // 3)]
    for _ in range(n // 3):
        p = rng.choice(passages)
        a = rng.randrange(120)
        out.append(prose(rng.randint(0, 60)) + p[a : a + rng.randint(380, 520)] + prose(rng.randint(0, 60)))
    for _ in range(n // 3):
        t = list(rng.choice(out))
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = "Z"
        out.append("".join(t))
    return out + ["ab" * 700, "x" * 399, "x" * 400, "y" * 401, out[0], out[0]]


def table(frame):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_all_strings_are_found(spark, seed):
    texts = corpus(seed) + ODD
    got = table(suffixes.strip(docs(spark, texts)))
    assert [got[i + 1] for i in range(len(texts))] == brute(texts, 400)
    assert any(g[1] for g in got.values())


def test_cores_with_many_cells(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "MEMBERS", 3)
    texts = corpus(7)
    got = table(suffixes.strip(docs(spark, texts)))
    assert [got[i + 1] for i in range(len(texts))] == brute(texts, 400)


def test_awkward_tables(spark):
    assert suffixes.strip(docs(spark, [])).collect() == []
    t = "word " * 10 + "".join(map(str, range(300)))
    rows = suffixes.strip(docs(spark, [(4, t), (4, t), (None, t), (None, None)]), with_text=True).collect()
    assert sorted((r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in rows) == [(0, 0, b"")] + [(len(t), len(t), b"")] * 3
    assert suffixes.strip(docs(spark, [t, t[:399]])).filter("n_removed > 0").collect() == []


def test_construction_against_pairs():
    rng = random.Random(4)
    for _ in range(60):
        columns, width = 14, 4
        length = columns - width + 1
        rows = []
        for _ in range(rng.randint(1, 25)):
            left = rng.choice([0, 0, 0, 2])
            rows.append((left, bytes(rng.choice(b"ab") if rng.random() < 0.2 else 97 for _ in range(rng.choice([columns, columns, 12]) - left))))
        got = suffixes.construct(rows, columns, length, width)
        full = [b"\0" * left + b for left, b in rows]
        for i, (left, b) in enumerate(rows):
            for x in range(width):
                s = full[i][x : x + length]
                alike = any(j != i and x >= rows[j][0] and full[j][x : x + length] == s for j in range(len(rows)))
                assert got[i, x] == (x >= left and len(s) == length and alike)


def test_range_minima():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 100, 50)
    a = rng.integers(0, 49, 200)
    b = a + 1 + (rng.random(200) * (50 - a)).astype(int)
    b = np.minimum(b, 50)
    assert (suffixes._range_min(v, a, b) == [v[x:y].min() for x, y in zip(a, b)]).all()


def thue_morse(pair, n=64):
    return "".join(pair[bin(i).count("1") & 1] for i in range(n))


def test_texts_with_one_rolling_hash_are_told_apart(spark):
    """Polynomial hashes modulo 2**64 collide on Thue-Morse words, whatever their base; only bytes decide."""
    ends = "".join(chr(97 + i * 7 % 26) for i in range(72)), "".join(chr(65 + i * 11 % 26) for i in range(72))
    texts = []
    for turn in (str, lambda p: p[::-1]):
        texts.append(ends[0] + "".join(thue_morse(turn(p)) for p in ("li", "Z4", "sB", "WO")) + ends[1])
    assert len(texts[0]) == 400 and texts[0] != texts[1]
    spread = [ends[0] + thue_morse("ab", 512) + ends[1], ends[0] + thue_morse("ba", 512) + ends[1]]
    for pair in (texts, spread):
        got = table(suffixes.strip(docs(spark, pair)))
        assert [got[i + 1] for i in range(2)] == brute(pair, 400)
    assert not any(g[1] for g in table(suffixes.strip(docs(spark, texts))).values())


@pytest.mark.parametrize("seed", [8, 11, 37, 40])
def test_a_place_in_two_cells_is_no_repeat_of_itself(spark, seed):
    rng, out = random.Random(seed), []
    while sum(map(len, out)) < 3400:
        word = "".join(rng.choice("aeiou rstn") for _ in range(rng.randint(2, 8))).strip() + " "
        out.append(word * (rng.randint(500, 1400) // len(word)) if rng.random() < 0.6 else "".join(rng.choice("abcdefghij ") for _ in range(rng.randint(50, 300))))
    (row,) = suffixes.strip(spark.createDataFrame([(1, "".join(out))], "doc_id long, text string")).collect()
    assert tuple(row)[1:5] == brute(["".join(out)], suffixes.LENGTH)[0]
