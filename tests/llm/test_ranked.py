import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import common, ranked

from .fixtures import ODD, docs


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def brute(rows, items, k=10):
    """rows: (doc_id, text), each a document; items: (item_id, text)."""
    bags = [(d, Counter(terms(t))) for d, t in rows]
    bags = [(d, c, sum(c.values())) for d, c in bags if c]
    n, total = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item in dict.fromkeys(i for i, _ in items):
        wanted = {t for i, text in items if i == item for t in terms(text)}
        scores = []
        for d, c, size in bags:
            m = 100 - 90 + ((90 * size * n) // total)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(str(item), r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(((str(r[0]), *r[1:]) for r in df.collect()), key=str)


def table(spark, items):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id string, text string, rank int, term string, score int")


def corpus(seed, n=300):
    """Texts of a few common and many rare words, with copies of one text."""
    rng = random.Random(seed)
    common_words, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    texts = [" ".join(rng.choices(common_words, k=rng.randint(1, 30)) + rng.choices(rare, k=rng.randint(0, 8))) for _ in range(n)]
    texts += ["c1 c2 r7 r8 r9 c3"] * 60
    items = [(f"i{j}", " ".join(rng.sample(common_words, 4) + rng.sample(rare, j % 4))) for j in range(12)] + [("same", "r7 r8 r9"), ("stops", " ".join(common_words)), ("nothing", "zz yy"), ("none", None), (None, "R7, c1!"), ("twice", "r1"), ("twice", "r2 c4")]
    return texts, items


@pytest.mark.parametrize("seed,top,factor,hot,most", [(1, 512, 8, 8, 1000), (2, 4, 2, 8, 5), (3, 1, 3, 1000, 1), (4, 16, 4, 2, 10**6)])
def test_any_tiers_give_the_same(spark, monkeypatch, seed, top, factor, hot, most):
    texts, items = corpus(seed)
    for name, value in (("TOP", top), ("FACTOR", factor), ("HOT", hot), ("MOST", most), ("WORDS", 700)):
        monkeypatch.setattr(ranked, name, value)
    frame = docs(spark, [(len(texts) - i, t) for i, t in enumerate(texts)])
    index = ranked.build(frame.repartition(3))
    assert got(ranked.search(index, table(spark, items))) == brute([(len(texts) - i, t) for i, t in enumerate(texts)], items)


def test_items_fall_through_until_they_are_proved(spark, monkeypatch):
    monkeypatch.setattr(ranked, "TOP", 4)
    monkeypatch.setattr(ranked, "FACTOR", 2)
    texts, items = corpus(5)
    index = ranked.build(docs(spark, texts))
    asked = spark.createDataFrame([(0, "r7 r8 r9"), (1, "c0 c1 c2 c3 c4 c5 c6 c7 c8 c9 c10 c11"), (2, "r5")], "item bigint, text string")
    found, proved = ranked.best(index, asked)
    assert sum(proved) == 3 and proved[0] < 3 and len(proved) > 1


def test_residual_bounds_hold(spark, monkeypatch):
    monkeypatch.setattr(ranked, "TOP", 4)
    texts, _ = corpus(6)
    index = ranked.build(docs(spark, texts))
    rows = index.lists.collect()
    of = {}
    for r in rows:
        impacts = np.frombuffer(bytes(r.impacts), "<u4")
        assert r.n == len(impacts) == len(np.frombuffer(bytes(r.dids), "<i8")) and r.top == impacts.max()
        of.setdefault(bytes(r.term), {}).setdefault(r.tier, []).extend(impacts.tolist())
    df = Counter(t for x in texts for t in set(terms(x)))
    assert {t.decode(): sum(map(len, x.values())) for t, x in of.items()} == df
    assert sum(len(x) > 1 for x in of.values()) > 10


def test_awkward_rows(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)] + [(7, "the cat sat on the mat"), (7, "the cat"), (7, "the cat")]
    items = [("a", "the CAT"), ("b", ""), ("c", None), ("d", "naïve 漢字 mat"), ("e", "long x"), ("f", "the cat sat on the mat " * 40)]
    frame = spark.createDataFrame([(d, t, "en", 3, 4) for d, t in rows], "doc_id bigint, text string, item_id string, segment int, score int")
    assert got(ranked.digest(frame, table(spark, items))) == brute(rows, items)


def test_empty_tables(spark):
    assert got(ranked.digest(docs(spark, []), table(spark, [("a", "x")]))) == []
    assert got(ranked.digest(docs(spark, ["x"]), table(spark, []))) == []
    assert got(ranked.digest(docs(spark, [None, "", "?!"]), table(spark, [("a", "x")]))) == []


def test_sliced_rows():
    import pyarrow as pa

    whole = pa.RecordBatch.from_arrays([pa.array(range(10))], ["x"])
    assert [b.num_rows for b in common.sliced([whole], 4)] == [4, 4, 2]
