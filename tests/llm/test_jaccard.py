import random
import re

import numpy as np
import pytest

from ledgerline.llm import jaccard

from .fixtures import ODD, docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def brute(texts):
    """{doc: (n, component)} by all pairs."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    top = {d: d for d in texts}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = prose(30)
    out = []
    for _ in range(12):
        base = prose(rng.randint(5, 120))
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    out += [" ".join(prose(5) + passage + prose(5)) for _ in range(15)]
    out += ["one two", "one two", "One  TWO", "three", "x y z w", "x y z w v", "x y z w v u"] + [None, "", " \t"]
    hub = prose(60)
    out += [" ".join(hub[:k] + ["ZZ"] + hub[k + 1 :]) for k in range(0, 60, 2)]
    rng.shuffle(out)
    return out


def table(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    texts = dict(enumerate(corpus(seed), 10))
    assert table(jaccard.classes(docs(spark, list(texts.items())))) == brute(texts)


def test_small_trees_hubs_and_groups(spark, monkeypatch):
    """Blocks of a large token, hot tokens, several tasks a hub, and sets on both sides of a change of groups."""
    monkeypatch.setattr(jaccard, "TREE", 5)
    monkeypatch.setattr(jaccard, "HUB", 2)
    monkeypatch.setattr(jaccard, "LEAF", 2)
    monkeypatch.setattr(jaccard, "HOT", 3)
    monkeypatch.setattr(jaccard, "GROUPS", ((40, 16), (80, 32), (1 << 62, 64)))
    texts = dict(enumerate(corpus(3), 10))
    assert table(jaccard.classes(docs(spark, list(texts.items())))) == brute(texts)


def test_awkward_tables(spark):
    assert jaccard.classes(docs(spark, [])).collect() == []
    texts = {i: t for i, t in enumerate(ODD)}
    assert table(jaccard.classes(docs(spark, list(texts.items())))) == brute(texts)
    got = jaccard.classes(docs(spark, [(3, "a b c d e"), (3, "a b c d e"), (None, "A b c d e"), (None, "other words"), (9, "a b c d e")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in got) == [(-1, -1), (-1, 3), (3, 3), (3, 3), (9, 3)]
    kept = jaccard.dedupe(docs(spark, [(3, "a b c d e"), (5, "a b c d e"), (7, None), (8, "")])).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 7, 8] and kept[0]["rank"] == "x"


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    for _ in range(50):
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 3000))) for _ in range(2))
        v, w = jaccard.vector(a), jaccard.vector(b)
        groups = min(len(v), len(w))
        x, y = (jaccard.folded(u[None].astype(np.int64), groups)[0] for u in (v, w))
        assert np.minimum(x, y).sum() >= len(np.intersect1d(a, b)) and v.sum() == len(a)


def test_trees_find_all_pairs_within_the_bound():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(2, 150))
        vec = rng.poisson(rng.choice([1, 4]), (n, 8))
        vec[n // 2 :] = np.maximum(0, vec[: n - n // 2] + rng.integers(-1, 2, (n - n // 2, 8)))
        size, part = vec.sum(axis=1), rng.integers(0, max(1, n // 3), n)
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if part[i] != part[j] and 4 * size[i] >= 3 * size[j] and 4 * size[j] >= 3 * size[i] and 7 * np.minimum(vec[i], vec[j]).sum() >= 3 * (size[i] + size[j])}
        got = [tuple(sorted(p)) for pairs in jaccard.tree_pairs(size, vec, part) for p in pairs.tolist()]
        assert len(got) == len(set(got)) and want <= set(got)


def test_components_of_chains_stars_and_cliques(spark):
    from ledgerline.llm import common

    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(i, j) for i in range(300, 308) for j in range(300, 308)] + [(1, 1), (-5, 2), (2, -5)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(edges)
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for x in top if sum(find(x) == find(y) for y in top) > 1}
