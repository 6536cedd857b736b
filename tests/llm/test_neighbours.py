import math

import numpy as np

from ledgerline.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell int, dist double, v string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 0.5, "x", 3) for i, v in rows], SCHEMA)


def brute(queries, data, k=5):
    def ok(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    def ints(v):
        return [math.floor(256 * float(np.float32(x))) for x in v]

    out = []
    data = [(i, ints(v)) for i, v in data if ok(i, v)]
    for i, v in {(i, tuple(ints(v))) for i, v in queries if ok(i, v)}:
        scores = sorted((-sum(a * b for a, b in zip(v, x)), j) for j, x in data if j != i)
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def test_clusters_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    rows = [(int(i), (centres[i % 12] + rng.normal(size=8) * 0.02).round(3).tolist()) for i in range(600)]
    rows += [(1000 + i, centres[3].tolist()) for i in range(300)]
    monkeypatch.setattr(neighbours, "PIVOTS", 16)
    df = frame(spark, rows)
    assert got(neighbours.digest(df)) == brute([r for r in rows if r[0] % 50 == 0], rows)


def test_distant_cells_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 8)
    rng = np.random.default_rng(2)
    centres = np.eye(16)[:12]
    rows = [(int(i), (centres[i % 12] + rng.normal(size=16) * 0.005).tolist()) for i in range(480)]
    sent = []
    given = neighbours._given
    monkeypatch.setattr(neighbours, "_given", lambda *a: sent.append(given(*a)) or sent[-1])
    df = frame(spark, rows)
    queries = [r for r in rows if r[0] % 4 == 0]
    assert got(neighbours.search(frame(spark, queries), df)) == brute(queries, rows)
    groups = sent[0].select("grp").distinct().count()
    assert groups > 1 and sent[0].count() < 0.7 * groups * len(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2, 3]), (50, [1, 2]), (100, []), (None, [9, 9, 9]), (1, None), (2, [1, None, 2]), (3, [nan, 1, 1]), (4, [1, inf, 0]), (5, [-0.001, 0, 0.5]), (6, [2, 2, 2]), (6, [2, 2, 2]), (50, [3, 3, 3]), (50, [3, 3, 3]), (150, None), (200, [0, 0, 0]), (7, [1e6, -1e6, 3])]
    assert got(neighbours.digest(frame(spark, rows))) == brute([r for r in rows if r[0] is not None and r[0] % 50 == 0], rows)


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5])]
    assert got(neighbours.digest(frame(spark, rows))) == brute(rows, rows)
    assert got(neighbours.digest(frame(spark, rows[:1]))) == []
    assert got(neighbours.digest(frame(spark, []))) == []
    assert got(neighbours.digest(frame(spark, [(1, [1.0])]))) == []


def test_a_block_never_loses_a_best(spark):
    rng = np.random.default_rng(3)
    for _ in range(50):
        own = rng.integers(0, 6, 4)
        ids = rng.integers(0, 12, 40)
        products = rng.integers(-3, 4, (4, 40))
        held = (np.zeros(0, np.int64),) * 3
        for a in range(0, 40, 8):
            held = neighbours.best(products[:, a : a + 8].copy(), ids[a : a + 8], own, held, 3)
        want = [(q, -s, j) for q in range(4) for s, j in sorted((-int(products[q, c]), int(ids[c])) for c in range(40) if ids[c] != own[q])[:3]]
        assert list(zip(*(x.tolist() for x in held))) == want
