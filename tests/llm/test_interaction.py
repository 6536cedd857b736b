import itertools
import re

from ledgerline.llm import interaction

from .fixtures import ODD


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    out = {}
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and any((t2 or "") == t and d2 is not None and d2 < d for d2, t2, _ in docs),
        }
        own = [x for x in labels if d is not None and x[0] == d]
        rows.append((lang or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                total[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[1][x] and any(r[1][y] for y in order[: step - 1]) for r in mine), sum(r[1][x] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr("*", "1 as mask", "'x' as part", "2 as n", "'y' as digest", "true as quality")
    x = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'z' as text", "0 as lang")
    got = interaction.audit(d, x)
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = got.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in rows}


def test_against_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [*ODD, long, long, long + " #", "A" * 300 + " " + long, "spam spam " * 200, "SPAM " * 300 + "|", long]
    docs = [(100 - i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)]
    docs += [(None, long, "en"), (None, long, "en"), (3, long, "de"), (3, long, "de"), (3, "other", "de"), (1, None, None)]
    labels = [(100 - i, i % 2, (i // 2) % 2) for i in range(0, len(texts), 2)] + [(3, 1, 1), (3, 0, None), (None, 1, 1), (999, 1, 1), (98, None, 1)]
    want = brute(docs, labels)
    assert run(spark, docs, labels) == want
    assert len(want) == 600 * 3


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == {}
    got = run(spark, [(1, None, None)], [])
    assert got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and len(got) == 600


def test_shapley_sums_to_all_that_is_removed(spark):
    got = run(spark, [(i, "a " * (i * 30) + "#" * (i % 2), "en") for i in range(12)], [])
    assert sum(v[6] for (_, order, _), v in got.items() if order == "ABCDE") == 120 * sum(v[1] for (_, order, _), v in got.items() if order == "ABCDE")
