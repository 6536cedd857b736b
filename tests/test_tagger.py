import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.functions import names
from ledgerline.operators import tagger


def test_decoding_against_all_paths():
    rng = np.random.default_rng(3)
    for n in range(1, 6):
        for _ in range(40):
            e, m = rng.integers(-3, 4, (n, 3)).astype(float), rng.integers(-3, 4, (4, 3)).astype(float)
            score = lambda p: -np.inf if any(t == 2 and b not in (1, 2) for b, t in zip((3, *p), p)) else m[3, p[0]] + e[0, p[0]] + sum(m[a, b] + e[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:])))
            got = tuple(tagger.decode(e, m))
            assert score(got) == max(score(p) for p in itertools.product(range(3), repeat=n))


def test_averages_as_step_by_step():
    rows = [(["Estate", "of", "Ann", "Poe"], [0, 0, 1, 2]), (["Notice", "to", "All"], [0, 0, 0]), (["Bo", "Lee"], [1, 2])] * 2
    start = np.zeros((tagger.SIZE + 4, 3))
    start[5, 1] = 0.25
    w, total = start.copy(), np.zeros_like(start)
    for words, tags in rows:  # the plain way: add up all weights after each text
        found = tagger.features(words)
        guess = tagger.decode(np.stack([w[f].sum(0) for f in found]), w[tagger.SIZE :])
        for which, by in ((tags, 1.0), (guess, -1.0)):
            for i, t in enumerate(which):
                for x in found[i]:
                    w[x, t] += by
                w[tagger.SIZE + (which[i - 1] if i else 3), t] += by
        total += w
    assert np.allclose(tagger._learn(rows, start), total / len(rows))


def captions(spark, n=1500, seed=1):
    rng = random.Random(seed)
    syllables = ["ba", "ren", "to", "mi", "sel", "dor", "ka", "lin", "wes", "ota"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 3))).title()
    rows = []
    for i in range(n):
        name = " ".join(word() for _ in range(rng.randint(1, 3))) + rng.choice(["", "-" + word(), " O'" + word()])
        firm = f"{word()} {rng.choice(['Holdings LLC', 'Bank', 'Trust Co'])}"
        t, known = rng.choice([(f"Estate of {name}, Deceased", name), (f"In the Matter of {name}", name), (f"{firm} v. {name}", name), (f"Notice to {firm} of Harris County", ""), (f"Application by {name} as Executor", name), (f"Order of the Probate Court No. {i}", "")])
        rows.append((i, t, known))
    return spark.createDataFrame(rows, "id int, caption string, known string")


def test_held_out_accuracy(spark):
    rows = captions(spark)
    words, tags = tagger.tagged(F.col("caption"), [F.col("known")])
    model = tagger.fit(rows.filter("id % 5 <> 0").select(words.alias("words"), tags.alias("tags")))
    again = tagger.fit(rows.filter("id % 5 <> 0").repartition(7).select(words.alias("words"), tags.alias("tags")))
    assert np.allclose(model.weights, again.weights)  # however the table lies
    got = tagger.recognised(rows.filter("id % 5 = 0"), "caption", model).collect()
    assert len(got) == 300 and sum(r.person == r.known for r in got) > 0.95 * len(got)


def test_tags_of_known_names(spark):
    df = spark.createDataFrame([("Estate of ANN B. Poe, and Poe", "Ann B Poe"), ("x y", ""), (None, "a"), ("Ann Ann", "ann"), ("Ann", "Ann Poe")], "t string, n string")
    words, tags = tagger.tagged(F.col("t"), [F.col("n")])
    got = [(r.w, "".join(r.g or [])) for r in df.select(words.alias("w"), tags.alias("g")).collect()]
    assert [g for _, g in got] == ["OOBIIOO", "OO", "", "BO", "O"]


def test_no_texts_and_odd_rows(spark):
    df = spark.createDataFrame([(["a"], ["B", "I"]), ([], []), (None, None), (["a", None], ["O", "O"]), (["a"], ["X"])], "words array<string>, tags array<string>")
    model = tagger.fit(df)
    assert not model.weights.any()
    rows = spark.createDataFrame([(None, "k"), ("", "k"), ("Ann Poe", "k")], "t string, person string")
    assert [r.person for r in tagger.recognised(rows, "t", model).collect()] == ["", "", ""]


def test_recognised_names_come_first(spark):
    df = spark.createDataFrame([("IN THE ESTATE OF: JANE POE, DECEASED", "Ann Lee Bo"), ("IN THE ESTATE OF: JANE POE, DECEASED", ""), ("IN THE ESTATE OF: JANE POE, DECEASED", None), ("x", "Cher")], "c string, p string")
    d = names.decedent(F.col("c"), F.col("p"))
    assert [tuple(r) for r in df.select(d["first"], d["last"]).collect()] == [("Ann Lee", "Bo"), ("Jane", "Poe"), ("Jane", "Poe"), ("Cher", "")]


def test_captions_with_hyphens_apostrophes_and_accents(spark):
    cases = {"IN THE ESTATE OF: ANNA BERTA TEST-CASE, DECEASED": ("Anna Berta", "Test-Case"), "MARY O'SAMPLE": ("Mary", "O'Sample"), "JOSÉ É TESTÓN": ("José É", "Testón"), "Testón Maria Lopez": ("Maria", "Lopez"), "ésample name two": ("name", "two"), "MÜLLER-O’NEIL ANN LEE": ("O’Neil Ann", "Lee")}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r.c: (r["first"], r["last"]) for r in df.select("c", names.decedent(F.col("c")).alias("d")).select("c", "d.*").collect()}
    assert got == cases
    words = ["o'neil-x ß9a", "ÅSA ÖSTER", "it's 3rd"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(names.titled(F.col("w"))).collect()][1:] == [w.title() for w in words][1:]


def test_copies_weigh_as_if_each_were_read():
    kinds = [(["Estate", "of", "Ann", "Poe"], [0, 0, 1, 2], 5), (["Notice", "to", "All"], [0, 0, 0], 3), (["Bo", "Lee"], [1, 2], 4), (["Bo", "Lee"], [0, 0], 2)]
    start = np.zeros((tagger.SIZE + 4, 3))
    each = [(words, tags) for words, tags, times in kinds for _ in range(times)]
    assert np.array_equal(tagger._learn(kinds, start), tagger._learn(each, start))


def test_copies_are_one_row_to_learn_from(spark, monkeypatch):
    seen = []
    kept = tagger.files.kept
    monkeypatch.setattr(tagger.files, "kept", lambda df, name: seen.append(df.count()) or kept(df, name))
    rows = [(["Estate", "of", "Ann", "Poe"], ["O", "O", "B", "I"]), (["Notice", "to", "All"], ["O", "O", "O"])]
    many = tagger.fit(spark.createDataFrame(rows * 50, "words array<string>, tags array<string>"))
    told = tagger.fit(spark.createDataFrame([(*r, 50) for r in rows], "words array<string>, tags array<string>, n long"), times="n")
    assert seen == [2, 2] and np.array_equal(many.weights, told.weights)
