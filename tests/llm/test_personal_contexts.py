"""What the personal data field is fitted on."""

import math
import random

import numpy as np

from ledgerline.llm import pii

from .fixtures import docs


def test_contexts_come_from_the_whole_sample():
    """A document full of digits does not end the sample; each document gives a bounded number a kind."""
    full = " ".join(str(n) for n in range(1000, 1200))
    late = [f"please write to ann{c}@mail.example.org for more" for c in "abcdefgh"]
    many = "; then also the next of our many good friends, ".join(f"x{c}@mail.example.org" for c in "abcdef")
    made = pii.contexts([full, *late, many])
    assert sum(not gold and "1000" in text for text, gold in made) <= pii.EACH
    for c in "abcdefgh":
        assert any(gold and f"ann{c}@mail.example.org" in text for text, gold in made)
    assert sum(bool(gold) and "good" in text for text, gold in made) == 2 * pii.EACH


def totals(n, segments, touch):
    """Scores of all ways to lay segments (first, after the last, scores by kind) on n tokens."""

    def rest(at, state):
        if at == n:
            yield 0.0
            return
        yield from rest(at + 1, 0)
        for a, b, scores in segments:
            if a == at:
                for k, s in enumerate(scores):
                    for more in rest(b, 1 + k):
                        yield s + touch[state, k] + more

    return list(rest(0, 0))


def test_decoding_and_sums_against_all_segmentations():
    rng = random.Random(3)
    draw = np.random.default_rng(3)
    size = pii.Tokens("0").features(np.zeros(1, int), np.ones(1, int)).shape[1]
    some = 0
    for _ in range(60):
        text = "".join(rng.choice(["12", "345", " ", " ", ".", "-", "@", "ab", "at", "(", "7777"]) for _ in range(rng.randint(4, 9)))
        touch = np.vstack([np.zeros(4), draw.normal(0, 1, (4, 4))])
        weights = draw.normal(0, 0.7, (size, 4)), touch
        t = pii.Tokens(text)
        a, b, scores = pii.scored(t, weights)
        every = totals(len(t.words), list(zip(a.tolist(), b.tolist(), scores.tolist())), touch)
        chosen = pii.best(a, b, scores, touch)
        place = {(i, j): x for x, (i, j) in enumerate(zip(a.tolist(), b.tolist()))}
        got, end, state = 0.0, None, 0
        for i, j, k in chosen:
            got += scores[place[i, j], k] + touch[state if i == end else 0, k]
            end, state = j, 1 + k
        assert math.isclose(got, max(every), abs_tol=1e-6)
        if len(a):
            some += 1
            c = pii.Chains([(text, [])])
            ahead, behind, z = c.sums(c.x @ weights[0], touch)
            assert math.isclose(z[0], sum(map(math.exp, every)), rel_tol=1e-6) and math.isclose(behind[0, 0], z[0], rel_tol=1e-9)
    assert some > 20


def test_only_tokens_bound_a_segment():
    weights = pii.fit([])
    found = lambda t: [(pii.KINDS[k], t[s:e]) for k, s, e in pii.find(t, weights)[1]]
    for t in ("x" * 50 + " at corp dot com", "x" * 40 + "(at)" + "y" * 45 + "(dot)com"):
        assert found(t) == [("email", t)]
    for t in ("0044 20 7946 0958", "01 23 45 67 89", "0123 456 78 90"):
        assert found(f"tel {t} x") == [("phone", t)]
    prose = "Licensed under CC BY-NC 4.0. " + "the of and. " * 40 + "at the river, in 1999 and 2004."
    assert found(prose) == []


def test_awkward_rows(spark):
    rows = pii.digest(docs(spark, [(None, "a@b.co"), (7, None), (7, ""), (7, "a@b.co"), (7, "a@b.co")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_email"], r["spans"]) for r in rows) == [(0, 1, "email:0:6"), (7, 0, ""), (7, 0, ""), (7, 1, "email:0:6"), (7, 1, "email:0:6")]
