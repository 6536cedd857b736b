"""Operator 8, toxicity behind a noisy channel.

What a writer meant is restored before it is scored: a token in disguise is a lattice of the characters that each sign
may stand for, with runs of a letter shortened and letters that stand alone joined; the likeliest path under a
character model of the corpus is the restored word. A logistic model over words and their beginnings scores the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled documents that the classifier is fitted on, of each label, those with the least hashes.
SAMPLE = {1: 4000, 0: 8000}
#: Lengths of the beginnings of words that are features beside the words.
STEMS = (3, 4, 5, 6)
#: Tokens that a worker remembers the features of.
REMEMBERED = 1 << 19

#: Letters that a sign may stand for.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
#: Log-probabilities of the channel: a sign for a letter, a sign for nothing, a run of letters shortened.
AS_LETTER, AS_SIGN, SHORTER = -1.0, -9.0, -0.5

_LETTERS = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"[^\W\d_][0-9@$!|+€]|[0-9@$!|+€][^\W\d_]|([^\W\d_])\1\1")
_SPACED = re.compile(r"^[^\w@$!|+€]*(?:[\w@$!|+€][.\-_*·,'/ ]+){2,}[\w@$!|+€][^\w@$!|+€]*$")
_BETWEEN = re.compile(r"[.\-_*·,'/ ]+")
_RUN = re.compile(r"(.)\1{2,}", re.S)


class CharModel:
    """Trigrams of letters, smoothed by bigrams. counts: {three characters: how often}; a word is framed by two spaces and one."""

    def __init__(self, counts: dict[str, int]):
        self.three, self.two, self.pair, self.one = counts, Counter(), Counter(), Counter()
        for g, n in counts.items():
            self.two[g[:2]] += n
            self.pair[g[1:]] += n
            self.one[g[1]] += n
        self.size = len({g[2] for g in counts}) + 1
        self._of: dict[str, float] = {}

    def __call__(self, gram: str) -> float:
        p = self._of.get(gram)
        if p is None:
            low = (self.pair[gram[1:]] + 0.1) / (self.one[gram[1]] + 0.1 * self.size)
            p = self._of[gram] = math.log((self.three.get(gram, 0) + 5 * low) / (self.two[gram[:2]] + 5))
        return p


#: Letters that the model tells apart, those in lower case below U+0250; all others are one class, so its counts are bounded.
ALPHABET = " " + "".join(chr(c) for c in range(0x250) if chr(c).isalpha() and chr(c) == chr(c).lower()) + "�"
_KNOWN = frozenset(ALPHABET)


def _class(c: str) -> str:
    return c if c in _KNOWN else "�"


def grams(word: str):
    s = "  " + "".join(map(_class, word)) + " "
    return (s[i : i + 3] for i in range(len(s) - 2))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """The ways to read each sign or run of a token, with the channel's log-probabilities."""
    out, i = [], 0
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        if c.isalpha():
            ways = [(c * n, 0.0 if n == j - i else SHORTER) for n in ([1, 2, j - i] if j - i > 2 else [j - i])]
        else:
            ways = [(x * n, AS_LETTER * n) for x in SIGNS.get(c, "") for n in {1, j - i}] + [("", AS_SIGN * (j - i))]
        out.append(ways)
        i = j
    return out


def restore(token: str, model: CharModel) -> str:
    """The likeliest word behind a token, by the Viterbi algorithm over its lattice; states are the last two letters."""
    best = {"  ": (0.0, "")}
    for ways in lattice(token):
        step: dict[str, tuple[float, str]] = {}
        for state, (score, word) in best.items():
            for text, cost in ways:
                s, ctx = score + cost, state
                for c in text:
                    c = _class(c)
                    s += model(ctx + c)
                    ctx = ctx[1] + c
                if ctx not in step or s > step[ctx][0]:
                    step[ctx] = s, word + text
        best = step
    return max((s + model(state + " "), word) for state, (s, word) in best.items())[1]


def _names(word: str):
    yield word
    for n in STEMS:
        if len(word) >= n:
            yield word[:n] + "*"


def readings(token: str, model: CharModel) -> list[str]:
    """Words of a token in lower case: as written and, if it is in disguise, restored."""
    if token.isalpha() and token.isascii() and not _DISGUISED.search(token):
        return [token]
    out = _LETTERS.findall(token)
    joined = _BETWEEN.sub("", token) if _SPACED.match(token) else token
    if joined is not token or _DISGUISED.search(token):
        core = joined.strip("\"'()[]{}<>.,;:?*&#%~_-")
        for way in {core, core.rstrip("!1|+$")}:
            if way:
                out += _LETTERS.findall(restore(way, model))
    return out


def names(token: str, model: CharModel) -> set[str]:
    """Features of a token: its words and their beginnings."""
    return {f for w in readings(token, model) for f in _names(w)}


def tokens(text: str) -> set[str]:
    """A text's tokens in lower case, and the runs of three or more signs that stand alone, as one token with spaces."""
    own = text.lower().split()
    out, run = set(own), []
    if sum(1 for t in own if len(t) == 1) >= 3:
        for t in [*own, "  "]:
            if len(t) == 1:
                run.append(t)
                continue
            if len(run) >= 3:
                out.add(" ".join(run))
            run = []
    return out


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def characters(docs: DataFrame) -> dict[str, int]:
    """Trigrams of the letters of all words of the whole corpus, words framed as in grams()."""
    import numpy as np
    import pyarrow as pa

    size = len(ALPHABET)

    def count(batches):
        place = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            if chr(c).isalpha():
                place[c] = size - 1
        for k, c in enumerate(ALPHABET):
            place[ord(c)] = k
        total = np.zeros(size**3, np.int64)
        for b in batches:
            text = " ".join(t for t in b.column(0).to_pylist() if t).lower()
            x = place[np.frombuffer(f" {text} ".encode("utf-32-le"), "<u4")]
            x = x[np.concatenate(([True], (x[1:] > 0) | (x[:-1] > 0)))]
            x = np.repeat(x, np.where(x == 0, 2, 1)).astype(np.int64)
            y, z = x[1:-1], x[2:]
            g = (x[:-2] * size + y) * size + z
            np.add.at(total, g[(y > 0) | (z > 0)], 1)
        at = np.flatnonzero(total)
        names = [ALPHABET[g // size // size] + ALPHABET[g // size % size] + ALPHABET[g % size] for g in at.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(total[at])], ["g", "n"])

    return {r[0]: r[1] for r in common.collect(docs.select("text").mapInArrow(count, "g string, n bigint").groupBy("g").agg(F.sum("n")))}


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, y) to fit on: at most SAMPLE of each label, never of held-out rows."""
    marked = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    there = docs.select("doc_id").distinct()
    marked = marked.filter(~held_out()).join(there, "doc_id", "left_semi")
    picked = None
    for y, n in SAMPLE.items():
        own = marked.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = own if picked is None else picked.union(own)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y")


def _of_texts(model: CharModel, texts, within=None):
    """The features of each text, those of ``within`` only if it is given. What tokens say is remembered, up to a bound."""
    known: dict[str, tuple] = {}
    for text in texts:
        own: set[str] = set()
        for t in tokens(text or ""):
            hit = known.get(t)
            if hit is None:
                if len(known) > REMEMBERED:
                    known.clear()
                hit = known[t] = tuple(f for f in names(t, model) if within is None or f in within)
            own.update(hit)
        yield own


def fitted(rows: DataFrame, model: CharModel) -> tuple[float, dict[str, float]]:
    """Bias and weights from the bounded sample. Features are counted where the texts lie; one task fits the weights.

    Only features that enough toxic texts of the sample have are looked at, so what meets in a task or at the driver is a
    list of their numbers for each text, never a text.
    """
    import numpy as np
    import pyarrow as pa

    spark = rows.sparkSession
    kept = common.keep(rows.select("text", "y"), "sample")
    sent = spark.sparkContext.broadcast(model.three)

    def count(batches):
        own: Counter = Counter()
        of = CharModel(sent.value)
        for b in batches:
            for names_of in _of_texts(of, b.column(0).to_pylist()):
                own.update(names_of)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array(list(own.values()), pa.int64())], ["feature", "n"])

    n1 = kept.filter("y = 1").count()
    often = kept.filter("y = 1").select("text").mapInArrow(count, "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    found = sorted((r["feature"], r["n"]) for r in common.collect(often.filter(F.col("n") >= max(2, 0.002 * n1))))
    place = spark.sparkContext.broadcast({f: k for k, (f, _) in enumerate(found)})

    def number(batches):
        of, within = CharModel(sent.value), place.value
        for b in batches:
            sets = [np.array(sorted(within[f] for f in own), "<i4").tobytes() for own in _of_texts(of, b.column(0).to_pylist(), within)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(sets, pa.binary())], ["y", "own"])

    def run(batches):
        own = sorted((y, raw) for b in batches for y, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        bias, weights = fit([y for y, _ in own], [np.frombuffer(raw, "<i4") for _, raw in own], len(found))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *weights], pa.int64()), pa.array([bias, *weights.values()], pa.float64())], ["k", "weight"])

    numbered = kept.mapInArrow(number, "y int, own binary").repartition(1).mapInArrow(run, "k bigint, weight double")
    out = {r["k"]: r["weight"] for r in common.collect(numbered)}
    common.drop(kept)
    return out.pop(-1, -8.0), {found[k][0]: w for k, w in out.items()}


def fit(ys: list[int], sets: list, size: int) -> tuple[float, dict[int, float]]:
    """Bias and weights of a logistic model over features, numbered below size, that are much likelier under label 1."""
    import numpy as np

    y = np.array(ys, float)
    n1, n0 = y.sum(), (1 - y).sum()
    if not n1 or not n0:
        return (-8.0 if not n1 else 8.0), {}
    at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    of = np.concatenate(sets).astype(np.int64)
    toxic, other = np.bincount(of, y[at], size), np.bincount(of, 1 - y[at], size)
    ratio = np.log((toxic + 0.5) / (n1 + 1)) - np.log((other + 0.5) / (n0 + 1))
    chosen = np.flatnonzero(ratio > 2)
    place = np.full(size, -1)
    place[chosen] = np.arange(len(chosen))
    at, of = at[place[of] >= 0], place[of][place[of] >= 0]
    prior = math.log(n1 / n0)
    w, bias, moved, moved_b = 0.5 * ratio[chosen], -2.0, np.zeros(len(chosen)), 0.0
    for _ in range(300):
        z = np.clip(bias + np.bincount(at, w[of], len(y)), -30, 30)
        e = 1 / (1 + np.exp(-z)) - y
        g = np.bincount(of, e[at], len(chosen)) + 0.5 * w
        moved, moved_b = 0.9 * moved + g, 0.9 * moved_b + e.sum()
        w = np.maximum(0, w - 0.5 * moved / (10 + n1))
        bias -= 0.5 * moved_b / (10 + len(y))
    return float(min(bias, prior, -1.0)), {int(k): float(v) for k, v in zip(chosen, w) if v > 1e-3}


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds held_out, score and predicted to (doc_id, text). The model is fitted here; labels are read of rows not held out only.

    The classifier is fitted on at most SAMPLE labelled documents of each label, and uses every word and beginning of theirs
    that is much likelier under label 1; the character model counts the whole corpus. Null and empty texts get the score of a text without evidence. Without labels of both kinds the score is constant:
    near 1 if all are toxic, else near 0. Equal texts score alike. An empty table gives no rows.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    model = CharModel(characters(docs))
    bias, weights = fitted(sample(docs, labels), model)
    sent = spark.sparkContext.broadcast((model.three, bias, weights))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        three, bias, weights = sent.value
        model, known = CharModel(three), {}
        for b in common.sliced(batches):
            scores = []
            for text in b.column(1).to_pylist():
                own: set[str] = set()
                for t in tokens(text or ""):
                    hit = known.get(t)
                    if hit is None:
                        if len(known) > REMEMBERED:
                            known.clear()
                        hit = known[t] = tuple({f for w in readings(t, model) for f in (w, *[w[:n] + "*" for n in STEMS if n <= len(w)]) if f in weights})
                    if hit:
                        own.update(hit)
                z = bias + sum(weights[f] for f in sorted(own))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(scores, pa.float64())], ["doc_id", "text", "held_out", "score"])

    rows = docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, f"doc_id {kind}, text string, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, labels).select("doc_id", "held_out", "score", "predicted")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, as they are."""
    bad = digest(docs, labels).filter("predicted = 1").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]), "left_anti")
