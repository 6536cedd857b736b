"""Recognition of persons in texts: a sequence tagger, an averaged structured perceptron that is decoded by Viterbi.

The model is a table of weights for pairs of a feature and a tag, features by hash, and for pairs of tags. Learning goes in
rounds of parameter mixing: each partition learns from its own texts, one after another, beginning with the weights of the
round before; what partitions have learnt is summed by weight and divided by their number. So the texts stay where they
lie, and what moves is bounded by the size of the table, however many texts there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions import similarity
from ledgerline.sources import files

#: Outside a name, its first word, a later one.
TAGS = ("O", "B", "I")
#: Hashed features; the tags before a word are features of their own, after these, the last one the start.
SIZE = 1 << 16
ROUNDS, SHARDS = 5, 16


def shape(word: str) -> str:
    """Kinds of signs, runs made one: Test-Case is Xx-Xx."""
    out = []
    for c in word:
        k = "X" if c.isupper() else "x" if c.islower() else "d" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def features(words: list[str]) -> list[list[int]]:
    """Hashed features of each word: itself, its ends, its shape, where it stands, and its neighbours."""
    low = ["<s>", "<s>", *[w.lower() for w in words], "</s>", "</s>"]
    shapes = ["<s>", *map(shape, words), "</s>"]
    out = []
    for i, w in enumerate(words):
        at = i + 2
        own = [
            "bias", f"w={low[at]}", f"s3={low[at][-3:]}", f"p2={low[at][:2]}", f"k={shapes[i + 1]}", f"k-1={shapes[i]}", f"k+1={shapes[i + 2]}", f"w-1={low[at - 1]}", f"w+1={low[at + 1]}",
            f"w-2={low[at - 2]},{low[at - 1]}", f"k2={shapes[i]},{shapes[i + 1]}", f"end={w[-1:]}", f"first={i == 0}", f"last={i == len(words) - 1}",
        ]
        out.append([zlib.crc32(f.encode()) % SIZE for f in own])
    return out


def decode(emissions: np.ndarray, moves: np.ndarray) -> list[int]:
    """The best path of tags. emissions: word x tag; moves: (tag before, or the start last) x tag. Of equal ones the least tags, from the end on.

    A name does not begin with a later word: I follows B or I alone.
    """
    n, k = emissions.shape
    moves = moves.copy()
    moves[[0, k], TAGS.index("I")] = -np.inf
    score, back = moves[k] + emissions[0], np.zeros((n, k), np.int64)
    for i in range(1, n):
        each = score[:, None] + moves[:k]
        back[i] = each.argmax(0)
        score = each.max(0) + emissions[i]
    path = [int(score.argmax())]
    for i in range(n - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    return path[::-1]


@dataclass(frozen=True)
class Model:
    """weights: (SIZE + tags + 1) x tags, the last rows by the tag before."""

    weights: np.ndarray

    def tags(self, words: list[str]) -> list[int]:
        if not words:
            return []
        return decode(np.stack([self.weights[f].sum(0) for f in features(words)]), self.weights[SIZE:])

    def persons(self, words: list[str]) -> list[str]:
        """Runs of words that are tagged as a name, without signs at their ends."""
        out: list[list[str]] = []
        for w, t in zip(words, self.tags(words)):
            if t == 1:
                out.append([w])
            elif t == 2 and out:
                out[-1].append(w)
        runs = [" ".join(r).strip(" ,.;:()") for r in out]
        return [r for r in runs if r]


def _learn(rows: Iterable[tuple], start: np.ndarray) -> np.ndarray:
    """One pass of the structured perceptron over (words, tags[, times]) from given weights: the average of the weights after each text.

    Copies of a text follow each other; once it is tagged rightly the others of it change nothing, and count at once.
    """
    w, total, steps = start.copy(), np.zeros_like(start), 0
    since = np.zeros(len(start), np.int64)

    def add(row: int, tag: int, by: float) -> None:
        # The average is kept by row, brought up to date only when the row changes.
        total[row] += w[row] * (steps - since[row])
        since[row] = steps
        w[row, tag] += by

    for words, tags, *more in rows:
        found, times = features(words), more[0] if more else 1
        while times:
            guess = decode(np.stack([w[f].sum(0) for f in found]), w[SIZE:])
            if guess == tags:
                steps += times
                break
            before, before_guess = len(TAGS), len(TAGS)
            for f, t, g in zip(found, tags, guess):
                if t != g:
                    for x in f:
                        add(x, t, 1.0)
                        add(x, g, -1.0)
                if (before, t) != (before_guess, g):
                    add(SIZE + before, t, 1.0)
                    add(SIZE + before_guess, g, -1.0)
                before, before_guess = t, g
            steps += 1
            times -= 1
    total += w * (steps - since)[:, None]
    return total / max(steps, 1)


def fit(texts: DataFrame, words: str = "words", tags: str = "tags", rounds: int = ROUNDS, shards: int = SHARDS, times: str | None = None) -> Model:
    """A model from texts as lists of words and of tags (names of TAGS). times: a column with how often a row stands for its text, once without it.

    Texts are dealt to shards by a hash of their words, so learning does not hang on how the table lies; equal texts go to
    one shard, each as often as it comes, and copies that fill a shard weigh no more than it does. Rows without words, or
    with fewer tags than words or a tag that is null or unknown, are left out. Without any text all weights are 0. The
    driver holds the table of weights: SIZE x tags numbers, of which a round gathers those that have changed.
    """
    import pyarrow as pa

    # Words and tags may be costly to make, and every round reads them; copies are one row with their number.
    own = texts.select(F.col(words).alias("words"), F.col(tags).alias("tags"), (F.col(times) if times else F.lit(1)).cast("long").alias("times"))
    kept = files.kept(own.groupBy("words", "tags").agg(F.sum("times").alias("times")), "tagged")
    sound = (F.size("words") > 0) & (F.size("words") == F.size("tags")) & F.forall("tags", lambda t: t.isNotNull() & t.isin(*TAGS)) & F.forall("words", lambda w: w.isNotNull())
    hashed = F.xxhash64("words")
    dealt = kept.filter(sound).select("words", "tags", F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"), "times", hashed.alias("h")).repartition(shards, "shard").sortWithinPartitions("shard", "h", "tags")
    weights = np.zeros((SIZE + len(TAGS) + 1, len(TAGS)))
    schema = "feature int, " + ", ".join(f"t{k} double" for k in range(len(TAGS)))

    def run(start):
        def of(batches):
            rows = ((shard, (own, [TAGS.index(t) for t in names], n)) for b in batches for own, names, shard, n in zip(*(b.column(i).to_pylist() for i in range(4))))
            for _, own in groupby(rows, key=lambda r: r[0]):
                changed = _learn((r for _, r in own), start) - start
                at = np.flatnonzero(np.abs(changed).sum(1))
                # One row more says that a shard has learnt: feature -1.
                yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), *[pa.array(np.append(changed[at, k], 1.0)) for k in range(len(TAGS))]], ["feature", *[f"t{k}" for k in range(len(TAGS))]])

        return of

    for _ in range(rounds):
        sums = dealt.mapInArrow(run(weights), schema).groupBy("feature").agg(*[F.sum(f"t{k}").alias(f"t{k}") for k in range(len(TAGS))]).collect()
        learnt = max((r["t0"] for r in sums if r["feature"] == -1), default=0)
        if not learnt:
            break
        for r in sums:
            if r["feature"] >= 0:
                weights[r["feature"]] += [r[f"t{k}"] / learnt for k in range(len(TAGS))]
    return Model(weights)


def tagged(text: Column, names: list[Column]) -> tuple[Column, Column]:
    """(words, tags) of a text in which some names are known: the words of a name where they stand, next to each other, are tagged.

    For training: of a name that comes twice the first place counts; blank names and those that are not there tag nothing.
    """
    split = lambda x: F.filter(F.split(F.trim(x), r"\s+"), lambda w: w != "")
    words = split(text)
    bare = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"^[\s,.;:()]+|[\s,.;:()]+$", "")))

    def first(v: Column) -> Column:
        """Where a name's words begin among the text's; 0 where they do not stand there."""
        n = F.size(v["own"])
        fits = F.filter(F.sequence(F.lit(1), F.greatest(F.size(v["bare"]) - n + 1, F.lit(1))), lambda i: (n > 0) & (F.slice(v["bare"], i, n) == v["own"]))
        return F.struct(F.coalesce(F.get(fits, 0), F.lit(0)).alias("at"), n.alias("n"))

    tags = F.transform(words, lambda w: F.lit("O"))
    for name in names:
        # Bound once: a lambda would take the text apart anew for each place.
        own = F.struct(bare.alias("bare"), split(F.lower(F.coalesce(name, F.lit("")))).alias("own"))
        place = similarity.let(own, first)
        tags = similarity.let(F.struct(tags.alias("tags"), place.alias("p")), lambda v: F.when(v["p"]["at"] > 0, F.transform(v["tags"], lambda t, i: F.when(i == v["p"]["at"] - 1, "B").when((i >= v["p"]["at"]) & (i < v["p"]["at"] + v["p"]["n"] - 1), "I").otherwise(t))).otherwise(v["tags"]))
    return words, tags


def recognised(df: DataFrame, text: str, model: Model, name: str = "person") -> DataFrame:
    """Adds the longest person that the model finds in a text, of equal ones the first; empty where it finds none or the text is null. Rows are independent."""
    import pyarrow as pa

    schema = StructType([*[f for f in df.schema.fields if f.name != name], StructField(name, StringType())])

    def run(batches):
        seen: dict[str, str] = {}
        for b in batches:
            own = []
            for t in b.column(b.schema.get_field_index(text)).to_pylist():
                t = t or ""
                if t not in seen:
                    if len(seen) >= 1 << 14:
                        seen.clear()
                    seen[t] = max(model.persons(t.split()), key=len, default="")
                own.append(seen[t])
            keep = [i for i, f in enumerate(b.schema.names) if f != name]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(own, pa.string())], [*[b.schema.names[i] for i in keep], name])

    return df.mapInArrow(run, schema)
