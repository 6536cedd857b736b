import math
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import mixing

from .fixtures import ODD, docs


def corpus(seed, n=120):
    rng = random.Random(seed)
    parts = ["ing", "tion", "er", "un", "re", "el", "ou", "th"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
    return [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(n)]


def plain_words(text):
    return mixing.words(None if text is None else text.encode())


def test_base_scores_and_counts(spark):
    texts = [*ODD, *corpus(1)]
    rows = {r["doc_id"]: r for r in mixing.score(docs(spark, texts)).collect()}
    held = {i + 1: zlib.crc32(str(i + 1).encode()) % 7 == 2 for i in range(len(texts))}
    count: dict = {}
    for i, t in enumerate(texts):
        if not held[i + 1]:
            for w in [*plain_words(t), b""]:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        r, own = rows[i + 1], [*plain_words(t), b""]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i + 1], len(own), sum(w in count for w in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r["score"] < 0 and r["n_bytes"] == len((t or "").encode()) and math.isclose(r["bits_per_byte"], -r["score"] / math.log10(2) / (r["n_bytes"] + 1))
    per_byte = {r["held_out"]: r["bits_per_byte"] for r in mixing.bits_per_byte(mixing.score(docs(spark, corpus(1)))).collect()}
    assert per_byte[True] < 4.5 and per_byte[False] < per_byte[True] + 0.5


def test_bits_are_probabilities():
    """All words of one byte with their ends, and all longer beginnings, sum to one: what is left over is what begins with two."""
    rng = random.Random(2)
    parts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 3))) for _ in range(200)]
    known = sorted(set(parts))
    counts = np.array([parts.count(w) for w in known])
    tables = np.zeros((mixing.SLOTS, 2), np.float32)
    mixing.count(known, counts, tables)
    m = mixing.Mixer(mixing.packed(tables))
    assert m.learn(known, counts) > 0
    signs = [bytes([c]) for c in range(256) if c != 10]
    short = [b"", *signs]
    one = 10 ** m.score(short)
    assert 0 < one.sum() < 1
    assert m.score([b"a"])[0] > m.score([b"\x07"])[0] and m.score([b"abcabcabc"])[0] < m.score([b"a"])[0]
    # The sum over words of up to two bytes stays below one and grows.
    two = 10 ** m.score([a + b for a in (b"a", b"b", b"c") for b in signs])
    assert one.sum() < one.sum() + two.sum() < 1


def test_learning_helps():
    words = [w for t in corpus(3, 200) for w in plain_words(t)]
    known = sorted(set(words))
    counts = np.array([words.count(w) for w in known])
    tables = np.zeros((mixing.SLOTS, 2), np.float32)
    mixing.count(known, counts, tables)
    new = [w for t in corpus(9, 50) for w in plain_words(t)]
    plain = mixing.Mixer(np.zeros(mixing.SLOTS, np.uint32)).score(new).sum()
    m = mixing.Mixer(mixing.packed(tables))
    m.learn(known, counts)
    assert m.score(new).sum() > 0.5 * plain


def test_awkward_tables(spark):
    assert mixing.score(docs(spark, [])).collect() == []
    held = next(i for i in range(99) if mixing.is_held_out(i))
    row = mixing.score(docs(spark, [(held, "nothing to learn from")])).collect()[0]
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0) and row["score"] < 0
    rows = mixing.score(docs(spark, [(5, "twice"), (5, "twice"), (None, None)])).collect()
    assert len(rows) == 3 and len({r["score"] for r in rows if r["doc_id"] == 5}) == 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_pipeline(spark, sf, tmp_path):
    """Stage after stage on its predecessor's rows; what each must do is checked against its own operator's brute force elsewhere."""
    import os

    if not os.path.isdir(sf):
        pytest.skip("no test data")
    import corpus_pipeline
    from pyspark.sql import functions as F

    docs_ = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs_.columns, docs_.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs_, sf)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert out.columns == columns and out.count() <= n and out.count() > 0.5 * n
            assert out.count() == out.select("doc_id").distinct().count()
        else:
            assert out.select("doc_id").distinct().count() == docs_.count()
            assert out.groupBy("sequence_id").agg(F.sum("length").alias("s")).filter("s > 1024").isEmpty()
        docs_ = out
    rows = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, sf)) == rows(docs_)
