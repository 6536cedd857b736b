"""The pipeline against brute force on a small table, given what the classifier predicts."""

import random

import corpus_pipeline
from ledgerline.llm import common, pii, toxicity

from .fixtures import docs
from .test_jaccard import brute
from .test_texts import brute_hits


def test_run_keeps_and_blanks_what_brute_force_does(spark, tmp_path):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(1, prose(20)), (2, prose(14))]
    plain = [prose(40) for _ in range(25)]
    texts = [
        *plain, *plain[:4], plain[5] + " tail", plain[6] + " more words", plain[7] + " " + prose(40),
        *(prose(20) + " " + t + " " + prose(20) for _, t in items), prose(400) + " " + items[0][1],
        *(prose(20) + f" {x} " + prose(20) for x in ("ann@mail.example.org", "10.20.30.40", "4111 1111 1111 1111", "+1 212 555 0100")),
        *("vile scum " + prose(15) for _ in range(20)),
    ]
    docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i + 1, t.startswith("vile")) for i, t in enumerate(texts)], "doc_id bigint, toxic boolean").write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)
    table = lambda name: common.table(spark, sf, name)
    toxic = {r["doc_id"] for r in toxicity.digest(table("documents"), table("labels")).filter("predicted = 1").collect()}
    left = {i + 1: t for i, t in enumerate(texts) if i + 1 not in toxic}
    left = {d: left[d] for d, (_, c) in brute(left).items() if c == d}
    near = len(texts) - len(toxic) - len(left)
    clean = {d: t for d, t in left.items() if not brute_hits(t, items)[4]}
    assert toxic and near >= 4 and len(clean) < len(left)
    got = table("documents")
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = common.keep(stage(spark, got, sf), "brute")
    got = {r["doc_id"]: r["text"] for r in got.collect()}
    assert set(got) == set(clean)
    for d, t in clean.items():
        spans = pii.base(t)
        assert not pii.base(got[d]) and all(t[s:e] not in got[d] for _, s, e in spans)
        assert got[d] == (pii.blank(t, spans) if spans or not any(c.isdigit() or c == "@" for c in t) else got[d])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()} == set(clean)
