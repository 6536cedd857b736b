"""That the character model tells all Latin letters apart, and the bound of the fit."""

from ledgerline.llm import toxicity

from .fixtures import docs


def test_letters_below_u0250_are_told_apart(spark):
    got = toxicity.characters(docs(spark, ["ŁÓDŹ łódź", "žluť ɏ", "жук", None]))
    assert got["łód"] == 2 and got["ódź"] == 2 and got["  ž"] == 1 and got["uť "] == 1 and got[" ɏ "] == 1 and got["���"] == 1
    want: dict = {}
    for w in "łódź łódź žluť ɏ жук".split():
        for g in toxicity.grams(w):
            want[g] = want.get(g, 0) + 1
    assert got == want


def test_bound_of_the_fit(spark):
    texts = [f"text {i}" for i in range(15000)]
    labels = spark.createDataFrame([(i + 1, i % 3 == 0) for i in range(15000)], "doc_id bigint, toxic boolean")
    n = {r["y"]: r["count"] for r in toxicity.sample(docs(spark, texts), labels).groupBy("y").count().collect()}
    assert 3500 < n[1] <= 4000 and 7500 < n[0] <= 8000
