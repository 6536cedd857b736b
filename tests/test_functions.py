import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates, legal, names, numbers, similarity, text

C = F.col


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in sorted(rows.select("i", expr(C("x")).alias("y")).collect())]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_names(spark):
    assert column(spark, ["DOE JR.", "Doe, III", "O'TEST", "TEST-CASE", "José ", "", None, "JR", "SMITH  JONES IV"], names.cleaned) == ["DOE", "DOE", "OTEST", "TEST-CASE", "JOSÉ", "", "", "", "SMITH JONES"]
    assert column(spark, ["JANE DOE", "DOE FAMILY TRUST", "LLC", "", None, "JOHN DOE V", "JOHN DOE JR.", "JOHN DOE JR", "V"], names.surname) == ["DOE", "FAMILY", "LLC", "", "", "DOE", "JR.", "DOE", "V"]
    who = spark.createDataFrame([(1, "Doe  Jr", "John Q"), (2, "DOE JR.", "JOHN"), (3, "O'Test-Case, III", None), (4, "Jr", "x"), (5, None, "Ann"), (6, "Doe VI", " "), (7, "Lee (x)", "MARY, ANN")], "i int, l string, f string")
    assert [r[0] for r in who.orderBy("i").select(names.searched(C("l"), C("f"))).collect()] == ["DOE JOHN", "DOE JOHN", "O'TEST-CASE", "JR X", "ANN", "DOE", "LEE MARY"]
    long = "IN THE MATTER OF " + "Ab " * 6000 + "Zed"
    assert len(column(spark, [long], lambda x: names.decedent(x)["first"])[0]) == 6000 * 3 - 1
    assert column(spark, ["DOE JANE", "DOE HOLDINGS LLC", "", "DOE FAMILY TRUST"], names.owner_surname) == ["DOE", "HOLDINGS", "", "FAMILY"]
    assert column(spark, ["DOE JANE", "ACME LLC", "TEST CO", "TEST CO LIMITED", " ", None, "INCA DOE", "THE EST OF DOE", "DOE EST"], names.is_person) == [True, False, True, False, False, False, True, False, True]
    assert column(spark, ["Bob", "ROBERT", "NOBODY", None, "PAT"], names.nickname_variants) == [["BERT", "ROB", "ROBBIE", "ROBBY", "ROBERT"], ["BERT", "BOB", "ROB", "ROBBIE", "ROBBY"], [], [], ["PATRICIA", "PATTY", "TRICIA", "TRISH"]]
    assert column(spark, ["DOE JANE ANN", "DOE", "", None], lambda x: F.concat_ws("|", names.party(x)["last"], names.party(x)["first"])) == ["DOE|JANE ANN", "DOE|", "|", "|"]
    got = column(spark, ["IN THE ESTATE OF: JANE Q DOE, DECEASED", "Estate of Jane Doe Deceased", "IN THE GUARDIANSHIP OF JANE DOE JR.", "", None, "x"], lambda x: F.concat_ws("|", names.decedent(x)["first"], names.decedent(x)["last"]))
    assert got == ["Jane Q|Doe", "Jane|Doe", "Jane|Doe", "|", "|", "|"]


def test_addresses(spark):
    cases = {"1 A ST, CITY, TX 77001": "TX", "1 A ST CITY OK 73301-1234": "OK", "1 A ST CITY LA": "LA", "1 MAIN ST 12345": "UNKNOWN", "1 A ST CITY CT 06001": "UNKNOWN", "1 A ST, CITY, CT 06001": "CT", "1 a rd city zz 00000": "ZZ", "": "UNKNOWN", None: "UNKNOWN"}
    assert column(spark, list(cases), text.state_of) == list(cases.values())
    assert column(spark, ["TX", "UNKNOWN", "ZZ"], text.valid_state) == ["TX", "UNKNOWN", "FOREIGN"]
    assert column(spark, ["TX", "OK", "CA", "ZZ", "UNKNOWN"], text.location_type) == ["SAME_STATE", "NEARBY_STATE", "US_OTHER", "FOREIGN", "UNKNOWN"]
    assert column(spark, ["Foundation Type:", " Cost / Design ", "(A) b-c", None], text.label_key) == ["foundation_type", "cost_design", "a_b_c", ""]


def test_numbers_and_dates(spark):
    assert column(spark, ["$1,234.50", "Pending", "", "n/a", "-5", None], numbers.currency) == [1234.5, None, None, None, -5.0, None]
    assert column(spark, ["due 1,200.5 or 7", "none", "-.5x", None], numbers.first_number) == [1200.5, None, -0.5, None]
    assert [None if v is None else int(v) for v in column(spark, ["85.5", "-2.5", "C-", None], numbers.whole)] == [86, -3, None, None]
    assert column(spark, [0.5, 1.5, 2.5], numbers.half_even, "double") == [0.0, 2.0, 2.0]
    assert [str(d) for d in column(spark, ["06/01/2025", "2025-06-01", "06-01-2025", "2025/06/01", "13/45/2020", "", None], dates.parse)] == ["2025-06-01"] * 4 + ["None"] * 3


def test_legal(spark):
    assert column(spark, ["", "6-8", "8-6", "5,6,7", "5 & 6", ",", "10A", None], legal.lots) == [[""], ["6", "7", "8"], ["8-6"], ["5", "6", "7"], ["5", "6"], [""], ["10A"], [""]]
    assert column(spark, ["5.0", "5.5", "10a", "", None], legal.plain_lot) == ["5", "5.5", "10A", "", ""]
    p = column(spark, ["Desc: TEST ACRES Lot: 5 Block: 7 Sec: 2 Related Docs", "no labels", None], lambda x: F.concat_ws("|", *[legal.parse(x)[k] for k in ("description", "lot", "block", "sec")]))
    assert p == ["TEST ACRES|5|7|2", "no labels|||", "|||"]
    got = column(spark, ["Grantor: DOE JANE Grantee: LEE BOB GTR: POE", "", None], lambda x: F.to_json(legal.parties(x)))
    assert got[0].count("Grantor") == 2 and got[1] == got[2] == "[]"


def test_similarities_against_a_table(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("abc d") for _ in range(rng.choice([0, 1, 5, 12, 70]))), "".join(rng.choice("abc d") for _ in range(rng.choice([0, 1, 6, 13, 75])))) for _ in range(200)] + [("", ""), ("x", "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", similarity.common_length(C("a"), C("b")).alias("n"), similarity.ratio(C("a"), C("b")).alias("r")).collect():
        assert r["n"] == lcs(r["a"], r["b"])
        assert r["r"] == (100.0 if not r["a"] + r["b"] else pytest.approx(200 * r["n"] / (len(r["a"]) + len(r["b"]))))
    got = spark.createDataFrame([("DOE JANE", "JANE DOE"), ("DOE", "DOE FAMILY"), ("", "x"), (None, "x"), ("A B", "A C")], "a string, b string").select(similarity.token_set_ratio(C("a"), C("b"))).collect()
    assert [r[0] for r in got[:4]] == [100.0, 100.0, 0.0, None] and got[4][0] == pytest.approx(200 / 3)
    got = spark.createDataFrame([("ACRES", "1 TEST ACRES DR"), ("", ""), ("", "x"), ("abcd", "xxab")], "a string, b string").select(similarity.partial_ratio(C("a"), C("b"))).collect()
    assert [r[0] for r in got[:3]] == [100.0, 100.0, 0.0] and got[3][0] == pytest.approx(200 * 2 / 6)


def test_similarities_are_symmetric_and_bounded(spark):
    rng = random.Random(2)
    make = lambda: "".join(rng.choice("ab c") for _ in range(rng.randint(0, 9)))
    pairs = [(make(), make()) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for f in (similarity.ratio, similarity.token_set_ratio, similarity.partial_ratio):
        for r in df.select(f(C("a"), C("b")).alias("p"), f(C("b"), C("a")).alias("q")).collect():
            assert r["p"] == pytest.approx(r["q"]) and -1e-9 <= r["p"] <= 100 + 1e-9


def test_common_subsequences_over_several_words(spark):
    """Lengths about the ends of words, signs beyond the basic plane, carries through full words."""
    rng = random.Random(9)
    pairs = [("x" * n, "x" * m) for n in (61, 62, 122, 123, 183) for m in (61, 200, 300)]
    for n in (1, 60, 61, 62, 121, 122, 123, 184, 300):
        for alphabet in ("ab", "abcdefgh 😀é"):
            make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
            pairs += [(make(n), make(rng.randint(1, 320))), (make(n), make(n))]
    pairs += [("", "x" * 70), ("y" * 70, "x" * 90), (None, "x" * 70), ("ab" * 100, "ba" * 100)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r.i: r.n for r in df.select("i", similarity.common_length(F.col("a"), F.col("b")).alias("n")).collect()}
    assert [got[i] for i in range(len(pairs))] == [None if a is None or b is None else lcs(a, b) for a, b in pairs]
