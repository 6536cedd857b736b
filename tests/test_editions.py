import datetime
import json

from pyspark.sql import functions as F

from ledgerline.functions import names
from ledgerline.operators import editions

D = datetime.date
SCHEMA = "rp_file_number string, rp_file_date date, rp_instrument_type string, rp_party_type string, party_last string, party_first string, place int, grantors string"
PARTIES = [
    ("RP-1", D(2020, 1, 5), "DEED", "Grantor", "DOE", "JANE", 2, "x"), ("RP-1", D(2020, 1, 5), "DEED", " grantor ", "ABE", None, 1, "x"), ("RP-1", D(2020, 1, 5), "DEED", "Grantee", "DOE", "JOHN", 3, "x"),
    ("RP-2", D(2020, 2, 1), "W/D", "Trustee", "BANK", "", 1, "x"), ("RP-2", D(2020, 2, 1), "W/D", "Grantor", None, "x", 2, "x"), ("RP-3", None, "W/D", "Grantee", "DOE", "A", 1, "x"), ("RP-4", D(2023, 1, 1), "W/D", "Grantor", "DOE", "", 1, "x"), ("RP-4", D(2023, 1, 1), "W/D", "Grantee", "DOES", "", 2, "x"),
]


def test_records_and_scans(spark):
    df = spark.createDataFrame(PARTIES, SCHEMA)
    got = {r.rp_file_number: [json.loads(r[c]) for c in editions.ROLES.values()] for r in editions.records(df, "place").collect()}
    assert got["RP-1"] == [[{"last": "ABE", "first": ""}, {"last": "DOE", "first": "JANE"}], [{"last": "DOE", "first": "JOHN"}], []]
    assert got["RP-2"] == [[], [], [{"last": "BANK", "first": ""}]] and set(got) == {"RP-1", "RP-2", "RP-3", "RP-4"}
    found = {r.rp_file_number: (r["first"], r["last"]) for r in editions.scanned(df, "place", 1).collect()}
    assert set(found) == {"RP-1", "RP-2", "RP-4"} and len(set(found.values())) == 3
    assert editions.scanned(df.filter("false"), "place").collect() == []


def test_a_last_name_on_both_sides(spark):
    df = spark.createDataFrame(PARTIES, SCHEMA)
    leads = spark.createDataFrame([(" doe", D(2020, 6, 1)), ("DOE", D(2020, 6, 1)), ("", D(2020, 6, 1)), (None, D(2020, 6, 1)), ("BANK", D(2020, 6, 1)), ("DOE", None), ("DOE", D(2023, 12, 1))], "last string, filed date")
    got = sorted((r.searched, r.rp_file_number) for r in editions.by_last_name(leads, df, "place").collect())
    assert got == [("DOE", "RP-1"), ("DOE", "RP-4")]


def test_names_as_earlier_editions_read_them(spark):
    df = spark.createDataFrame([("Estate of Ann B Poe, Deceased", "Jo Lee", None), ("RE: ann poe", "Heirs of Jo Quincy Lee and Bartholomew Featherstonehaugh", None), ("X", None, None), ("Ann Poe", "Jo Lee", "Cy Q Dee"), (None, None, "")], "c string, p string, n string")
    d = names.decedent_by_ends(F.col("c"), F.col("p"), F.col("n"))
    assert [tuple(r) for r in df.select(d["first"], d["last"]).collect()] == [("Ann", "Poe"), ("Jo", "Lee"), ("", ""), ("Cy", "Dee"), ("", "")]
    t = F.lit("Ann Bo Cy and Bartholomew Featherstonehaugh")
    both = spark.range(1).select(names.decedent(F.regexp_replace(t, " and ", " & "))["last"], names.decedent(F.regexp_replace(t, " and ", " & "), by_words=True)["last"]).first()
    assert tuple(both) == ("Featherstonehaugh", "Cy")
