import pytest
from pyspark.sql import Observation
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline.operators import catalog


@pytest.fixture
def table(spark, tmp_path):
    spark.sql(f"CREATE TABLE described (a BIGINT COMMENT 'key', b DOUBLE, c STRING, d DATE) USING parquet LOCATION '{tmp_path}/t' TBLPROPERTIES ('tests.a' = \"['not_null', 'unique']\", 'tests.c' = \"['accepted:x,y']\")")
    yield "described"
    spark.sql("DROP TABLE described")


def test_metadata(spark, table):
    got = {r.column_name: (r.data_type, r.is_nullable, r.description, r.custom_tests) for r in catalog.metadata(spark, table).collect()}
    assert got == {"a": ("bigint", False, "key", ["unique"]), "b": ("double", True, None, []), "c": ("string", True, None, ["accepted:x,y"]), "d": ("date", True, None, [])}
    spark.createDataFrame([], StructType([StructField("a", LongType(), False), StructField("b", StringType(), True)])).createOrReplaceTempView("a_view")
    assert {r.column_name: r.is_nullable for r in catalog.metadata(spark, "a_view").collect()} == {"a": False, "b": True}


ROWS = [("1", "2.5", "x", 1), ("1", "no", "z", 2), (None, None, None, 3), ("q", "1e3", "y", 4), ("1", "", "x", 5)]
WANT = {("A", "type"): 1, ("A", "not_null"): 1, ("A", "unique"): 2, ("b", "type"): 2, ("c", "type"): 0, ("c", "accepted"): 1, ("d", "present"): 5, ("e_f", "known"): 5}


def test_a_load_counts_what_it_reads_once(spark, table):
    reads = spark.sparkContext.accumulator(0)

    def each(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.createDataFrame(ROWS, "A string, b string, c string, e_f int").mapInArrow(each, "A string, b string, c string, e_f int")
    described = catalog.metadata(spark, table)
    plain = [a for a in catalog.planned(described, df.columns) if a.test != "unique"]
    seen = Observation()
    catalog.observed(df, plain, seen).write.format("noop").mode("overwrite").save()
    assert reads.value == len(ROWS)
    got = {(r.column_name, r.test): r.failures for r in catalog.failures(df, plain, seen).collect()}
    assert reads.value == len(ROWS) and got == {k: v for k, v in WANT.items() if k[1] != "unique"}
    got = {(r.column_name, r.test): r.failures for r in catalog.load(df, table).collect()}
    assert got == WANT
    assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, [r for r in spark.createDataFrame([(1, 2.5, "x", None), (1, None, "z", None), (None, None, None, None), (None, 1000.0, "y", None), (1, None, "x", None)], "a long, b double, c string, d date").collect()]))


def test_empty_frames_and_unknown_tests(spark, table):
    df = spark.createDataFrame([], "a string, b double")
    got = {(r.column_name, r.test): r.failures for r in catalog.failures(df, catalog.planned(catalog.metadata(spark, table), df.columns)).collect()}
    assert set(got.values()) == {0} and ("c", "present") in got and ("a", "unique") in got
    assert catalog.failures(df, []).collect() == []
    odd = spark.createDataFrame([("a", "string", True, None, ["odd"])], catalog.METADATA)
    with pytest.raises(ValueError, match="odd"):
        catalog.planned(odd, ["a"])
