import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from strata.functions.scalar import floor_days, tolerant_number, tolerant_timestamp
from strata.operators.standardise import dedup_text, fill_defaults, normalise_names
from strata.sources.raw import read_raw_csv


def test_raw_csv_na_tokens_bom_and_blanks(spark, tmp_dir):
    path = f"{tmp_dir}/t.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write('\ufeffa,b\n1,""\nNA,x\n"NA",None\n,null\n00123, z \n')
    df = read_raw_csv(spark, path)
    assert df.columns == ["a", "b", "_seq"]
    got = [(r["a"], r["b"]) for r in df.orderBy("_seq").collect()]
    assert got == [("1", None), (None, "x"), (None, None), (None, None), ("00123", " z ")]


def test_raw_csv_sequence_follows_file_order(spark, tmp_dir):
    path = f"{tmp_dir}/s.csv"
    with open(path, "w") as f:
        f.write("k\n" + "\n".join(str(i) for i in range(200)) + "\n")
    df = read_raw_csv(spark, path)
    got = [int(r["k"]) for r in df.orderBy("_seq").collect()]
    assert got == list(range(200))


def test_tolerant_number(spark):
    vals = [" 12 ", "1e3", "inf", "0x1F", "1d", "1,000", "bad", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = df.select("i", tolerant_number("v", T.DoubleType()).alias("n")).orderBy("i")
    got = [r["n"] for r in out.collect()]
    assert got == [12.0, 1000.0, float("inf"), None, None, None, None, None]
    filled = fill_defaults(out.select("n"))
    assert [r["n"] for r in filled.collect()] == [12.0, 1000.0, float("inf"), 0, 0, 0, 0, 0]


def test_tolerant_number_integer_and_decimal(spark):
    df = spark.createDataFrame([("3",), ("3.0",), ("3.5",), ("x",)], "v string")
    ints = [r[0] for r in df.select(tolerant_number("v", T.IntegerType())).collect()]
    assert ints == [3, 3, None, None]
    decs = [r[0] for r in df.select(tolerant_number("v", T.DecimalType(18, 2))).collect()]
    assert [str(d) if d is not None else None for d in decs] == ["3.00", "3.00", "3.50", None]


def test_tolerant_timestamp(spark):
    vals = ["2018-01-01 10:00:00", "2018-01-02", "bad", None, "2018-01-03T04:05:06"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r["t"] for r in df.select("i", tolerant_timestamp("v").alias("t")).orderBy("i").collect()]
    assert got == [dt.datetime(2018, 1, 1, 10), dt.datetime(2018, 1, 2), None, None, None]
    assert isinstance(df.select(tolerant_timestamp("v").alias("t")).schema["t"].dataType,
                      T.TimestampNTZType)


def test_floor_days(spark):
    pairs = [("2018-01-01 10:00:00", "2018-01-01 12:00:00"),
             ("2018-01-05 10:00:00", "2018-01-03 12:00:00"),
             ("2018-01-02 01:00:00", "2018-01-01 23:00:00"),
             (None, "2018-01-01 00:00:00")]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    got = [r[0] for r in df.select(floor_days("a", "b")).collect()]
    assert got == [-1, 1, 0, None]


def test_text_dedup_before_cast(spark):
    df = spark.createDataFrame([("1",), ("1",), ("1.0",)], "num string")
    d = dedup_text(df)
    assert d.count() == 2
    cast = d.select(tolerant_number("num", T.DoubleType()).alias("n"))
    assert sorted(r["n"] for r in cast.collect()) == [1.0, 1.0]


def test_fill_defaults_keeps_null_dates(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, n double, t timestamp_ntz")
    r = fill_defaults(df).first()
    assert (r["s"], r["n"], r["t"]) == ("Unknown", 0.0, None)


def test_normalise_names(spark):
    df = spark.createDataFrame([(1, 2)], "` A ` int, b int")
    assert normalise_names(df).columns == ["a", "b"]
    import pytest
    with pytest.raises(ValueError):
        normalise_names(spark.createDataFrame([(1, 2)], "`A` int, `a ` int"))


def test_local_frame_types_nulls_and_empty(spark):
    import datetime as dt
    from strata.sources.local import local_frame
    df = local_frame(spark, [(1, "a", None), (2, None, dt.datetime(2024, 1, 2, 3))],
                     "id long, s string, ts timestamp_ntz")
    assert [f.simpleString() for f in df.schema.fields] == ["id:bigint", "s:string", "ts:timestamp_ntz"]
    assert sorted(df.collect()) == [(1, "a", None), (2, None, dt.datetime(2024, 1, 2, 3))]
    empty = local_frame(spark, [], "id long, s string")
    assert empty.count() == 0 and empty.columns == ["id", "s"]
    # no Python RDD behind it
    assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


def test_csv_bad_records_and_splits(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/c")
    with open(f"{tmp_dir}/c/a.csv", "w") as f:
        f.write("a,b\n" + "1,2\n" * 3 + "1,2,3\n4\n")
    got = read_raw_csv(spark, f"{tmp_dir}/c", with_seq=False, bad_record="_bad").collect()
    assert len(got) == 5 and sorted(r["_bad"] for r in got if r["_bad"]) == ["1,2,3", "4"]
    with open(f"{tmp_dir}/c/a.csv", "w") as f:
        f.write("a,b\n" + "some text,more text\n" * 200_000)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")
    try:
        assert read_raw_csv(spark, f"{tmp_dir}/c", multi_line=False).rdd.getNumPartitions() > 4
        assert read_raw_csv(spark, f"{tmp_dir}/c", multi_line=False).count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
