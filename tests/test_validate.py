import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.dedup import first_per_key, last_per_key
from strata.operators.validate import split_valid, validate_keys


def _frame(spark, keys):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "seq long, k string")


def test_key_split(spark):
    df = _frame(spark, [None, None, "a", "a", "b"])
    valid, rej = split_valid(validate_keys(df, ["k"], ["seq"]))
    assert rows(valid, "seq", "k") == [(2, "a"), (4, "b")]
    assert rows(rej, "seq", "reject_reason") == [(0, "null_key"), (1, "null_key"), (3, "duplicate_key")]


def test_composite_key(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 1, None), (2, 1, 1), (3, 1, 2)],
                               "seq long, a int, b int")
    valid, rej = split_valid(validate_keys(df, ["a", "b"], ["seq"]))
    assert rows(valid, "a", "b") == [(1, 1), (1, 2)]
    assert rows(rej, "seq", "reject_reason") == [(1, "null_key"), (2, "duplicate_key")]


def test_no_key_spec_all_valid(spark):
    df = _frame(spark, [None, "a", "a"])
    flagged = validate_keys(df, [], ["seq"])
    assert flagged.where("is_valid").count() == 3


def test_missing_key_column(spark):
    df = _frame(spark, ["a"])
    with pytest.raises(ValueError, match="z"):
        validate_keys(df, ["z"], ["seq"])


def test_first_wins_by_order_not_by_arrival(spark):
    df = spark.createDataFrame([(5, "a", "late"), (1, "a", "early"), (3, "a", "mid")],
                               "seq long, k string, v string")
    valid, rej = split_valid(validate_keys(df, ["k"], ["seq"]))
    assert rows(valid, "v") == [("early",)]
    assert rej.count() == 2


def test_hot_key_and_union_property(spark):
    # one key holds a third of all rows
    df = spark.range(0, 3000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 700).alias("k"))
    flagged = validate_keys(df, ["k"], ["seq"])
    valid, rej = split_valid(flagged)
    assert valid.count() + rej.count() == 3000
    assert valid.count() == df.select("k").distinct().count()
    # the survivor of each key is its smallest seq
    expect = df.groupBy("k").agg(F.min("seq").alias("seq"))
    assert rows(valid, "k", "seq") == rows(expect, "k", "seq")


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (1, "b", "z")],
                               "seq long, k string, v string")
    assert rows(last_per_key(df, ["k"], ["seq"]), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(first_per_key(df, ["k"], ["seq"]), "k", "v") == [("a", "x"), ("b", "z")]


def test_exact_duplicates_keep_one_row_by_file_order(spark, tmp_dir):
    from strata.plans import roles
    # two identical rows per key: the order columns alone tie
    data = [(1, 10, "x"), (1, 10, "x"), (2, 20, "y"), (3, 30, "z"), (3, 30, "z"), (3, 30, "z")]
    spark.createDataFrame(data, "k long, v long, t string").coalesce(1) \
        .write.parquet(f"{tmp_dir}/dup.parquet")
    flagged = roles.validate_table(spark, tmp_dir, "dup", ["k"], ["v"])
    assert "_file" not in flagged.columns and "_row" not in flagged.columns
    valid, rej = split_valid(flagged)
    assert rows(valid, "k") == [(1,), (2,), (3,)]
    assert rows(rej, "k", "reject_reason") == [(1, "duplicate_key"), (3, "duplicate_key"),
                                               (3, "duplicate_key")]


def test_broadcast_and_shuffle_plans_agree(spark):
    # a hot key (a third of the rows), ordinary repeats, unique keys, null keys
    df = spark.range(0, 3000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(0))
         .when(F.col("id") % 11 == 0, F.lit(None))
         .otherwise(F.col("id") % 1400).alias("k"),
        (F.col("id") * 7).alias("payload"))
    cols = ("seq", "k", "payload", "is_valid", "reject_reason")
    small = validate_keys(df, ["k"], ["seq"])                     # broadcast plan
    got = rows(small, *cols)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # shuffle join plan
    try:
        assert got == rows(validate_keys(df, ["k"], ["seq"]), *cols)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    first = df.where(F.col("k").isNotNull()).groupBy("k").agg(F.min("seq").alias("seq"))
    assert rows(small.where("is_valid"), "k", "seq") == rows(first, "k", "seq")
    assert small.where("reject_reason = 'null_key'").count() == df.where("k is null").count()
