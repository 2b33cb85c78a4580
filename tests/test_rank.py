import random

from pyspark.sql import functions as F

from conftest import rows
from strata.operators import rank
from strata.operators.rank import dense_rank_by, dense_rank_window
from strata.sources.checkpoint import materialize


def test_null_aware_rank(spark):
    df = spark.createDataFrame(
        [("a", "2018-01-02"), ("a", None), ("a", "2018-01-01"), (None, "2018-01-01")],
        "c string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = dense_rank_by(df, "t", ["c"], out="r")
    got = sorted((r["c"] or "", str(r["t"]), r["r"]) for r in out.collect())
    assert got == [("", "2018-01-01 00:00:00", None), ("a", "2018-01-01 00:00:00", 1),
                   ("a", "2018-01-02 00:00:00", 2), ("a", "None", None)]


def test_global_dense_rank_desc(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 10.0)], "id int, v double")
    out = dense_rank_by(df, "v", ascending=False, out="r")
    assert rows(out, "id", "r") == [(1, 1), (2, 2), (3, 1)]


def _random_frame(spark, n=4000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        g = 0 if rnd.random() < 0.4 else rnd.randint(1, 30)   # group 0 is hot
        if rnd.random() < 0.05:
            g = None
        v = rnd.randint(0, 500) if rnd.random() > 0.03 else None
        data.append((i, g, v))
    return spark.createDataFrame(data, "id long, g int, v long")


def test_bucketed_rank_equals_window(spark):
    df = _random_frame(spark)
    for asc in (True, False):
        # bucket_rows=20 forces the hot-group path: several ranges per group
        fast = dense_rank_by(df, "v", ["g"], ascending=asc, out="r", bucket_rows=20)
        slow = dense_rank_window(df, "v", ["g"], ascending=asc, out="r")
        assert rows(fast, "id", "r") == rows(slow, "id", "r")


def test_bucketed_global_rank_equals_window(spark):
    df = _random_frame(spark, seed=11).withColumn("v", F.col("v").cast("decimal(18,2)") / 7)
    fast = dense_rank_by(df, "v", ascending=False, out="r", bucket_rows=25)
    slow = dense_rank_window(df, "v", ascending=False, out="r")
    assert rows(fast, "id", "r") == rows(slow, "id", "r")


def test_nan_and_piece_sizes_agree(spark):
    vals = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, None, 1.5, 1.5, -2.0, *[float(i) for i in range(20)]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    for asc in (True, False):
        want = rows(dense_rank_window(df, "v", ascending=asc, out="r"), "id", "r")
        for bucket_rows in (1, 5, 1_000_000):
            assert rows(dense_rank_by(df, "v", ascending=asc, out="r", bucket_rows=bucket_rows), "id", "r") == want


def test_timestamps_without_zone_across_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(96).select("id", F.expr("timestamp_ntz'2024-03-10 00:00:00' + make_interval(0,0,0,0,0,15*id)").alias("v"))
        want = rows(dense_rank_window(df, "v", out="r"), "id", "r")
        for bucket_rows in (1, 4, 1_000_000):
            assert rows(dense_rank_by(df, "v", out="r", bucket_rows=bucket_rows), "id", "r") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_text_and_dates_can_be_ranked(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "id int, v string")
    assert rows(dense_rank_by(df, "v", out="r", bucket_rows=1), "id", "r") == [(1, 2), (2, 1), (3, 2), (4, None)]


def test_many_pieces_take_few_tasks(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(rank, "materialize", lambda df: stored.append(materialize(df)) or stored[-1])
    df = spark.range(400).select(F.col("id").alias("v"), (F.col("id") % 7).alias("g"))
    got = rows(dense_rank_by(df, "v", ["g"], out="r", bucket_rows=5), "v", "r")
    assert got == [(v, v // 7 + 1) for v in range(400)]
    sizes = [r["count"] for r in stored[-1].groupBy("_piece").count().collect()]
    assert max(sizes) <= 5 and len(sizes) >= 80 and len(stored[-1].inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
