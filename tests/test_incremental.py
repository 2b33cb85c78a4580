from pyspark.sql import functions as F

from strata.operators.incremental import ingest_incremental
from strata.sources import state


def _ts_frame(spark, vals):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, ts long") \
        .withColumn("ts", F.col("ts").cast("int"))


def test_high_water_mark_sequence(spark, tmp_dir):
    mark_path = f"{tmp_dir}/mark"
    df1 = _ts_frame(spark, [1, None, 3])
    rows1, m1 = ingest_incremental(df1, "ts", state.read_mark(spark, mark_path))
    assert rows1.count() == 3                 # first load keeps null timestamps
    state.save_mark(spark, mark_path, m1)
    assert state.read_mark(spark, mark_path) == "3"

    df2 = _ts_frame(spark, [2, 3, 4, None])
    rows2, m2 = ingest_incremental(df2, "ts", state.read_mark(spark, mark_path))
    assert [r["ts"] for r in rows2.collect()] == [4]   # strict: 3 does not pass
    state.save_mark(spark, mark_path, m2)
    assert state.read_mark(spark, mark_path) == "4"

    rows3, m3 = ingest_incremental(df2, "ts", state.read_mark(spark, mark_path))
    assert rows3.count() == 0
    state.save_mark(spark, mark_path, m3)
    assert state.read_mark(spark, mark_path) == "4"    # empty batch keeps the mark


def test_null_mark_never_saved(spark, tmp_dir):
    mark_path = f"{tmp_dir}/mark"
    df = _ts_frame(spark, [None, None])
    rows, m = ingest_incremental(df, "ts", None)
    assert rows.count() == 2
    state.save_mark(spark, mark_path, m)
    assert state.read_mark(spark, mark_path) is None
