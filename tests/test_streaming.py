import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from strata.sources import parts, state
from strata.sources.raw import read_raw_csv
from strata.streaming.dimensions import read_scd1, read_scd2, scd1_foreach_batch, scd2_foreach_batch, start_dimension_stream
from strata.streaming.ingest import dedup_stream, hwm_batch, hwm_stream, ingest_stream, read_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("v", T.StringType())])


def _drop(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def test_ingest_stream_exactly_once(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _drop(spark, src, [(1, _ts("2024-01-01 00:00:00"), "a"), (2, _ts("2024-01-02 00:00:00"), "b")])
    ingest_stream(spark, src, SCHEMA, out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    # a late file (older timestamps) still loads; processed files are not re-read
    _drop(spark, src, [(3, _ts("2023-12-01 00:00:00"), "late")])
    ingest_stream(spark, src, SCHEMA, out, ck).awaitTermination()
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_ingest_stream_csv_na_tokens(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/csv", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write("id,v\n1,NA\n2,x\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    ingest_stream(spark, src, schema, out, ck, fmt="csv").awaitTermination()
    assert rows(spark.read.parquet(out), "id", "v") == [("1", None), ("2", "x")]


def test_hwm_stream_keeps_strict_mark(spark, tmp_dir):
    src, out, ck, mark = (f"{tmp_dir}/{n}" for n in ("src", "out", "ck", "mark"))
    _drop(spark, src, [(1, _ts("2024-01-01 00:00:00"), "a"), (2, _ts("2024-01-03 00:00:00"), "b")])
    hwm_stream(spark, src, SCHEMA, "ts", out, mark, ck).awaitTermination()
    _drop(spark, src, [(3, _ts("2024-01-02 00:00:00"), "late"), (4, _ts("2024-01-04 00:00:00"), "c")])
    hwm_stream(spark, src, SCHEMA, "ts", out, mark, ck).awaitTermination()
    # the late row is at or below the stored mark and is not loaded
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (4,)]
    assert state.read_mark(spark, mark) == "2024-01-04 00:00:00"


def test_hwm_batch_replay_writes_once(spark, tmp_dir):
    out, mark = f"{tmp_dir}/out", f"{tmp_dir}/mark"
    apply = hwm_batch(spark, "ts", out, mark, stream="s1")
    b0 = spark.createDataFrame([(1, _ts("2024-01-01 00:00:00"), "a")], SCHEMA)
    apply(b0, 0)
    apply(b0, 0)  # replay after the mark moved: skipped
    b1 = spark.createDataFrame([(2, _ts("2024-01-02 00:00:00"), "b")], SCHEMA)
    # a crash after the write but before the mark: the replay rewrites the batch
    from strata.operators.incremental import new_rows
    import hashlib
    tag = hashlib.sha1(b"s1").hexdigest()[:12]
    new_rows(b1, "ts", state.read_mark(spark, mark)).write.parquet(f"{out}/stream_epoch={tag}-0000000001")
    apply(b1, 1)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]
    assert state.read_mark(spark, mark) == "2024-01-02 00:00:00"
    # another stream on the same mark is not mistaken for a replay
    b2 = spark.createDataFrame([(3, _ts("2024-01-03 00:00:00"), "c")], SCHEMA)
    hwm_batch(spark, "ts", out, mark, stream="s2")(b2, 0)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_dedup_stream_removes_repeats(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _drop(spark, src, [(1, _ts("2024-01-01 00:00:00"), "a"), (2, _ts("2024-01-01 00:10:00"), "b")])
    # a retried append of the same rows
    _drop(spark, src, [(1, _ts("2024-01-01 00:00:00"), "a"), (2, _ts("2024-01-01 00:10:00"), "b"),
                       (3, _ts("2024-01-01 00:20:00"), "c")])
    stream = dedup_stream(read_stream(spark, src, SCHEMA), ["id"], "ts", "1 hour")
    q = (stream.writeStream.format("memory").queryName("dedup_out")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("dedup_out"), "id") == [(1,), (2,), (3,)]


def test_dimension_streams(spark, tmp_dir):
    src, ck1, ck2 = f"{tmp_dir}/src", f"{tmp_dir}/ck1", f"{tmp_dir}/ck2"
    dim1, dim2 = f"{tmp_dir}/dim1", f"{tmp_dir}/dim2"
    _drop(spark, src, [(1, _ts("2024-01-01 00:00:00"), "a"), (2, _ts("2024-01-01 00:00:00"), "b")])
    for _ in range(2):   # the second pass finds no new files
        start_dimension_stream(read_stream(spark, src, SCHEMA),
                               scd1_foreach_batch(dim1, ["id"], ["ts"]), ck1).awaitTermination()
        start_dimension_stream(read_stream(spark, src, SCHEMA),
                               scd2_foreach_batch(dim2, "id", ["v"], ["ts"], as_of_col="ts"),
                               ck2).awaitTermination()
    _drop(spark, src, [(1, _ts("2024-01-05 00:00:00"), "a2"), (1, _ts("2024-01-06 00:00:00"), "a3")])
    start_dimension_stream(read_stream(spark, src, SCHEMA),
                           scd1_foreach_batch(dim1, ["id"], ["ts"]), ck1).awaitTermination()
    start_dimension_stream(read_stream(spark, src, SCHEMA),
                           scd2_foreach_batch(dim2, "id", ["v"], ["ts"], as_of_col="ts"),
                           ck2).awaitTermination()
    assert rows(read_scd1(spark, dim1), "id", "v") == [(1, "a3"), (2, "b")]
    # both changes of one batch are versions, each from its own time
    assert rows(read_scd2(spark, dim2), "id", "v", "is_current") == [(1, "a", False), (1, "a2", False), (1, "a3", True), (2, "b", True)]


def test_late_rows(spark, tmp_dir):
    """A row older than the stored ones does not win (SCD1), and splits the version that it falls into (SCD2)."""
    dim1, dim2 = f"{tmp_dir}/dim1", f"{tmp_dir}/dim2"
    one, two = scd1_foreach_batch(dim1, ["id"], ["ts"]), scd2_foreach_batch(dim2, "id", ["v"], ["ts"], as_of_col="ts")
    batches = [[(1, "2024-01-01", "a"), (1, "2024-03-01", "b"), (2, "2024-01-01", "x")], [], [(1, "2023-12-01", "b"), (1, "2024-02-01", "a"), (None, "2024-01-01", "n"), (2, None, "n")],
               [(1, "2024-01-15", "c"), (1, "2024-03-01", "b")]]
    for epoch, batch in enumerate(batches):
        df = spark.createDataFrame([(i, t and _ts(t), v) for i, t, v in batch], SCHEMA)
        for _ in range(2):  # the second is a replay
            one(df, epoch), two(df, epoch)
    assert rows(read_scd1(spark, dim1), "id", "v") == [(1, "b"), (2, "x")]
    got = rows(read_scd2(spark, dim2).selectExpr("id", "v", "date_format(effective_from, 'MMdd') f", "date_format(effective_to, 'MMdd') t", "is_current"))
    assert got == [(1, "a", "0101", "0115", False), (1, "a", "0201", "0301", False), (1, "b", "0301", None, True), (1, "b", "1201", "0101", False),
                   (1, "c", "0115", "0201", False), (2, "x", "0101", None, True)]
    # replays and the empty batch committed nothing
    assert parts.history(spark, dim1).count() == 1 and parts.history(spark, dim2).count() == 3


def test_snapshots_without_event_time(spark, tmp_dir):
    dim = f"{tmp_dir}/dim"
    apply = scd2_foreach_batch(dim, "id", ["v"], ["ts"])
    for epoch, v in enumerate(["a", "a", "b"]):
        apply(spark.createDataFrame([(1, _ts("2024-01-01"), v)], SCHEMA), epoch)
    got = read_scd2(spark, dim).orderBy("effective_from").collect()
    assert [(r["v"], r["is_current"]) for r in got] == [("a", False), ("b", True)] and got[0]["effective_to"] == got[1]["effective_from"]


def test_csv_stream_reads_like_the_batch_reader(spark, tmp_dir):
    """Quoted line ends and quotes, and columns in another order than asked for."""
    src, out, ck = f"{tmp_dir}/csv", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write('\ufeffv,id\n"line\nend",1\n"a ""quote"", and more",2\nplain,3\n')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
    ingest_stream(spark, src, schema, out, ck, fmt="csv").awaitTermination()
    want = [("1", "line\nend"), ("2", 'a "quote", and more'), ("3", "plain")]
    assert rows(spark.read.parquet(out), "id", "v") == want
    assert rows(read_raw_csv(spark, src), "id", "v") == want
