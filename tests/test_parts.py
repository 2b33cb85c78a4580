"""Tables of immutable parts: commits, what they replace, crashes, new columns, compaction."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.sources import parts


def frame(spark, data, fields="k long, v string"):
    return spark.createDataFrame(data, fields)


def test_commits_and_replacements(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    assert parts.read(spark, base) is None and parts.touched(spark, base, frame(spark, [(1, "x")])) is None
    parts.commit(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), base, ["k"], ["k"])
    early = parts.read(spark, base)
    parts.commit(frame(spark, [(2, "B"), (4, "d")]), base, ["k"], ["k"], gone=frame(spark, [(2, "b")]))
    assert rows(parts.read(spark, base)) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert rows(early) == [(1, "a"), (2, "b"), (3, "c")]  # a reader keeps what it began with
    parts.commit(frame(spark, []), base, ["k"], ["k"], gone=frame(spark, [(1, "")]))
    assert rows(parts.read(spark, base), "k") == [(2,), (3,), (4,)]
    assert rows(parts.history(spark, base)) == [(0, 3, 0), (1, 2, 1), (2, 0, 1)]
    parts.compact(spark, base)
    assert rows(parts.read(spark, base), "k") == [(2,), (3,), (4,)]
    assert parts.latest(spark, base)["gone"] == []


def test_a_crash_leaves_the_table(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    parts.commit(frame(spark, [(1, "a")]), base, ["k"], ["k"])
    # a commit that wrote its rows and did not reach the log
    frame(spark, [(9, "half")]).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{base}/rows/_commit=1")
    assert rows(parts.read(spark, base)) == [(1, "a")]
    parts.commit(frame(spark, [(2, "b")]), base, ["k"], ["k"])
    assert rows(parts.read(spark, base)) == [(1, "a"), (2, "b")]


def test_columns(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    parts.commit(frame(spark, [(1, "a")]), base, ["k"], ["k"])
    parts.commit(frame(spark, [(2, "b", 5)], "k long, v string, n int"), base, ["k"], ["k"])
    assert rows(parts.read(spark, base)) == [(1, "a", None), (2, "b", 5)]
    with pytest.raises(ValueError):
        parts.commit(frame(spark, [(1, 2)], "k long, v int"), base, ["k"], ["k"])
    with pytest.raises(ValueError):
        parts.commit(frame(spark, [(1, "a")]), base, ["v"], ["k"])
