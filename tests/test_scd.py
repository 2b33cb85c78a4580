from pyspark.sql import functions as F

from conftest import rows
from strata.operators.scd import scd1_merge, scd2_merge


def test_scd1_overlay_and_idempotent(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    new = spark.createDataFrame([(2, "z"), (3, "w")], "id int, v string")
    out = scd1_merge(old, new, ["id"])
    assert rows(out) == [(1, "x"), (2, "z"), (3, "w")]
    again = scd1_merge(out, new, ["id"])
    assert rows(again) == rows(out)


def test_scd1_schema_union(spark):
    old = spark.createDataFrame([(1, "x")], "id int, v string")
    new = spark.createDataFrame([(2, "z", 5)], "id int, v string, extra int")
    out = scd1_merge(old, new, ["id"])
    assert rows(out, "id", "v", "extra") == [(1, "x", None), (2, "z", 5)]


SCHEMA = "product_id string, cat string, w double, note string"
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def _history(spark):
    first = spark.createDataFrame([("p1", "a", 1.0, "n"), ("p2", "b", None, "n")], SCHEMA)
    h1 = scd2_merge(None, first, "product_id", ["cat", "w"], as_of=T1)
    second = spark.createDataFrame(
        [("p1", "a2", 1.0, "n"), ("p2", "b", None, "changed"), ("p3", "c", 3.0, "n")], SCHEMA)
    h2 = scd2_merge(h1, second, "product_id", ["cat", "w"], as_of=T2)
    return h1, h2


def test_scd2_first_run(spark):
    h1, _ = _history(spark)
    assert rows(h1, "product_id", "is_current", "effective_to") == [("p1", True, None), ("p2", True, None)]
    assert {str(r["effective_from"]) for r in h1.collect()} == {"2024-01-01 00:00:00"}


def test_scd2_change_untracked_new(spark):
    _, h2 = _history(spark)
    got = rows(h2.withColumn("f", F.col("effective_from").cast("string"))
                 .withColumn("t", F.col("effective_to").cast("string")),
               "product_id", "cat", "note", "f", "t", "is_current")
    assert got == [
        ("p1", "a", "n", "2024-01-01 00:00:00", "2024-02-01 00:00:00", False),
        ("p1", "a2", "n", "2024-02-01 00:00:00", None, True),
        # untracked change and tracked null -> null: no new version
        ("p2", "b", "n", "2024-01-01 00:00:00", None, True),
        ("p3", "c", "n", "2024-02-01 00:00:00", None, True),
    ]


def test_scd2_absence_and_noop(spark):
    _, h2 = _history(spark)
    third = spark.createDataFrame([("p1", "a2", 1.0, "n"), ("p3", "c", 3.0, "n")], SCHEMA)
    h3 = scd2_merge(h2, third, "product_id", ["cat", "w"], as_of=T3)
    # p2 is absent from the snapshot and stays current; nothing else changes
    assert rows(h3) == rows(h2)
    # properties: one current row per key, closed intervals do not overlap
    cur = h3.where("is_current").groupBy("product_id").count()
    assert cur.where("count > 1").count() == 0
    closed = h3.where(~F.col("is_current"))
    assert closed.where(F.col("effective_to") < F.col("effective_from")).count() == 0
