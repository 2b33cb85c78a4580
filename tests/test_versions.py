"""Versions by event time against a loop over all rows, in any order and batching, and what their commits cost."""

import os
import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators.scd import EFFECTIVE_FROM
from strata.operators.versions import dimension, fold, observations, version_changes
from strata.sources import parts

SCHEMA = "id long, at timestamp_ntz, v string, note string"
START = datetime(2024, 1, 1)


def change_rows(rng, n=300):
    """Half of the rows belong to one member; times repeat, also with different values."""
    return [(1 if rng.random() < 0.5 else rng.randint(2, 12), START + timedelta(days=rng.randint(0, 120)), rng.choice(["a", "b", None]), str(rng.randint(0, 3))) for _ in range(n)]


def brute(changes):
    best = {}
    for i, at, v, note in changes:
        best[i, at] = max(best.get((i, at), (False, "", "")), (v is not None, v or "", note))
    line = defaultdict(list)
    for (i, at), (there, v, note) in sorted(best.items()):
        value = v if there else None
        if not line[i] or line[i][-1][1] != value:
            line[i].append((at, value, note))
    return sorted(((i, v, note, at, nxt[0] if nxt else None) for i, versions in line.items()
                   for (at, v, note), nxt in zip(versions, [*versions[1:], None])), key=str)


def merged(spark, base, batch):
    df = spark.createDataFrame(batch, SCHEMA)
    stored = parts.read(spark, base, parts.touched(spark, base, df))
    changed, gone = version_changes(stored, df, "id", "at", ["v"])
    return parts.commit(changed, base, ["id"], ["id", EFFECTIVE_FROM], gone)


def versions(spark, base):
    out = dimension(parts.read(spark, base))
    assert out.where("effective_to <= effective_from or is_current <> (effective_to is null)").count() == 0
    return sorted(((r["id"], r["v"], r["note"], r["effective_from"], r["effective_to"]) for r in out.collect()), key=str)


@pytest.mark.parametrize("pieces", [1, 7])
def test_fold_equals_brute_force(spark, pieces):
    changes = change_rows(random.Random(pieces))
    out = dimension(fold(observations(spark.createDataFrame(changes, SCHEMA), "id", "at"), "id", ["v"], pieces))
    got = sorted(((r["id"], r["v"], r["note"], r["effective_from"], r["effective_to"]) for r in out.collect()), key=str)
    assert got == brute(changes)


def test_any_order_and_batching(spark, tmp_dir):
    rng = random.Random(3)
    changes = change_rows(rng)
    for name, cuts in (("two", [0, 170, 300]), ("four", [0, 20, 150, 151, 300])):
        rng.shuffle(changes)
        base = f"{tmp_dir}/{name}"
        for a, b in zip(cuts, cuts[1:]):
            merged(spark, base, changes[a:b])
        assert versions(spark, base) == brute(changes)
    parts.compact(spark, base)
    assert versions(spark, base) == brute(changes)
    merged(spark, base, changes[:5])  # rows that are there already
    assert versions(spark, base) == brute(changes)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_commit_costs_what_it_changes(spark, tmp_dir):
    base, n = f"{tmp_dir}/t", 200_000
    ids = spark.range(n)
    first = ids.select("id", F.lit(START).cast("timestamp_ntz").alias("at"), F.md5(F.col("id").cast("string")).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("note"))
    changed, gone = version_changes(None, first, "id", "at", ["v"])
    parts.commit(changed, base, ["id"], ["id", EFFECTIVE_FROM], gone, buckets=4)
    second = first.where("id % 100 = 7").withColumn("at", F.col("at") + F.expr("interval 1 day")).withColumn("v", F.lit("new"))
    changed, gone = version_changes(parts.read(spark, base), second, "id", "at", ["v"])
    parts.commit(changed, base, ["id"], ["id", EFFECTIVE_FROM], gone)
    whole, more = size(f"{base}/rows/_commit=0"), size(f"{base}/rows/_commit=1") + size(f"{base}/gone")
    assert more < 0.04 * whole
    out = dimension(parts.read(spark, base))
    assert out.count() == n + n // 100 and out.where("is_current").count() == n
    # a member's versions are read from its bucket alone
    only = parts.touched(spark, base, second.where("id = 7"))
    assert len(only) == 1 and rows(parts.read(spark, base, only).where("id = 7"), "is_current") == [(False,), (True,)]
    plan = parts.read(spark, base, only)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*_bucket#\d+ = {only[0]}\)", plan)
