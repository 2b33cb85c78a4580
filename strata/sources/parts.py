"""Tables that are changed by small commits instead of being written again.

A table is a base directory with immutable parts and an append-only log:

* ``rows/_commit=<n>/_bucket=<b>``: rows that commit n added, by hash of the
  table's keys;
* ``gone/_commit=<n>``: identities of rows of earlier commits that commit n
  replaced or removed (the identity columns only);
* ``_log``: one line for each commit, with the parts that are live after it.

A commit writes its rows and identities first and its log line last, so a
crash leaves the table as it was, and readers always see whole commits. Its
cost follows the change, not the table. A reader takes the live parts less
the rows whose identity a later commit lists: an anti join with a table as
small as the changes, which Spark broadcasts while that is small. Where only
some keys matter, ``buckets`` prunes the others' directories.
``compact`` writes the visible rows as one part when changes have piled up.

One writer at a time; a stream's commits carry its epoch, so a replayed
batch can tell that it was committed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.local import local_frame
from strata.sources.present import if_present

COMMIT, BUCKET, BEFORE = "_commit", "_bucket", "_before"
BUCKETS = 64
LOG_SCHEMA = ("number long, schema string, keys array<string>, identity array<string>, buckets int, "
              "rows array<long>, gone array<long>, stream string, epoch long, row_count long, gone_count long")


def _log(spark: SparkSession, base: str) -> DataFrame | None:
    """The log, None without one; a log that cannot be read is an error."""
    return if_present(lambda: spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").json(f"{base.rstrip('/')}/_log"))


def latest(spark: SparkSession, base: str):
    """The newest log entry, None when the table does not exist."""
    log = _log(spark, base)
    return log.orderBy(F.col("number").desc()).first() if log is not None else None


def history(spark: SparkSession, base: str) -> DataFrame | None:
    """One row for each commit: its number and how many rows it added and took away."""
    log = _log(spark, base)
    return log.select("number", "row_count", "gone_count") if log is not None else None


def last_epoch(spark: SparkSession, base: str, stream: str):
    """Newest micro-batch of ``stream`` that was committed, or None."""
    log = _log(spark, base)
    row = log.where(F.col("stream") == stream).agg(F.max("epoch").alias("e")).first() if log is not None else None
    return row["e"] if row else None


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def touched(spark: SparkSession, base: str, changed: DataFrame) -> list[int] | None:
    """The buckets that hold the keys of ``changed``; None for all of them, or without a table."""
    entry = latest(spark, base)
    if entry is None:
        return None
    found = changed.select(bucket_of(entry["keys"], entry["buckets"]).alias(BUCKET)).distinct().collect()  # at most one row a bucket
    return None if len(found) == entry["buckets"] else sorted(r[BUCKET] for r in found)


def commit(rows: DataFrame, base: str, keys: Sequence[str], identity: Sequence[str], gone: DataFrame | None = None, *,
           buckets: int = BUCKETS, stream: str | None = None, epoch: int | None = None) -> int:
    """Add ``rows`` and take away the earlier rows whose identity ``gone`` lists, in one step. Columns that the table
    does not have yet are added to it. Keys, identity and number of buckets are those of the first commit. Returns its number."""
    spark, base = rows.sparkSession, base.rstrip("/")
    entry = latest(spark, base)
    number, live_rows, live_gone, schema = 0, [], [], rows.schema
    if entry is not None:
        if list(entry["keys"]) != list(keys) or list(entry["identity"]) != list(identity):
            raise ValueError(f"{base} has the keys {entry['keys']} and the identity {entry['identity']}")
        number, buckets, live_rows, live_gone = entry["number"] + 1, entry["buckets"], list(entry["rows"]), list(entry["gone"])
        schema = _widened(T.StructType.fromJson(json.loads(entry["schema"])), rows.schema, base)
    # a directory of this number can only be left from a commit that did not reach the log
    added, removed = _written(rows.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET), f"{base}/rows/{COMMIT}={number}", BUCKET), 0
    if gone is not None and live_rows:
        removed = _written(gone.select(*identity).withColumn(BEFORE, F.lit(number).cast("long")), f"{base}/gone/{COMMIT}={number}")
    live_rows += [number] if added else []
    live_gone += [number] if removed else []
    _append(spark, base, (number, schema.json(), list(keys), list(identity), buckets, live_rows, live_gone, stream, epoch, added, removed))
    return number


def _written(df: DataFrame, path: str, *partition_by: str) -> int:
    """Write a part; its number of rows, from the file footers."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def _append(spark: SparkSession, base: str, entry: tuple) -> None:
    local_frame(spark, [entry], LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/_log")


def _widened(old: T.StructType, new: T.StructType, base: str) -> T.StructType:
    """The columns of ``old``, then those that ``new`` adds; one column has one type."""
    types = {f.name: f.dataType for f in old}
    other = [f.name for f in new if f.name in types and types[f.name] != f.dataType]
    if other:
        raise ValueError(f"{base}: columns {other} change their type")
    return T.StructType([*old.fields, *[f for f in new if f.name not in types]])


def read(spark: SparkSession, base: str, buckets: Sequence[int] | None = None, with_commit: bool = False) -> DataFrame | None:
    """The visible rows (of some ``buckets``), or None when the table does not exist."""
    base = base.rstrip("/")
    entry = latest(spark, base)
    if entry is None:
        return None
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    names = [*schema.fieldNames(), *([COMMIT] if with_commit else [])]
    full = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema], T.StructField(COMMIT, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    if not entry["rows"]:
        return local_frame(spark, [], full).select(*names)
    rows = (spark.read.schema(full).option("basePath", f"{base}/rows").parquet(*[f"{base}/rows/{COMMIT}={n}" for n in entry["rows"]]))
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(list(buckets)))
    if entry["gone"]:
        identity = T.StructType([T.StructField(c, schema[c].dataType) for c in entry["identity"]] + [T.StructField(BEFORE, T.LongType())])
        gone = spark.read.schema(identity).parquet(*[f"{base}/gone/{COMMIT}={n}" for n in entry["gone"]])
        gone = gone.select(*[F.col(c).alias(f"_gone_{c}") for c in entry["identity"]], BEFORE)
        same = [F.col(c) == F.col(f"_gone_{c}") for c in entry["identity"]]
        rows = rows.join(gone, [*same, F.col(COMMIT) < F.col(BEFORE)], "left_anti")
    return rows.select(*names)


def compact(spark: SparkSession, base: str) -> int:
    """Write the visible rows as one part. The older parts stay for readers that have begun with them."""
    base = base.rstrip("/")
    entry = latest(spark, base)
    number = entry["number"] + 1
    rows = read(spark, base).withColumn(BUCKET, bucket_of(entry["keys"], entry["buckets"]))
    n = _written(rows.hint("rebalance", BUCKET), f"{base}/rows/{COMMIT}={number}", BUCKET)
    _append(spark, base, (number, entry["schema"], list(entry["keys"]), list(entry["identity"]), entry["buckets"], [number] if n else [], [], None, None, 0, 0))
    return number
