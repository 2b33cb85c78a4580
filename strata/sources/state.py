"""Stored high-water mark (one scalar per stream), append-only.

The mark is written only after the data it covers has been committed, and
never as null, so a failed or empty run leaves the previous mark in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.local import local_frame
from strata.sources.present import if_present

MARK_KEY = "last_order_timestamp"


def read_mark(spark: SparkSession, path: str, key: str = MARK_KEY):
    """Newest stored mark as ISO text, or None when nothing is stored; a log
    that cannot be read is an error."""
    log = if_present(lambda: _log(spark, path, f"seq long, {key} string"))
    row = log.orderBy(F.col("seq").desc()).first() if log is not None else None
    return row[key] if row else None


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def save_mark(spark: SparkSession, path: str, mark_frame: DataFrame, key: str = MARK_KEY,
              stream: str | None = None, epoch: int | None = None) -> None:
    """Append the mark held in the one-row ``mark_frame`` (skipped if null).

    A stream also records which of its micro-batches (``epoch``) moved the
    mark, so a replayed batch can tell that it was already committed.
    """
    import time
    row = mark_frame.select(F.col(mark_frame.columns[0]).cast("string").alias(key)).first()
    if row is None or row[key] is None:
        return
    (local_frame(spark, [(time.time_ns(), row[key], stream, epoch)],
                           f"seq long, {key} string, stream string, epoch long")
     .coalesce(1).write.mode("append").json(path))


def last_epoch(spark: SparkSession, path: str, stream: str):
    """Newest micro-batch of ``stream`` that moved the mark, or None."""
    log = if_present(lambda: _log(spark, path, "seq long, stream string, epoch long"))
    if log is None:
        return None
    row = log.where(F.col("stream") == stream).orderBy(F.col("seq").desc()).first()
    return row["epoch"] if row else None
