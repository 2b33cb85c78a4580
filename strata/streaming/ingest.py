"""Structured Streaming variants of the incremental load.

* ``ingest_stream`` (recommended): the stream checkpoint records which
  files were processed, so every arriving file is loaded exactly once and
  late rows are not lost (the stored high-water mark of the batch loader
  drops rows at or below the mark for good).
* ``hwm_stream``: reproduces the stored-mark rule per micro-batch with
  ``foreachBatch`` — only correct when files arrive in timestamp order.
* ``dedup_stream``: drops repeated keys within an event-time watermark
  (e.g. a retried upstream append), with bounded state.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import null_tokens
from strata.operators.incremental import new_rows, next_mark
from strata.sources import state
from strata.sources.present import if_present
from strata.sources.raw import BOM, csv_header, csv_options


def read_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the files in ``source_dir``. CSV is read as by the batch
    reader; its columns are taken by name, in the order of the header of the
    files that are there, and a later file with another header is an error."""
    in_file = schema
    if fmt == "csv":
        header = if_present(lambda: csv_header(spark, source_dir))
        if header and set(c.replace(BOM, "") for c in header) == set(schema.fieldNames()):
            in_file = T.StructType([schema[c.replace(BOM, "")] for c in header])
    reader = spark.readStream.schema(in_file).format(fmt)
    if fmt == "csv":
        reader = reader.options(**csv_options(), enforceSchema=False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(source_dir)
    if fmt == "csv":
        df = df.select(*[null_tokens(c).alias(c) if isinstance(schema[c].dataType, T.StringType)
                         else F.col(c) for c in schema.fieldNames()])
    return df


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                  checkpoint: str, fmt: str = "parquet", partition_by=None):
    """Load every file that has arrived (once), then stop. Returns the query."""
    df = read_stream(spark, source_dir, schema, fmt)
    writer = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(target)


EPOCH = "stream_epoch"


def hwm_batch(spark: SparkSession, ts_col: str, target: str, mark_path: str, stream: str):
    """The ``foreachBatch`` function of ``hwm_stream``; safe to replay.

    Spark replays a micro-batch whose commit it did not record. Each batch
    writes its own ``stream_epoch=<stream hash>-<epoch>`` directory in
    overwrite mode, so a replay before the mark moved rewrites the same rows
    instead of appending them twice; once the mark records the batch, a
    replay is skipped. The stream hash keeps two streams (e.g. a restart
    with a new checkpoint) from overwriting each other's batches.
    """
    tag = hashlib.sha1(stream.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, epoch_id: int) -> None:
        done = state.last_epoch(spark, mark_path, stream)
        if done is not None and done >= epoch_id:
            return
        mark = state.read_mark(spark, mark_path)
        rows = new_rows(batch, ts_col, mark)
        rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{EPOCH}={tag}-{epoch_id:010d}")
        # mark moves only after the rows are committed; bounded by the batch
        state.save_mark(spark, mark_path, next_mark(rows, ts_col, mark),
                        stream=stream, epoch=epoch_id)
    return apply


def hwm_stream(spark: SparkSession, source_dir: str, schema: T.StructType, ts_col: str,
               target: str, mark_path: str, checkpoint: str, fmt: str = "parquet"):
    """Per micro-batch: keep rows past the stored mark, write, move the mark.

    ``target`` is partitioned by ``stream_epoch`` (one directory per batch;
    the stream is identified by its checkpoint path).
    """
    df = read_stream(spark, source_dir, schema, fmt, max_files_per_trigger=1)
    apply = hwm_batch(spark, ts_col, target, mark_path, stream=checkpoint.rstrip("/"))
    return (df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def dedup_stream(df: DataFrame, keys, ts_col: str, delay: str = "1 hour") -> DataFrame:
    """Drop rows whose key was already seen within ``delay`` of event time.

    ``withWatermark`` needs a TIMESTAMP (not TIMESTAMP_NTZ) column; a naive
    column is read as UTC wall-clock time.
    """
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        df = df.withColumn(ts_col, F.col(ts_col).cast(T.TimestampType()))
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))
