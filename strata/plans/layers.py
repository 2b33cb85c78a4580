"""Stored layers shared by the registered queries.

Like the layered run, queries read an upstream layer once it has been
written instead of re-deriving it: the validation layer of a keyed table
(flagged rows, partitioned by ``is_valid``), the business table and the
customer summary. Each layer is built by the first query that needs it in
a Spark application, written as Parquet under ``spark.checkpoint.dir``
(reliable storage) and read back by the others. A layer is kept under the
state of its source files (paths, sizes, modification times), so replaced or
added files make the next query rebuild it. ``clear_layers`` forgets all.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.checkpoint import table_dir
from strata.sources.present import if_present

_LOCK = threading.RLock()  # a layer may build on another stored layer
_STORE: dict = {}


def source_state(spark: SparkSession, sf_dir: str) -> int:
    """A number that changes with the files below ``sf_dir``; their contents
    are not read."""
    files = if_present(lambda: spark.read.format("binaryFile")
                       .option("recursiveFileLookup", "true").load(sf_dir))
    if files is None:
        return 0
    files = (files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h")))
    row = files.agg(F.sum("h").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return hash((row["s"], row["n"]))


def stored_layer(spark: SparkSession, sf_dir: str, name: str, build, partition_by=None) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name, source_state(spark, sf_dir))
    with _LOCK:
        path = _STORE.get(key)
        if path is None:
            path = table_dir(spark)
            writer = build().write.mode("overwrite").option("compression", "zstd")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
            _STORE[key] = path
    return spark.read.parquet(path)


def flagged_layer(spark: SparkSession, sf_dir: str, table: str, build) -> DataFrame:
    """Validation layer: every row with ``is_valid`` / ``reject_reason``."""
    df = stored_layer(spark, sf_dir, f"validation/{table}", build, partition_by=["is_valid"])
    return df.withColumn("is_valid", F.col("is_valid").cast("boolean"))


def stored(spark: SparkSession) -> list[str]:
    """Names of the layers that ``spark``'s application has stored."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        return sorted(k[2] for k in _STORE if k[0] == app)


def clear_layers(spark: SparkSession | None = None) -> None:
    """Forget stored layers (all, or those of ``spark``'s application), so
    the next query rebuilds them; call after the source tables change."""
    with _LOCK:
        if spark is None:
            _STORE.clear()
            return
        app = spark.sparkContext.applicationId
        for key in [k for k in _STORE if k[0] == app]:
            del _STORE[key]
