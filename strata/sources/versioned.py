"""Versioned Parquet tables: write a new directory, then flip a pointer.

A table is a base directory holding one sub-directory per version and an
append-only ``_pointer`` log. Writers never overwrite the data a reader (or
the writer itself, as in SCD merges) may be reading: the new version is
written completely first and only then recorded in the log. A crash before
that leaves the previous version current. Readers take the newest logged
version.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.local import local_frame
from strata.sources.present import if_present

POINTER = "_pointer"


def _version_name() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, base: str, partition_by=None) -> str:
    """Write ``df`` as the next version of the table at ``base``."""
    spark = df.sparkSession
    base = base.rstrip("/")
    version = _version_name()
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/v_{version}")
    # the log keeps the schema too: partition columns (e.g. a boolean flag)
    # would otherwise be re-inferred from directory names as text
    (local_frame(spark, [(version, df.schema.json())], "version string, schema string")
     .coalesce(1).write.mode("append").json(f"{base}/{POINTER}"))
    return version


def _latest(spark: SparkSession, base: str):
    """Newest entry of the pointer log, None without one; a log that cannot be
    read is an error, so that a writer never takes a table for a new one."""
    log = if_present(lambda: spark.read.schema("version string, schema string")
                     .option("mode", "FAILFAST").json(f"{base}/{POINTER}"))
    return log.orderBy(F.col("version").desc()).first() if log is not None else None


def current_version(spark: SparkSession, base: str) -> str | None:
    row = _latest(spark, base.rstrip("/"))
    return row["version"] if row else None


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest committed version, or None when the table does not exist."""
    base = base.rstrip("/")
    row = _latest(spark, base)
    if row is None:
        return None
    schema = T.StructType.fromJson(json.loads(row["schema"]))
    df = spark.read.schema(schema).parquet(f"{base}/v_{row['version']}")
    return df.select(*schema.fieldNames())
