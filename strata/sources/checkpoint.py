"""Materialise an intermediate result and cut its lineage.

Used where a plan would otherwise recompute an expensive subtree several
times (Spark re-runs a shared subtree once per reference unless an exchange
is reused, and column pruning usually prevents that).

The result is written once as a Parquet table under the session's reliable
checkpoint directory (``spark.checkpoint.dir``, a shared folder on a
cluster) and read back, so a lost executor does not lose it and later
reads get column pruning and filter pushdown. (``DataFrame.checkpoint``
would compute its input twice — once for the count, once for the write —
and store rows, not columns.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from strata.session import ensure_checkpoint_dir


def table_dir(spark, name: str | None = None) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-tables/{name or uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = table_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class Scratch:
    """Stored intermediate results that are removed together, once whatever was made of them is stored itself."""

    def __init__(self, spark):
        self.spark, self.name, self.n = spark, uuid.uuid4().hex, 0

    def store(self, df: DataFrame) -> DataFrame:
        self.n += 1
        return materialize(df, f"{self.name}/{self.n}")

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(table_dir(self.spark, self.name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
