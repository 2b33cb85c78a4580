"""JDBC sink: replace a table with a DataFrame, in batches.

Each partition opens its own connection and inserts ``batchsize`` rows per
round trip; ``num_partitions`` caps the number of concurrent connections
(Spark coalesces to it), so a large table does not flood the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

DEFAULT_BATCH = 5000
MAX_CONNECTIONS = 8


def write_jdbc(df: DataFrame, url: str, table: str, *, batchsize: int = DEFAULT_BATCH,
               num_partitions: int = MAX_CONNECTIONS, mode: str = "overwrite",
               properties: dict | None = None) -> int:
    """Write ``df``; returns the number of rows, observed on their way."""
    written = Observation()
    writer = (df.observe(written, F.count(F.lit(1)).alias("rows")).write.format("jdbc")
              .option("url", url)
              .option("dbtable", table)
              .option("batchsize", str(batchsize))
              .option("isolationLevel", "READ_COMMITTED")
              .option("numPartitions", str(num_partitions)))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
    return written.get["rows"]


def load_tables(tables: dict, url: str, rows: dict | None = None, **opts) -> dict:
    """Write every available table; ``None`` entries (missing inputs) are
    skipped. Returns {name: 'loaded' | 'skipped'}; ``rows``, if given, gets
    the number of rows of each loaded table."""
    status = {}
    for name, df in tables.items():
        if df is None:
            status[name] = "skipped"
            continue
        n = write_jdbc(df, url, name, **opts)
        if rows is not None:
            rows[name] = n
        status[name] = "loaded"
    return status


def read_jdbc(spark, url: str, table: str, properties: dict | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
