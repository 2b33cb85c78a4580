"""High-water-mark incremental load.

* no stored mark: every row loads (rows with a null timestamp included);
* with a mark ``w``: only rows with ``ts > w`` load (strict; null never
  passes, ties at ``w`` never pass);
* the next mark is the max timestamp of the loaded rows; when nothing with
  a timestamp loaded, the old mark is kept (a null mark is never stored).

The filter is a plain comparison, so it reaches the Parquet scan as a
pushed filter and row groups entirely at or below the mark are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK_COLUMN = "last_order_timestamp"


def new_rows(df: DataFrame, ts_col: str, mark=None) -> DataFrame:
    if mark is None:
        return df
    return df.where(F.col(ts_col) > F.lit(mark).cast(df.schema[ts_col].dataType))


def next_mark(loaded: DataFrame, ts_col: str, mark=None, out: str = MARK_COLUMN) -> DataFrame:
    """One-row frame with the mark to store after ``loaded`` is committed."""
    dtype = loaded.schema[ts_col].dataType
    old = F.lit(mark).cast(dtype) if mark is not None else F.lit(None).cast(dtype)
    return loaded.agg(F.coalesce(F.max(ts_col), old).alias(out))


def ingest_incremental(df: DataFrame, ts_col: str, mark=None):
    """(rows to append, one-row frame holding the next mark)."""
    loaded = new_rows(df, ts_col, mark)
    return loaded, next_mark(loaded, ts_col, mark)
