"""Keep one row per key: the last one by an ordering.

``last_per_key`` is a partial aggregate (``max`` of a struct led by the
ordering columns), so a key with millions of rows is reduced map-side
instead of being sorted inside one task, as a row_number window would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                          *[F.col(c).alias(c) for c in rest])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys, order_by) -> DataFrame:
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                          *[F.col(c).alias(c) for c in rest])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)
