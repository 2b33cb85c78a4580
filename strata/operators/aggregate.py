"""Group-by summaries with the source pipeline's null rules.

* rows whose group key has a null part are dropped (pandas ``dropna=True``),
  where Spark would keep a null group;
* ``sum`` over no non-null value is 0, not null;
* ``count`` and ``nunique`` skip nulls (same in Spark).

Aggregates are declared, so Spark plans partial (map-side) aggregation and
splits distinct counts into a (key, value) pre-aggregation: a hot group key
never sends its raw rows to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import any_null


def _agg_expr(fn: str, column: str, dtype: T.DataType | None) -> Column:
    c = F.col(column)
    if fn == "sum":
        e = F.coalesce(F.sum(c), F.lit(0))
    elif fn == "count":
        e = F.count(c)
    elif fn in ("nunique", "count_distinct"):
        e = F.count_distinct(c)
    elif fn == "max":
        e = F.max(c)
    elif fn == "min":
        e = F.min(c)
    else:
        raise ValueError(f"unsupported aggregate {fn}")
    return e.cast(dtype) if dtype is not None else e


def summarise(df: DataFrame, keys, aggs: dict) -> DataFrame:
    """``aggs`` maps output name -> (fn, column) or (fn, column, type)."""
    keys = list(keys)
    exprs = []
    for out, spec in aggs.items():
        fn, column = spec[0], spec[1]
        dtype = spec[2] if len(spec) > 2 else None
        exprs.append(_agg_expr(fn, column, dtype).alias(out))
    return df.where(~any_null(keys)).groupBy(*keys).agg(*exprs)
