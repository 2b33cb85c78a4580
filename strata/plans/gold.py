"""Gold summaries over the business table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.aggregate import summarise
from strata.operators.rank import dense_rank_by
from strata.sources.checkpoint import materialize

TOTAL = T.DecimalType(28, 2)


def customer_summary(bd: DataFrame, materialize_summary: bool = True, **rank_opts) -> DataFrame:
    s = summarise(bd, ["customer_unique_id", "customer_city"], {
        "total_orders": ("nunique", "order_id"),
        "total_items": ("count", "order_item_id"),
        "total_spent": ("sum", "item_total", TOTAL),
    })
    # The rank reads the summary twice (distinct values, join back):
    # materialise it once instead of recomputing the business table.
    if materialize_summary:
        s = materialize(s)
    # Global dense rank, highest spend first, without a one-task sort.
    return dense_rank_by(s, "total_spent", ascending=False, out="customer_rank", **rank_opts)


def product_summary(bd: DataFrame) -> DataFrame:
    return summarise(bd, ["product_id", "product_category_name_english"], {
        "total_orders": ("nunique", "order_id"),
        "total_units": ("count", "order_item_id"),
        "total_sales": ("sum", "price", TOTAL),
    })


def monthly_summary(bd: DataFrame) -> DataFrame:
    return summarise(bd, ["order_year", "order_month"], {
        "total_orders": ("nunique", "order_id"),
        "total_customers": ("nunique", "customer_unique_id"),
        "total_revenue": ("sum", "item_total", TOTAL),
    })


def seller_summary(bd: DataFrame) -> DataFrame:
    return summarise(bd, ["seller_id", "seller_city"], {
        "total_orders": ("nunique", "order_id"),
        "total_items": ("count", "order_item_id"),
        "total_sales": ("sum", "price", TOTAL),
    })


def top_customers(summary: DataFrame, k: int = 10) -> DataFrame:
    """The documented consumer query: best ``k`` customers by rank.

    Ties on the rank are broken by the customer key so the top-k is stable.
    Plans as TakeOrderedAndProject (per-partition top-k, then merge).
    """
    return summary.orderBy(F.col("customer_rank").asc(), F.col("customer_unique_id").asc(),
                           F.col("customer_city").asc()).limit(k)
