"""The wide business table: orders joined to customers, items, products,
sellers, the category lookup and a per-order payment summary, plus derived
columns and the customer order number.

Join order differs from the source pipeline on purpose (results are equal,
because every right side matches on a column of the preserved side):

* the customer order number is ranked at *order* grain, before items fan
  rows out, and only needs the order and customer columns;
* orders, items and the payment summary all join on ``order_id``, so they
  share one hash partitioning; the payment summary is aggregated first
  (semantics: the order total repeats on every item row);
* dimensions (products with their translation, sellers) join the items while
  those are narrow, so that columns of orders and customers are not shuffled
  by the dimensions' keys. Their size grows with the data, so no broadcast is
  forced: AQE turns a join into a broadcast join only after it has measured
  the side as small. Items without a product or seller have null keys, which
  are spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import floor_days
from strata.operators.rank import dense_rank_by
from strata.specs import MONEY, TECHNICAL_COLUMNS

TOTAL = T.DecimalType(28, 2)


def drop_technical(df: DataFrame) -> DataFrame:
    """Drop pipeline bookkeeping columns; absent ones are ignored."""
    return df.drop(*TECHNICAL_COLUMNS)


def payment_summary(payments: DataFrame) -> DataFrame:
    """One row per order: total paid and number of payments."""
    return payments.groupBy("order_id").agg(
        F.coalesce(F.sum("payment_value"), F.lit(0)).cast(TOTAL).alias("total_payment"),
        F.count("payment_sequential").alias("payment_count"))


def _spread_left_join(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join on ``key``. Rows without a key match nothing; a salt taken
    from ``spread`` deals them out instead of hashing them all to one task."""
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(4096)) + 1).otherwise(F.lit(0))
    right = right.withColumn("_salt", F.lit(0).cast("long"))
    return left.withColumn("_salt", salt.cast("long")).join(right, [key, "_salt"], "left").drop("_salt")


def _after_join(columns: list[str], right: DataFrame, key: str) -> list[str]:
    return [key, *[c for c in columns if c != key], *[c for c in right.columns if c != key]]


def business_dataset(orders: DataFrame, customers: DataFrame, items: DataFrame,
                     payments: DataFrame, products: DataFrame, sellers: DataFrame,
                     translation: DataFrame, *, as_of=None,
                     delivered_col: str = "order_delivered_customer_date",
                     purchase_col: str = "order_purchase_timestamp") -> DataFrame:
    orders, customers, items, payments, products, sellers, translation = (
        drop_technical(t) for t in (orders, customers, items, payments, products,
                                    sellers, translation))
    pay = payment_summary(payments)

    # Order grain: customer columns and the customer order number.
    order_grain = orders.join(customers, "customer_id", "left")
    order_grain = dense_rank_by(order_grain, purchase_col, ["customer_unique_id"],
                                out="customer_order_number")

    # Columns in the order of the source's joins, which put their key first. Sellers' columns that are there
    # already (other than the key) get a suffix, as do those.
    columns = _after_join(_after_join(_after_join(order_grain.columns, items, "order_id"), pay, "order_id"), products, "product_id")
    common = (set(columns) & set(sellers.columns)) - {"seller_id"}
    sellers = sellers.withColumnsRenamed({c: f"{c}_seller" for c in common})
    columns = _after_join(_after_join(columns, sellers, "seller_id"), translation, "product_category_name")

    # Item grain: one row per item, one null-item row for orders without items.
    items = _spread_left_join(items, sellers, "seller_id", "order_id")
    items = _spread_left_join(items, _spread_left_join(products, translation, "product_category_name", "product_id"), "product_id", "order_id")
    fact = (order_grain.join(items, "order_id", "left")
            .join(pay, "order_id", "left"))
    fact = fact.select(*[F.col(c).alias(f"{c}_customer" if c in common else c) for c in columns])

    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast(T.TimestampNTZType())
    return fact.withColumns({
        "order_year": F.year(purchase_col),
        "order_month": F.month(purchase_col),
        "delivery_days": floor_days(delivered_col, purchase_col),
        "item_total": (F.coalesce(F.col("price"), F.lit(0))
                       + F.coalesce(F.col("freight_value"), F.lit(0))).cast(MONEY),
        "transformation_timestamp": stamp,
    })
