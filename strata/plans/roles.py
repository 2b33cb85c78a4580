"""Map the TPC-H-style test tables onto the pipeline's data model.

orders -> orders, customer (+ nation as city) -> customers, validated
lineitem -> order_items and payments, part -> products, supplier (+ nation)
-> sellers, and a three-row category lookup that leaves the other part
types untranslated (so untranslated products drop out of the product
summary, as in the source data).

Money is cast to DECIMAL before any arithmetic so results do not depend on
floating-point evaluation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.validate import validate_keys
from strata.plans.layers import flagged_layer
from strata.sources.raw import ROW_ORDER, with_row_order
from strata.specs import MONEY
from strata.sources.local import local_frame

# The category lookup used with the test tables.
CATEGORY_LOOKUP = [
    ("ECONOMY", "cat_economy"),
    ("SMALL", "cat_small"),
    ("STANDARD", "cat_standard"),
]

LINEITEM_KEYS = ("l_orderkey", "l_linenumber")
# "First" line of a repeated key; ties (none in the test data) fall back to
# file order.
LINEITEM_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")

PRICE = T.DecimalType(12, 2)
RATE = T.DecimalType(4, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_names(spark, sf_dir) -> DataFrame:
    # nation has a fixed domain (25 rows at every scale): safe to broadcast.
    return F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


def validate_table(spark, sf_dir, name: str, keys, order) -> DataFrame:
    """Key validation of a test table; file order breaks ties in ``order``."""
    flagged = validate_keys(with_row_order(table(spark, sf_dir, name)), keys,
                            tuple(order) + ROW_ORDER)
    return flagged.drop(*ROW_ORDER)


def lineitem_flags(spark, sf_dir) -> DataFrame:
    """Validation layer of lineitem: all rows, flagged (stored once)."""
    return flagged_layer(spark, sf_dir, "lineitem", lambda: validate_table(
        spark, sf_dir, "lineitem", LINEITEM_KEYS, LINEITEM_ORDER))


def valid_lineitem(spark, sf_dir) -> DataFrame:
    return lineitem_flags(spark, sf_dir).where(F.col("is_valid")).drop("is_valid", "reject_reason")


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"))


def customers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.join(nation_names(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left") \
        .select(F.col("c_custkey").alias("customer_id"),
                F.col("c_custkey").alias("customer_unique_id"),
                F.col("n_name").alias("customer_city"))


def items_from(valid_li: DataFrame) -> DataFrame:
    return valid_li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        (F.col("l_extendedprice").cast(PRICE) * F.col("l_tax").cast(RATE)).cast(MONEY)
        .alias("freight_value"),
        F.col("l_shipdate").alias("shipping_limit_date"))


def payments_from(valid_li: DataFrame) -> DataFrame:
    return valid_li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        (F.col("l_extendedprice").cast(PRICE) * (F.lit(1).cast(RATE) - F.col("l_discount").cast(RATE)))
        .cast(MONEY).alias("payment_value"))


def products(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_size").alias("product_size"))


def sellers(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.join(nation_names(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"), "left") \
        .select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_city"))


def translation(spark) -> DataFrame:
    return local_frame(
        spark, CATEGORY_LOOKUP, "product_category_name string, product_category_name_english string")


def role_tables(spark: SparkSession, sf_dir: str) -> dict:
    # items and payments both read the stored validation layer
    vli = valid_lineitem(spark, sf_dir)
    return {
        "orders": orders(spark, sf_dir),
        "customers": customers(spark, sf_dir),
        "items": items_from(vli),
        "payments": payments_from(vli),
        "products": products(spark, sf_dir),
        "sellers": sellers(spark, sf_dir),
        "translation": translation(spark),
    }
