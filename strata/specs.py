"""Dataset registry: file names, keys, ordering and declared types.

Every stage reads this registry instead of listing directories, so stale
files in a layer are never picked up.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for identical results).
# ---------------------------------------------------------------------------

# Text tokens read as null from raw CSV (the pandas default NA set).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Columns added by the pipeline itself, removed before business joins.
TECHNICAL_COLUMNS = ("load_timestamp", "batch_id", "source_file", "silver_timestamp")

# Fill value for missing text after standardisation.
UNKNOWN_TEXT = "Unknown"

# Product attributes whose change opens a new SCD2 version.
PRODUCT_TRACKED_COLUMNS = (
    "product_category_name",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)

# Default name written into the audit table (``audit_record`` takes another).
PIPELINE_NAME = "Medallion Data Pipeline"

# Timestamp text formats accepted by the tolerant parser, tried in order.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")

# Task states that make a run count as failed.
FAILED_STATES = ("failed", "upstream_failed")

# Layers listed in the file catalog, in catalog order.
CATALOG_LAYERS = ("raw", "ingestion", "bronze", "validation", "silver",
                  "scd_type1", "scd_type2", "gold")

MONEY = T.DecimalType(18, 2)


@dataclass(frozen=True)
class TableSpec:
    """One source dataset of the pipeline."""

    name: str
    file: str
    keys: tuple = ()
    dates: tuple = ()
    numbers: dict = field(default_factory=dict)  # column -> Spark type
    incremental_ts: str | None = None            # high-water-mark column
    multi_line: bool = False                     # CSV fields may hold line ends

    def text_columns(self, columns):
        typed = set(self.dates) | set(self.numbers)
        return [c for c in columns if c not in typed]


# The nine source datasets with the landing file names of the
# input data, their keys and declared silver types.
DATASETS = {
    "customers": TableSpec(
        "customers", "olist_customers_dataset.csv", keys=("customer_id",)),
    "geolocation": TableSpec(
        "geolocation", "olist_geolocation_dataset.csv",
        numbers={"geolocation_lat": T.DoubleType(), "geolocation_lng": T.DoubleType()}),
    "orders": TableSpec(
        "orders", "olist_orders_dataset.csv", keys=("order_id",),
        dates=("order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date",
               "order_estimated_delivery_date"),
        incremental_ts="order_purchase_timestamp"),
    "order_items": TableSpec(
        "order_items", "olist_order_items_dataset.csv", keys=("order_id", "order_item_id"),
        dates=("shipping_limit_date",),
        numbers={"order_item_id": T.IntegerType(), "price": MONEY, "freight_value": MONEY}),
    "payments": TableSpec(
        "payments", "olist_order_payments_dataset.csv", keys=("order_id", "payment_sequential"),
        numbers={"payment_sequential": T.IntegerType(), "payment_installments": T.IntegerType(),
                 "payment_value": MONEY}),
    "reviews": TableSpec(
        "reviews", "olist_order_reviews_dataset.csv", keys=("review_id",),
        dates=("review_creation_date", "review_answer_timestamp"), multi_line=True),
    "products": TableSpec(
        "products", "olist_products_dataset.csv", keys=("product_id",),
        numbers={"product_name_length": T.IntegerType(),
                 "product_description_length": T.IntegerType(),
                 "product_photos_qty": T.IntegerType(),
                 "product_weight_g": T.DoubleType(), "product_length_cm": T.DoubleType(),
                 "product_height_cm": T.DoubleType(), "product_width_cm": T.DoubleType()}),
    "sellers": TableSpec(
        "sellers", "olist_sellers_dataset.csv", keys=("seller_id",)),
    "category_translation": TableSpec(
        "category_translation", "product_category_name_translation.csv",
        keys=("product_category_name",)),
}
