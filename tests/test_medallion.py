"""End-to-end layered runs over small raw CSV files of the nine datasets."""

import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.plans import medallion
from strata.sources import jdbc, state, versioned

RAW = {
    "olist_customers_dataset.csv":
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01000,sao paulo,SP\nc2,u2,02000,rio,RJ\nc3,u3,,NA,SP\nc1,u1,01000,sao paulo,SP\n",
    "olist_geolocation_dataset.csv":
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "01000,-23.5,-46.6,sao paulo,SP\n01000,-23.5,-46.6,sao paulo,SP\n02000,bad,-43.2,rio,RJ\n",
    "olist_orders_dataset.csv":
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 10:00:00,2018-01-05 12:00:00,2018-01-10 00:00:00\n"
        "o2,c2,delivered,2018-01-02 11:00:00,,,2018-01-02 09:00:00,2018-01-10 00:00:00\n"
        "o3,c1,shipped,2018-01-03 09:00:00,,,,\n",
    "olist_order_items_dataset.csv":
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2018-01-02 00:00:00,10.50,2.00\no1,2,p2,s1,2018-01-02 00:00:00,5.00,1.00\n"
        "o2,1,p1,s2,2018-01-03 00:00:00,10.50,3.00\n",
    "olist_order_payments_dataset.csv":
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,credit_card,1,10.00\no1,2,voucher,1,8.50\no2,1,boleto,1,13.50\n",
    "olist_order_reviews_dataset.csv":
        "review_id,order_id,review_score,review_creation_date,review_answer_timestamp\n"
        "r1,o1,5,2018-01-06 00:00:00,2018-01-07 10:00:00\n",
    "olist_products_dataset.csv":
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,brinquedos,40,300,1,500,20,10,15\np2,,30,200,2,,10,5,5\n",
    "olist_sellers_dataset.csv":
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,03000,campinas,SP\ns2,04000,niteroi,RJ\n",
    "product_category_name_translation.csv":
        "\ufeffproduct_category_name,product_category_name_english\nbrinquedos,toys\n",
}


def _write_raw(raw_dir, overrides=None):
    os.makedirs(raw_dir, exist_ok=True)
    for name, text in {**RAW, **(overrides or {})}.items():
        with open(os.path.join(raw_dir, name), "w", encoding="utf-8") as f:
            f.write(text)


@pytest.fixture(scope="module")
def runs(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="strata-e2e-", dir="/tmp")
    raw, root = f"{base}/raw", f"{base}/out"
    url = f"jdbc:derby:memory:e2e{uuid.uuid4().hex[:8]};create=true"
    _write_raw(raw)
    r1 = medallion.run(spark, raw, root, as_of="2024-01-01 00:00:00", run_id="RUN_1")
    snap1 = {
        "orders": spark.read.parquet(f"{root}/ingestion/orders").count(),
        "mark": state.read_mark(spark, medallion.Layout(root).mark_path),
        "history": versioned.read_current(spark, f"{root}/scd_type2/product_dimension_history").collect(),
    }
    # second run: one new order, a tracked product change, a customer move
    _write_raw(raw, {
        "olist_orders_dataset.csv": RAW["olist_orders_dataset.csv"]
        + "o4,c2,delivered,2018-02-01 08:00:00,,,2018-02-03 08:00:00,\n"
        + "o0,c2,delivered,2017-12-01 08:00:00,,,,\n",
        "olist_products_dataset.csv": RAW["olist_products_dataset.csv"].replace(
            "p1,brinquedos,40,300,1,500", "p1,brinquedos,40,300,1,650"),
        "olist_customers_dataset.csv": RAW["olist_customers_dataset.csv"].replace(
            "c2,u2,02000,rio,RJ", "c2,u2,02000,niteroi,RJ"),
    })
    r2 = medallion.run(spark, raw, root, as_of="2024-02-01 00:00:00", run_id="RUN_2",
                       jdbc_url=url)
    # third run: nothing changed upstream (a retry)
    r3 = medallion.run(spark, raw, root, as_of="2024-03-01 00:00:00", run_id="RUN_3")
    return dict(spark=spark, root=root, raw=raw, url=url, r1=r1, r2=r2, r3=r3, snap1=snap1)


def test_first_run(runs):
    spark, root, r1, snap1 = runs["spark"], runs["root"], runs["r1"], runs["snap1"]
    assert not r1.failed, r1.errors
    assert snap1["orders"] == 3
    assert snap1["mark"] == "2018-01-03 09:00:00"
    assert {r["product_id"] for r in snap1["history"] if r["is_current"]} == {"p1", "p2"}
    assert r1.counts["validation"]["customers"] == {True: 3, False: 1}


def test_incremental_and_retry(runs):
    spark, root = runs["spark"], runs["root"]
    ing = spark.read.parquet(f"{root}/ingestion/orders")
    # o4 is past the mark; o0 is older than the mark and is not loaded
    assert rows(ing, "order_id") == [("o1",), ("o2",), ("o3",), ("o4",)]
    assert state.read_mark(spark, medallion.Layout(root).mark_path) == "2018-02-01 08:00:00"


def test_silver_types_and_fills(runs):
    spark, root = runs["spark"], runs["root"]
    cust = spark.read.parquet(f"{root}/silver/customers")
    assert rows(cust.where("customer_id = 'c3'"), "customer_city", "customer_zip_code_prefix") == [
        ("Unknown", "Unknown")]
    geo = spark.read.parquet(f"{root}/silver/geolocation")
    assert geo.count() == 2                       # exact copy removed, bad number kept as 0
    assert rows(geo, "geolocation_lat") == [(-23.5,), (0.0,)]
    orders = spark.read.parquet(f"{root}/silver/orders")
    assert dict(orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    o3 = orders.where("order_id = 'o3'").first()
    assert o3["order_delivered_customer_date"] is None
    items = spark.read.parquet(f"{root}/silver/order_items")
    assert dict(items.dtypes)["price"] == "decimal(18,2)"


def test_gold_after_second_run(runs):
    spark, root = runs["spark"], runs["root"]
    bd = spark.read.parquet(f"{root}/gold/business_dataset")
    assert bd.count() == 5                        # o1 x2, o2, o3 (no items), o4 (no items)
    cs = spark.read.parquet(f"{root}/gold/customer_summary")
    assert rows(cs, "customer_unique_id", "customer_city", "total_orders", "total_items",
                "total_spent", "customer_rank") == [
        ("u1", "sao paulo", 2, 2, Decimal("18.50"), 1),
        ("u2", "niteroi", 2, 1, Decimal("13.50"), 2)]
    o2 = bd.where("order_id = 'o2'").first()
    assert o2["delivery_days"] == -1              # delivered 2 hours before purchase
    ps = spark.read.parquet(f"{root}/gold/product_summary")
    assert rows(ps, "product_id", "product_category_name_english") == [("p1", "toys")]


def test_dimensions(runs):
    spark, root = runs["spark"], runs["root"]
    dim1 = versioned.read_current(spark, f"{root}/scd_type1/customer_dimension")
    assert rows(dim1, "customer_id", "customer_city") == [
        ("c1", "sao paulo"), ("c2", "niteroi"), ("c3", "Unknown")]
    hist = versioned.read_current(spark, f"{root}/scd_type2/product_dimension_history")
    got = rows(hist.withColumn("f", F.col("effective_from").cast("string"))
                   .withColumn("t", F.col("effective_to").cast("string")),
               "product_id", "product_weight_g", "f", "t", "is_current")
    # third run changed nothing
    assert got == [
        ("p1", 500.0, "2024-01-01 00:00:00", "2024-02-01 00:00:00", False),
        ("p1", 650.0, "2024-02-01 00:00:00", None, True),
        ("p2", 0.0, "2024-01-01 00:00:00", None, True)]


def test_jdbc_load_and_audit(runs):
    spark, root, url = runs["spark"], runs["root"], runs["url"]
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    assert jdbc.read_jdbc(spark, url, "customer_summary", props).count() == 2
    assert jdbc.read_jdbc(spark, url, "product_dimension_history", props).count() == 3
    audit = medallion.read_audit(spark, medallion.Layout(root))
    assert rows(audit, "run_id", "status") == [("RUN_1", "SUCCESS"), ("RUN_2", "SUCCESS"),
                                               ("RUN_3", "SUCCESS")]
    cat = spark.read.parquet(f"{root}/metadata/catalog")
    got = {(r["dataset_name"], r["layer"]): r["record_count"] for r in cat.collect()}
    assert got[("orders", "ingestion")] == 4
    assert got[("customer_summary", "gold")] == 2
    assert got[("customers", "raw")] == 4


def test_failed_stage_is_audited(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="strata-e2e-fail-", dir="/tmp")
    raw, root = f"{base}/raw", f"{base}/out"
    bad = RAW["olist_sellers_dataset.csv"].replace("seller_id,", "vendor_id,")
    _write_raw(raw, {"olist_sellers_dataset.csv": bad})
    r = medallion.run(spark, raw, root, as_of="2024-01-01 00:00:00", run_id="RUN_F")
    assert r.states["ingestion"] == "failed"
    assert r.states["gold"] == "upstream_failed"
    a = medallion.read_audit(spark, medallion.Layout(root)).first()
    assert a["status"] == "FAILED"
    assert a["error_message"].startswith("Failed tasks: ")


def test_lost_mark_never_replaces_batches(spark):
    """Without its mark, a target that holds later batches is left as it is."""
    import tempfile
    from strata.specs import TableSpec
    base = tempfile.mkdtemp(prefix="strata-mark-", dir="/tmp")
    specs = {"orders": TableSpec("orders", "orders.csv", keys=("id",), incremental_ts="ts")}
    layout = medallion.Layout(f"{base}/out")

    def load(lines):
        os.makedirs(f"{base}/raw", exist_ok=True)
        with open(f"{base}/raw/orders.csv", "w") as f:
            f.write("id,ts\n" + lines)
        return medallion.run_ingestion(spark, f"{base}/raw", layout, specs)
    load("1,2020-01-01 00:00:00\n")
    load("1,2020-01-01 00:00:00\n2,2020-01-02 00:00:00\n")
    os.rename(layout.mark_path, f"{base}/kept")
    with pytest.raises(RuntimeError, match="mark is missing"):
        load("3,2020-01-03 00:00:00\n")
    assert spark.read.parquet(layout.path("ingestion", "orders")).count() == 2


def test_counts_of_stages(runs):
    """Catalog and counters tell valid, rejected and duplicate rows apart."""
    spark, root = runs["spark"], runs["root"]
    cat = {(r["dataset_name"], r["layer"]): r["record_count"] for r in spark.read.parquet(f"{root}/metadata/catalog").collect()}
    layout = medallion.Layout(root)
    assert cat[("customers", "validation")] == medallion.valid_of(spark, layout, "customers").count() == 3
    r1 = runs["r1"]
    silver = r1.counts["silver"]["customers"]
    assert silver["original_rows"] == silver["duplicate_rows"] + silver["final_rows"] == 3
