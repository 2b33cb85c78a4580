import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from strata.plans import business, gold
from strata.plans.business import business_dataset


def _tables(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "2018-01-01 10:00:00", "2018-01-05 09:00:00"),
         ("o2", "c1", "2018-01-03 10:00:00", None),
         ("o3", "c2", "2018-02-01 10:00:00", "2018-02-01 08:00:00")],
        "order_id string, customer_id string, order_purchase_timestamp string, "
        "order_delivered_customer_date string")
    for c in ("order_purchase_timestamp", "order_delivered_customer_date"):
        orders = orders.withColumn(c, orders[c].cast("timestamp_ntz"))
    customers = spark.createDataFrame([("c1", "u1", "sp"), ("c2", "u2", "rj")],
                                      "customer_id string, customer_unique_id string, customer_city string")
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.00")),
         ("o1", 2, "p2", "s1", Decimal("5.00"), Decimal("0.50")),
         ("o3", 1, "p1", "s2", Decimal("7.00"), None)],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price decimal(18,2), freight_value decimal(18,2)")
    payments = spark.createDataFrame(
        [("o1", 1, Decimal("6.00")), ("o1", 2, Decimal("6.00")), ("o1", 3, Decimal("4.50")),
         ("o3", 1, Decimal("7.00"))],
        "order_id string, payment_sequential int, payment_value decimal(18,2)")
    products = spark.createDataFrame([("p1", "toys"), ("p2", "misc")],
                                     "product_id string, product_category_name string")
    sellers = spark.createDataFrame([("s1", "sp"), ("s2", "bh")], "seller_id string, seller_city string")
    translation = spark.createDataFrame([("toys", "Toys")],
                                        "product_category_name string, product_category_name_english string")
    return orders, customers, items, payments, products, sellers, translation


def test_business_rows(spark):
    bd = business_dataset(*_tables(spark), as_of="2024-01-01 00:00:00")
    got = rows(bd, "order_id", "order_item_id", "item_total", "total_payment", "payment_count",
               "customer_order_number", "delivery_days", "product_category_name_english")
    assert got == [
        ("o1", 1, Decimal("11.00"), Decimal("16.50"), 3, 1, 3, "Toys"),
        ("o1", 2, Decimal("5.50"), Decimal("16.50"), 3, 1, 3, None),
        # order without items: one row, item_total 0, no product
        ("o2", None, Decimal("0.00"), None, None, 2, None, None),
        # delivered 2 hours before purchase: floor gives -1
        ("o3", 1, Decimal("7.00"), Decimal("7.00"), 1, 1, -1, "Toys"),
    ]


def test_gold_summaries(spark):
    bd = business_dataset(*_tables(spark), as_of="2024-01-01 00:00:00")
    cs = gold.customer_summary(bd)
    assert rows(cs, "customer_unique_id", "total_orders", "total_items", "total_spent", "customer_rank") == [
        ("u1", 2, 2, Decimal("16.50"), 1), ("u2", 1, 1, Decimal("7.00"), 2)]
    ps = gold.product_summary(bd)
    # p2 has no translation: its group key is null and it is dropped
    assert rows(ps, "product_id", "total_orders", "total_units", "total_sales") == [
        ("p1", 2, 2, Decimal("17.00"))]
    ms = gold.monthly_summary(bd)
    assert rows(ms, "order_year", "order_month", "total_orders", "total_customers", "total_revenue") == [
        (2018, 1, 2, 1, Decimal("16.50")), (2018, 2, 1, 1, Decimal("7.00"))]
    ss = gold.seller_summary(bd)
    assert rows(ss, "seller_id", "total_orders", "total_items") == [("s1", 1, 2), ("s2", 1, 1)]
    top = gold.top_customers(cs, 1).collect()
    assert [r["customer_unique_id"] for r in top] == ["u1"]


def test_dimensions_join_narrow_items(spark, monkeypatch):
    """No column of orders or customers goes through a join with a dimension; clashing names keep their suffixes."""
    orders, customers, items, payments, products, sellers, translation = _tables(spark)
    joined, real = [], business._spread_left_join
    monkeypatch.setattr(business, "_spread_left_join", lambda left, *more: joined.append(left.columns) or real(left, *more))
    bd = business.business_dataset(orders, customers.withColumn("zip", F.lit("c")), items, payments, products, sellers.withColumn("zip", F.lit("s")), translation, as_of="2024-01-01 00:00:00")
    assert len(joined) == 3 and not any({"customer_id", "customer_city", "total_payment"} & set(c) for c in joined)
    assert bd.columns[:4] == ["product_category_name", "seller_id", "product_id", "order_id"]
    assert rows(bd, "order_id", "zip_customer", "zip_seller", "seller_city") == [
        ("o1", "c", "s", "sp"), ("o1", "c", "s", "sp"), ("o2", "c", None, None), ("o3", "c", "s", "bh")]
