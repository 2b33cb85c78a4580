"""Registered queries over the test tables, one per operator family.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
whole tables. Timestamps that the pipeline would take from the clock are
fixed here (``AS_OF`` ...) so results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import any_null, floor_days, tolerant_number, tolerant_timestamp
from strata.operators.incremental import ingest_incremental
from strata.operators.quality import audit_record, catalog, validation_counts
from strata.operators.rank import dense_rank_by
from strata.operators.scd import EFFECTIVE_FROM, not_in_current, scd1_merge, scd2_merge
from strata.operators.standardise import dedup_text, fill_defaults
from strata.operators.validate import split_valid, validate_keys
from strata.operators.versions import dimension, version_changes
from strata.plans import business, gold, medallion, roles
from strata.plans.layers import stored_layer
from strata.plans.roles import LINEITEM_KEYS, table
from strata.sources import parts
from strata.sources.checkpoint import materialize, table_dir
from strata.sources.raw import read_raw_csv
from strata.specs import TableSpec
from strata.streaming import dimensions
from strata.streaming.ingest import dedup_stream, ingest_stream, read_stream

# Fixed query parameters.
HWM_MARK = "2000-01-01 00:00:00"        # stored high-water mark for S_HWM / S_MAX
SNAPSHOT_CUT = "1995-06-30 00:00:00"    # first dimension load sees data up to here
AS_OF = "2024-01-01 00:00:00"           # clock of the first run
AS_OF_2 = "2024-02-01 00:00:00"         # clock of the second run
DAYS_FROM = "2024-01-15 12:00:00"       # reference instant for X8
RUN_ID = "RUN_20240101_000000_0a1b2"
RUN_END = "2024-01-01 00:12:34"
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def _ts(s):
    return F.lit(s).cast(T.TimestampNTZType())


# -- business and gold -------------------------------------------------------

def business_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business layer (built once per application, then read)."""
    def build():
        t = roles.role_tables(spark, sf_dir)
        return business.business_dataset(
            t["orders"], t["customers"], t["items"], t["payments"], t["products"],
            t["sellers"], t["translation"], as_of=AS_OF, delivered_col="shipping_limit_date")
    return stored_layer(spark, sf_dir, "gold/business_dataset", build)


def q_b1(spark, sf_dir):
    return business_table(spark, sf_dir)


def customer_summary_layer(spark, sf_dir):
    return stored_layer(spark, sf_dir, "gold/customer_summary",
                        lambda: gold.customer_summary(business_table(spark, sf_dir)))


def q_g1(spark, sf_dir):
    return customer_summary_layer(spark, sf_dir)


def q_g2(spark, sf_dir):
    return gold.product_summary(business_table(spark, sf_dir))


def q_g3(spark, sf_dir):
    return gold.monthly_summary(business_table(spark, sf_dir))


def q_g4(spark, sf_dir):
    return gold.seller_summary(business_table(spark, sf_dir))


def q_o1(spark, sf_dir):
    return gold.top_customers(customer_summary_layer(spark, sf_dir), 10)


def q_a1(spark, sf_dir):
    return business.payment_summary(roles.payments_from(roles.valid_lineitem(spark, sf_dir)))


def q_j5(spark, sf_dir):
    p = roles.products(spark, sf_dir).select("product_id", "product_category_name")
    return p.join(roles.translation(spark), "product_category_name", "left") \
        .select("product_id", "product_category_name", "product_category_name_english")


def q_p1(spark, sf_dir):
    """Technical columns stamped and stored at load, then dropped before business use."""
    stored = stamped_orders(spark, sf_dir)
    kept = business.drop_technical(stored)
    return kept.withColumn("dropped_columns", F.lit(len(stored.columns) - len(kept.columns)))


def stamped_orders(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return materialize(o.withColumns({
        "load_timestamp": F.current_timestamp(),
        "source_file": F.col("_metadata.file_name"),
        "silver_timestamp": F.current_timestamp(),
    }))


def q_s13(spark, sf_dir):
    """Rows and stamps by source file, from the stored layer."""
    return stamped_orders(spark, sf_dir).groupBy(F.regexp_extract("source_file", r"[^/]+$", 0).alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("load_timestamp").alias("stamped"))


# -- raw files ---------------------------------------------------------------

def conversations_csv(spark, sf_dir) -> str:
    """The conversations as quoted CSV files; texts hold line ends."""
    path = table_dir(spark)
    table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").write.options(
        header=True, escape='"', quoteAll=True).csv(path)
    return path


def q_s1(spark, sf_dir):
    return read_raw_csv(spark, conversations_csv(spark, sf_dir), with_seq=False)


def q_t1(spark, sf_dir):
    """The same files through the ingest stream, columns asked for in another order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "role", "turn", "conv_id")])
    out = table_dir(spark)
    ingest_stream(spark, conversations_csv(spark, sf_dir), schema, out, table_dir(spark), fmt="csv").awaitTermination()
    return spark.read.parquet(out).select("conv_id", "turn", "role", "text")


def q_s8(spark, sf_dir):
    """Two incremental loads of the orders: the batch that each row came with."""
    spec = {"orders": TableSpec("orders", "orders.csv", keys=("o_orderkey",), incremental_ts="o_orderdate")}
    layout = medallion.Layout(table_dir(spark))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    for rows in (o.where(F.col("o_orderdate") <= SNAPSHOT_CUT), o):
        raw = table_dir(spark)
        rows.write.options(header=True, escape='"').csv(f"{raw}/orders.csv")
        medallion.run_ingestion(spark, raw, layout, spec)
    stored = spark.read.parquet(layout.path("ingestion", "orders"))
    return stored.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderdate", F.col(medallion.BATCH).alias("load_batch"))


# -- validation --------------------------------------------------------------

def lineitem_flags(spark, sf_dir):
    return roles.lineitem_flags(spark, sf_dir)


def q_v1(spark, sf_dir):
    return split_valid(lineitem_flags(spark, sf_dir))[0]


def q_v2(spark, sf_dir):
    return split_valid(lineitem_flags(spark, sf_dir))[1]


def q_v3(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_id"))
        .alias("event_key"))
    return split_valid(validate_keys(ev, ["event_key"], ["event_id"]))[1]


def q_c2(spark, sf_dir):
    return validation_counts(lineitem_flags(spark, sf_dir))


# -- standardisation ---------------------------------------------------------

def _two_dp(c):
    return F.format_string("%.2f", F.col(c))


def events_text(spark, sf_dir):
    """The events table as raw text, the way a CSV landing would hold it."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "error", F.lit("not a date"))
         .when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd"))
         .when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_text"),
        F.when(F.col("event_type") == "error", F.lit("bad"))
         .when(F.col("event_type") == "view", F.concat(F.lit(" "), _two_dp("value"), F.lit(" ")))
         .when(F.col("event_type") == "signup", F.concat(_two_dp("value"), F.lit("d")))
         .otherwise(_two_dp("value")).alias("value_text"))


def q_u1(spark, sf_dir):
    return dedup_text(events_text(spark, sf_dir).select("user_id", "event_type", "k"))


def q_x2(spark, sf_dir):
    return events_text(spark, sf_dir).select(
        "event_id", "ts_text", tolerant_timestamp("ts_text").alias("ts"))


def q_x3(spark, sf_dir):
    return events_text(spark, sf_dir).select(
        "event_id", "value_text", tolerant_number("value_text", T.DoubleType()).alias("value"))


def q_x4(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    holed = o.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_orderdate"))
        .alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"))
    return fill_defaults(holed)


def q_x8(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", floor_days("ts", _ts(DAYS_FROM)).alias("delta_days"))


# -- windows -----------------------------------------------------------------

def q_w1(spark, sf_dir, **options):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(F.col("l_suppkey"))
        .alias("seller_key"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_shipdate"))
        .alias("ship_ts"))
    return dense_rank_by(li, "ship_ts", ["seller_key"], out="ship_number", **options)


def q_w1_pieces(spark, sf_dir):
    """The same rank from many small pieces."""
    return q_w1(spark, sf_dir, bucket_rows=500)


def q_w2(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return dense_rank_by(c, "c_acctbal", ascending=False, out="acctbal_rank")


# -- incremental load --------------------------------------------------------

def q_s_hwm(spark, sf_dir):
    return ingest_incremental(table(spark, sf_dir, "orders"), "o_orderdate", HWM_MARK)[0]


def q_s_max(spark, sf_dir):
    return ingest_incremental(table(spark, sf_dir, "orders"), "o_orderdate", HWM_MARK)[1]


# -- dimensions --------------------------------------------------------------

def customer_snapshot(spark, sf_dir, first: bool) -> DataFrame:
    """Customers active in one load batch (orders up to / after the cut)."""
    o = table(spark, sf_dir, "orders")
    cut = _ts(SNAPSHOT_CUT)
    o = o.where(F.col("o_orderdate") <= cut) if first else o.where(F.col("o_orderdate") > cut)
    act = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.max("o_orderdate").alias("last_order_date"),
        F.count(F.lit(1)).alias("orders_in_batch"))
    c = roles.customers(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"))
    return act.join(c, "customer_id").join(cust, "customer_id").select(
        "customer_id", "customer_unique_id", "customer_name", "customer_segment",
        "customer_city", "last_order_date", "orders_in_batch")


def q_d1(spark, sf_dir):
    old = customer_snapshot(spark, sf_dir, True)
    new = customer_snapshot(spark, sf_dir, False)
    return scd1_merge(old, new, ["customer_id"])


PRODUCT_TRACKED = ("product_category_name", "product_size", "main_seller")


def product_snapshot(spark, sf_dir, first: bool) -> DataFrame:
    """Products shipped in one load batch; ``main_seller`` is the lowest
    supplier key that shipped the product in that batch."""
    li = table(spark, sf_dir, "lineitem")
    cut = _ts(SNAPSHOT_CUT)
    li = li.where(F.col("l_shipdate") <= cut) if first else li.where(F.col("l_shipdate") > cut)
    sold = li.groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.min("l_suppkey").alias("main_seller"))
    return sold.join(roles.products(spark, sf_dir), "product_id").select(
        "product_id", "product_category_name", "product_brand", "product_size", "main_seller")


def product_history_first(spark, sf_dir):
    return scd2_merge(None, product_snapshot(spark, sf_dir, True), "product_id",
                      PRODUCT_TRACKED, as_of=AS_OF)


def q_d2(spark, sf_dir):
    hist = product_history_first(spark, sf_dir)
    return scd2_merge(hist, product_snapshot(spark, sf_dir, False), "product_id",
                      PRODUCT_TRACKED, as_of=AS_OF_2)


def q_j7(spark, sf_dir):
    return not_in_current(product_snapshot(spark, sf_dir, False),
                          product_history_first(spark, sf_dir), "product_id")


def q_d2_commits(spark, sf_dir):
    """The history of D2 by event time, kept by commits of changes only."""
    base = table_dir(spark)
    for first, at in ((True, AS_OF), (False, AS_OF_2)):
        snapshot = materialize(product_snapshot(spark, sf_dir, first).withColumn("_at", _ts(at)))
        stored = parts.read(spark, base, parts.touched(spark, base, snapshot))
        rows, gone = version_changes(stored, snapshot, "product_id", "_at", PRODUCT_TRACKED)
        parts.commit(rows, base, ["product_id"], ["product_id", EFFECTIVE_FROM], gone)
    return dimension(parts.read(spark, base)).drop("_at")


ARRIVALS = 3  # parts in which the change rows of the streaming queries arrive


def streamed_orders(spark, sf_dir, process) -> None:
    """Orders as change rows of their customers, in several arrivals dealt by hash, so that event times come in no order;
    ``process`` runs a stream over what has arrived."""
    source = table_dir(spark)
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    for i in range(ARRIVALS):
        o.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(ARRIVALS)) == i).write.mode("append").parquet(source)
        process(read_stream(spark, source, o.schema))


def q_t4_scd1(spark, sf_dir):
    """The newest order of every customer, whenever it arrives."""
    target, checkpoint = table_dir(spark), table_dir(spark)
    apply = dimensions.scd1_foreach_batch(target, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    streamed_orders(spark, sf_dir, lambda s: dimensions.start_dimension_stream(s, apply, checkpoint).awaitTermination())
    return dimensions.read_scd1(spark, target)


def q_t4_scd2(spark, sf_dir):
    """Every customer's versions of order priority, by order date."""
    target, checkpoint = table_dir(spark), table_dir(spark)
    apply = dimensions.scd2_foreach_batch(target, "o_custkey", ["o_orderpriority"], ["o_orderkey"], as_of_col="o_orderdate")
    streamed_orders(spark, sf_dir, lambda s: dimensions.start_dimension_stream(s, apply, checkpoint).awaitTermination())
    return dimensions.read_scd2(spark, target).drop("o_orderdate")


def q_t3(spark, sf_dir):
    """Orders that arrive twice through the deduplicating stream: each comes out once."""
    source, target, checkpoint = table_dir(spark), table_dir(spark), table_dir(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    for _ in range(2):
        o.write.mode("append").parquet(source)
    stream = dedup_stream(read_stream(spark, source, o.schema), ["o_orderkey"], "o_orderdate", "1 hour")
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target, format="parquet").awaitTermination()
    return spark.read.parquet(target)


# -- catalog and audit -------------------------------------------------------

def q_c3(spark, sf_dir):
    entries = [(t, "testdata", f"{sf_dir}/{t}.parquet", "parquet") for t in DRIVER_TABLES]
    return catalog(spark, entries, as_of=AS_OF)


KEYED_TABLES = (
    ("customer", ("c_custkey",)),
    ("orders", ("o_orderkey",)),
    ("lineitem", LINEITEM_KEYS),
    ("part", ("p_partkey",)),
    ("supplier", ("s_suppkey",)),
)


def stage_states(spark, sf_dir) -> DataFrame:
    """One status row per validation task: failed when it rejects rows, that
    is when a table has more rows than different keys without a null."""
    rows = []
    for name, keys in KEYED_TABLES:
        per_key = table(spark, sf_dir, name).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        counts = per_key.agg(F.sum("n").alias("rows"), F.sum(F.when(any_null(keys), 0).otherwise(1)).alias("valid"))
        rows.append(counts.select(
            F.lit(f"validate_{name}").alias("task_id"),
            F.when(F.col("rows") > F.col("valid"), F.lit("failed")).otherwise(F.lit("success"))
            .alias("state")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def q_c4(spark, sf_dir):
    return audit_record(stage_states(spark, sf_dir), RUN_ID, AS_OF, RUN_END)


QUERIES = {
    "S_HWM": q_s_hwm, "S_MAX": q_s_max,
    "V1": q_v1, "V2": q_v2, "V3": q_v3,
    "U1": q_u1, "X2": q_x2, "X3": q_x3, "X4": q_x4, "X8": q_x8,
    "S1": q_s1, "S8": q_s8, "S13": q_s13, "T1": q_t1, "W1_pieces": q_w1_pieces,
    "P1": q_p1, "A1": q_a1, "B1": q_b1, "J5": q_j5, "J7": q_j7,
    "W1": q_w1, "W2": q_w2,
    "G1": q_g1, "G2": q_g2, "G3": q_g3, "G4": q_g4, "O1": q_o1,
    "D1": q_d1, "D2": q_d2, "D2_commits": q_d2_commits,
    "T3": q_t3, "T4_scd1": q_t4_scd1, "T4_scd2": q_t4_scd2,
    "C2": q_c2, "C3": q_c3, "C4": q_c4,
}
