"""End-to-end layered run over the nine raw CSV datasets.

ingestion -> bronze -> validation (+ rejected) -> silver -> {SCD1, SCD2}
-> business table -> gold summaries -> JDBC load -> catalog -> audit.

Every stage is a DataFrame function from ``strata.operators`` / ``plans``;
this module only wires inputs and outputs. Layers that are rebuilt in full
from an upstream layer are overwritten; the two dimensions (which read
their own previous state) are versioned tables, so a run never overwrites
the data it is reading. Catalog and audit run even after a failed stage.
"""

from __future__ import annotations

import datetime as _dt
import traceback
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.incremental import ingest_incremental, next_mark
from strata.operators.quality import audit_record, catalog, observed_counts
from strata.operators.scd import scd1_merge, scd2_merge
from strata.operators.standardise import standardise
from strata.operators.validate import validate_keys
from strata.plans import business, gold
from strata.sources import jdbc, state, versioned
from strata.sources.present import if_present
from strata.sources.raw import SEQ, read_raw_csv
from strata.functions.scalar import run_id as run_id_expr
from strata.functions.scalar import tolerant_timestamp
from strata.specs import DATASETS, PRODUCT_TRACKED_COLUMNS, TableSpec
from strata.sources.local import local_frame

BATCH = "batch"
INITIAL_BATCH = "b_0"


def batch_label(mark) -> str:
    """Partition label of an incremental batch: text that sorts in load
    order and that partition discovery never mistakes for a number/date."""
    if mark is None:
        return INITIAL_BATCH
    return "b_" + "".join(ch for ch in str(mark) if ch.isalnum())
GOLD_TABLES = ("customer_summary", "product_summary", "monthly_summary", "seller_summary")


@dataclass
class Layout:
    """Where each layer lives under one root directory."""

    root: str

    def path(self, layer: str, name: str = "") -> str:
        base = f"{self.root.rstrip('/')}/{layer}"
        return f"{base}/{name}" if name else base

    @property
    def mark_path(self) -> str:
        return self.path("metadata", "watermark")

    @property
    def audit_path(self) -> str:
        return self.path("audit", "audit_log")


@dataclass
class RunResult:
    run_id: str
    states: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    errors: dict = field(default_factory=dict)

    @property
    def failed(self) -> bool:
        return any(s != "success" for s in self.states.values())


def _stamp(as_of):
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast(T.TimestampType())


# -- stages ------------------------------------------------------------------

def run_ingestion(spark: SparkSession, raw_dir: str, layout: Layout, specs=DATASETS) -> dict:
    """Copy full snapshots; load the incremental dataset past the stored mark.

    The incremental batch is written into its own ``batch=<old mark>``
    partition with dynamic overwrite, so a retried run replaces its batch
    instead of appending it twice; the mark is saved only after the write.
    """
    loaded = {}
    for name, spec in specs.items():
        raw = read_raw_csv(spark, f"{raw_dir.rstrip('/')}/{spec.file}", expected_columns=spec.keys,
                           multi_line=spec.multi_line)
        target = layout.path("ingestion", name)
        if spec.incremental_ts is None:
            raw.write.mode("overwrite").parquet(target)
            loaded[name] = "snapshot"
            continue
        mark = state.read_mark(spark, layout.mark_path)
        if mark is None:
            _refuse_lost_mark(spark, target)
        typed = raw.withColumn("_ts", tolerant_timestamp(spec.incremental_ts))
        batch = batch_label(mark)
        new_rows = ingest_incremental(typed, "_ts", mark)[0].drop("_ts") \
            .withColumn(BATCH, F.lit(batch))
        writer = new_rows.write.mode("overwrite").partitionBy(BATCH)
        if mark is not None:
            # replace only this batch: a retried run rewrites, never duplicates
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(target)
        # the next mark comes from the committed batch (partition-pruned read)
        committed = spark.read.parquet(target).where(F.col(BATCH) == batch) \
            .withColumn("_ts", tolerant_timestamp(spec.incremental_ts))
        state.save_mark(spark, layout.mark_path, next_mark(committed, "_ts", mark))
        loaded[name] = "incremental" if mark is not None else "full"
    return loaded


def _refuse_lost_mark(spark: SparkSession, target: str) -> None:
    """A load without a mark replaces the whole target. That is right for a
    first load and its retry, never for a target that holds later batches."""
    stored = if_present(lambda: spark.read.parquet(target))
    if stored is not None and stored.where(F.col(BATCH) != INITIAL_BATCH).take(1):
        raise RuntimeError(f"{target} holds incremental batches, but their mark is missing")


def run_bronze(spark: SparkSession, layout: Layout, specs=DATASETS, as_of=None) -> None:
    for name, spec in specs.items():
        df = spark.read.parquet(layout.path("ingestion", name))
        df = df.withColumns({"load_timestamp": _stamp(as_of), "source_file": F.lit(spec.file)})
        df.write.mode("overwrite").parquet(layout.path("bronze", name))


def _order_for(spec: TableSpec, df: DataFrame):
    return (BATCH, SEQ) if BATCH in df.columns else (SEQ,)


def run_validation(spark: SparkSession, layout: Layout, specs=DATASETS) -> dict:
    """Flag every row once and store valid and rejected rows in one write,
    partitioned by ``is_valid`` (downstream reads prune to one side)."""
    counts = {}
    for name, spec in specs.items():
        df = spark.read.parquet(layout.path("bronze", name))
        flagged = validate_keys(df, spec.keys, _order_for(spec, df))
        observed, counter = observed_counts(flagged, f"validation_{name}")
        observed.write.mode("overwrite").partitionBy("is_valid").parquet(layout.path("validation", name))
        got = counter.get
        counts[name] = {k: n for k, n in ((True, got["valid_rows"]), (False, got["rejected_rows"])) if n}
    return counts


def _validation(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    df = spark.read.parquet(layout.path("validation", name))
    return df.withColumn("is_valid", F.col("is_valid").cast("boolean"))


def valid_of(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    df = _validation(spark, layout, name)
    return df.where(F.col("is_valid")).drop("is_valid", "reject_reason")


def rejected_of(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    df = _validation(spark, layout, name)
    return df.where(~F.col("is_valid")).drop("is_valid")


def run_silver(spark: SparkSession, layout: Layout, specs=DATASETS, as_of=None) -> dict:
    """Rows of each dataset before and after removing duplicates, counted on
    their way, and the declared columns that it lacks."""
    out = {}
    for name, spec in specs.items():
        report, before, after = [], Observation(), Observation()
        rows = F.count(F.lit(1)).alias("rows")
        valid = valid_of(spark, layout, name).observe(before, rows)
        df = standardise(valid, spec, as_of=as_of, report=report).observe(after, rows)
        df.write.mode("overwrite").parquet(layout.path("silver", name))
        original, final = before.get["rows"], after.get["rows"]
        out[name] = {"original_rows": original, "duplicate_rows": original - final, "final_rows": final}
        if report:
            out[name]["unmatched"] = report
    return out


def silver(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return spark.read.parquet(layout.path("silver", name)).drop(SEQ, BATCH)


def run_scd1(spark: SparkSession, layout: Layout) -> str:
    base = layout.path("scd_type1", "customer_dimension")
    old = versioned.read_current(spark, base)
    new = business.drop_technical(silver(spark, layout, "customers"))
    return versioned.write_version(scd1_merge(old, new, ["customer_id"]), base)


def run_scd2(spark: SparkSession, layout: Layout, as_of=None) -> str:
    base = layout.path("scd_type2", "product_dimension_history")
    hist = versioned.read_current(spark, base)
    snap = business.drop_technical(silver(spark, layout, "products"))
    if as_of is None:
        as_of = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    merged = scd2_merge(hist, snap, "product_id", PRODUCT_TRACKED_COLUMNS, as_of=as_of)
    return versioned.write_version(merged, base, partition_by=["is_current"])


def run_business(spark: SparkSession, layout: Layout, as_of=None) -> None:
    t = {n: silver(spark, layout, n) for n in
         ("orders", "customers", "order_items", "payments", "products", "sellers",
          "category_translation")}
    bd = business.business_dataset(
        t["orders"], t["customers"], t["order_items"], t["payments"], t["products"],
        t["sellers"], t["category_translation"], as_of=as_of)
    bd.write.mode("overwrite").parquet(layout.path("gold", "business_dataset"))


def run_gold(spark: SparkSession, layout: Layout) -> None:
    bd = spark.read.parquet(layout.path("gold", "business_dataset"))
    out = {
        "customer_summary": gold.customer_summary(bd),
        "product_summary": gold.product_summary(bd),
        "monthly_summary": gold.monthly_summary(bd),
        "seller_summary": gold.seller_summary(bd),
    }
    for name, df in out.items():
        df.write.mode("overwrite").parquet(layout.path("gold", name))


def load_targets(spark: SparkSession, layout: Layout) -> dict:
    """The seven tables handed to the database; those that have never been
    written are None. A table that cannot be read is an error."""
    def read(path):
        return if_present(lambda: spark.read.parquet(path))
    out = {n: read(layout.path("gold", n)) for n in ("business_dataset",) + GOLD_TABLES}
    out["customer_dimension"] = versioned.read_current(
        spark, layout.path("scd_type1", "customer_dimension"))
    out["product_dimension_history"] = versioned.read_current(
        spark, layout.path("scd_type2", "product_dimension_history"))
    return out


def run_load(spark: SparkSession, layout: Layout, url: str, **opts) -> dict:
    """Rows written to each table; None for one that was skipped."""
    rows = {}
    status = jdbc.load_tables(load_targets(spark, layout), url, rows=rows, **opts)
    return {name: rows.get(name) for name in status}


def catalog_entries(spark: SparkSession, layout: Layout, raw_dir: str, specs=DATASETS):
    entries = [(n, "raw", f"{raw_dir.rstrip('/')}/{s.file}", "csv") for n, s in specs.items()]
    for layer in ("ingestion", "bronze", "silver"):
        entries += [(n, layer, layout.path(layer, n), "parquet") for n in specs]
    # the validation layer stores rejected rows beside the valid ones
    entries += [(n, "validation", layout.path("validation", n), "parquet", "cast(is_valid as boolean)") for n in specs]
    for layer, name in (("scd_type1", "customer_dimension"),
                        ("scd_type2", "product_dimension_history")):
        v = versioned.current_version(spark, layout.path(layer, name))
        if v is not None:
            entries.append((name, layer, f"{layout.path(layer, name)}/v_{v}", "parquet"))
    entries += [(n, "gold", layout.path("gold", n), "parquet")
                for n in ("business_dataset",) + GOLD_TABLES]
    return entries


def _exists(spark, path):
    return if_present(lambda: spark.read.parquet(path)) is not None


def run_catalog(spark: SparkSession, layout: Layout, raw_dir: str, specs=DATASETS, as_of=None):
    entries = [e for e in catalog_entries(spark, layout, raw_dir, specs)
               if e[3] == "csv" or _exists(spark, e[2])]
    one_line = {e[2] for e in entries if e[3] == "csv" and not specs[e[0]].multi_line}
    df = catalog(spark, entries, as_of=as_of, one_line=one_line)
    df.write.mode("overwrite").parquet(layout.path("metadata", "catalog"))
    return df


def run_audit(spark: SparkSession, layout: Layout, result: RunResult, start, end) -> DataFrame:
    stages = local_frame(spark, list(result.states.items()), "task_id string, state string")
    rec = audit_record(stages, result.run_id, start, end)
    if result.errors:
        detail = "; ".join(f"{k}: {v}" for k, v in sorted(result.errors.items()))
        rec = rec.withColumn("error_detail", F.lit(detail))
    rec.write.mode("append").option("mergeSchema", "true").parquet(layout.audit_path)
    return rec


def read_audit(spark: SparkSession, layout: Layout) -> DataFrame:
    """Audit log; columns evolve by union, missing text reads as empty."""
    return spark.read.option("mergeSchema", "true").parquet(layout.audit_path).na.fill("")


# -- the run -----------------------------------------------------------------

STAGES = ("ingestion", "bronze", "validation", "silver", "scd_type1", "scd_type2",
          "business_transformation", "gold", "load_postgres")


def run(spark: SparkSession, raw_dir: str, root: str, *, jdbc_url: str | None = None,
        as_of=None, run_id: str | None = None, specs=DATASETS) -> RunResult:
    layout = Layout(root)
    start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if run_id is None:
        run_id = spark.range(1).select(
            run_id_expr(F.lit(start.isoformat(sep=" ")).cast(T.TimestampType()),
                        F.lit(uuid.uuid4().hex[:5])).alias("r")).first()["r"]
    result = RunResult(run_id)
    steps = {
        "ingestion": lambda: run_ingestion(spark, raw_dir, layout, specs),
        "bronze": lambda: run_bronze(spark, layout, specs, as_of),
        "validation": lambda: run_validation(spark, layout, specs),
        "silver": lambda: run_silver(spark, layout, specs, as_of),
        "scd_type1": lambda: run_scd1(spark, layout),
        "scd_type2": lambda: run_scd2(spark, layout, as_of),
        "business_transformation": lambda: run_business(spark, layout, as_of),
        "gold": lambda: run_gold(spark, layout),
        "load_postgres": (lambda: run_load(spark, layout, jdbc_url)) if jdbc_url else None,
    }
    # upstream of each stage (the task graph of the source pipeline)
    needs = {"bronze": ["ingestion"], "validation": ["bronze"], "silver": ["validation"],
             "scd_type1": ["silver"], "scd_type2": ["silver"],
             "business_transformation": ["scd_type1", "scd_type2"],
             "gold": ["business_transformation"], "load_postgres": ["gold"]}
    for name in STAGES:
        fn = steps[name]
        if fn is None:
            continue
        if any(result.states.get(u) != "success" for u in needs.get(name, [])):
            result.states[name] = "upstream_failed"
            continue
        try:
            out = fn()
            result.states[name] = "success"
            if out is not None:
                result.counts[name] = out
        except Exception as exc:  # recorded in the audit, run goes on
            result.states[name] = "failed"
            result.errors[name] = f"{type(exc).__name__}: {exc}".splitlines()[0]
            traceback.print_exc()
    try:
        run_catalog(spark, layout, raw_dir, specs, as_of)
        result.states["metadata"] = "success"
    except Exception as exc:
        result.states["metadata"] = "failed"
        result.errors["metadata"] = f"{type(exc).__name__}: {exc}".splitlines()[0]
    end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run_audit(spark, layout, result, start.isoformat(sep=" "), end.isoformat(sep=" "))
    return result
