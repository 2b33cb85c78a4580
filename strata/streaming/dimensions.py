"""Keep SCD1 / SCD2 dimensions up to date from a stream of changed rows, by event time.

A dimension is a table of ``strata.sources.parts``: each micro-batch commits
the rows that it changes and the identities of those that they replace, so a
batch costs what it touches. Only the hash buckets that hold the batch's
members are read.

What a table holds depends on the set of rows that have arrived, not on
their order or on the batches they came in: SCD1 keeps each member's row of
the latest event time, SCD2 splits the version that a late row falls into.
So a replayed batch changes nothing, and an empty one commits nothing.
Rows without a key (SCD2: or without an event time) are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import any_changed
from strata.operators.dedup import last_per_key
from strata.operators.scd import EFFECTIVE_FROM
from strata.operators.versions import OPENS, dimension, version_changes
from strata.sources import parts
from strata.sources.checkpoint import materialize

COMPACT_AFTER = 64  # commits after which a table's visible rows are written as one part


def newest_changes(stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows that are newer than the stored ones of their keys (stored), and the keys whose rows they replace. Of rows equal in
    ``order_by`` (nulls first) the one that is last by all columns is kept."""
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in batch.columns if c not in keys and c not in order_by]
    named = batch.dropna("any", subset=keys)
    latest = materialize(last_per_key(named, keys, [*order_by, *rest]))
    if stored is None:
        return latest, None
    known = materialize(stored.join(latest.select(*keys), keys, "left_semi"))
    both = known.unionByName(latest, allowMissingColumns=True)
    best = last_per_key(both, keys, [*order_by, *[c for c in both.columns if c not in keys and c not in order_by]])
    values = [c for c in both.columns if c not in keys]
    old = known.select(*keys, F.struct(*[(F.col(c) if c in known.columns else F.lit(None).cast(both.schema[c].dataType)).alias(c) for c in values]).alias("_old"))
    changed = F.col("_old").isNull() | any_changed([(F.col(f"_old.{c}"), F.col(c)) for c in values])
    diff = materialize(best.join(old, keys, "left").where(changed).withColumn("_replaces", F.col("_old").isNotNull()).drop("_old"))
    return diff.drop("_replaces"), diff.where("_replaces").select(*keys)


def _commit(rows: DataFrame, gone: DataFrame | None, table: str, keys: Sequence[str], identity: Sequence[str], compact_after: int) -> None:
    spark = rows.sparkSession
    parts.commit(rows, table, keys, identity, gone)
    if len(parts.latest(spark, table)["rows"]) > compact_after:
        parts.compact(spark, table)


def scd1_foreach_batch(table: str, keys: Sequence[str], order_by: Sequence[str], compact_after: int = COMPACT_AFTER) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: each key keeps its newest row by ``order_by``, whenever it arrives."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark, batch = batch.sparkSession, materialize(batch)
        if not batch.take(1):
            return
        stored = parts.read(spark, table, parts.touched(spark, table, batch.select(*keys)))
        rows, gone = newest_changes(stored, batch, keys, order_by)
        if rows.take(1):
            _commit(rows, gone, table, list(keys), list(keys), compact_after)
    return apply


def scd2_foreach_batch(table: str, key: str, tracked: Sequence[str], order_by: Sequence[str], as_of_col: str | None = None,
                       compact_after: int = COMPACT_AFTER) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: versions by the event time ``as_of_col``; of rows of one key and time the last by ``order_by``.

    Without ``as_of_col`` the batch is a snapshot of changed members at the processing time, of which only the last
    row of a key counts; as no row can be late then, rows that change nothing are not kept."""
    time = as_of_col or "_processed"

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if as_of_col is None:
            batch = last_per_key(batch, [key], order_by).withColumn(time, F.current_timestamp())
        batch = materialize(batch)
        if not batch.take(1):
            return
        stored = parts.read(spark, table, parts.touched(spark, table, batch.select(key)))
        rows, gone = version_changes(stored, batch, key, time, tracked, order_by)
        rows = rows if as_of_col else rows.where(OPENS)
        if rows.take(1):
            _commit(rows, gone, table, [key], [key, EFFECTIVE_FROM], compact_after)
    return apply


def read_scd1(spark: SparkSession, table: str) -> DataFrame | None:
    """The newest row of every key, or None without a table."""
    return parts.read(spark, table)


def read_scd2(spark: SparkSession, table: str) -> DataFrame | None:
    """All versions, or None without a table."""
    rows = parts.read(spark, table)
    return None if rows is None else dimension(rows).drop("_processed")


def start_dimension_stream(stream: DataFrame, apply, checkpoint: str):
    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
