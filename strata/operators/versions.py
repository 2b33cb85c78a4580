"""Versions of dimension members from change rows, by event time.

A member's timeline is made of its change rows in order of their event time.
A row whose tracked columns differ from the row before it opens a version;
one that repeats them confirms the version it falls into. A version holds
the values of the row that opens it and lasts from that row's time to the
time of the next row that opens one: ``[effective_from, effective_to)``,
never empty, the last one open.

All change rows are kept, confirmations included (``opens`` is false): a row
that arrives late may fall between a version's opening and its confirmation,
which then opens a version of its own. So the table depends on the set of
rows alone, not on their order or batches.

``fold`` sorts timelines in pieces: rows are range-partitioned by key and
time, and a piece needs to know only the row before it and the next opening
behind it, one row for each piece. So a key with a large share of all rows
is spread over as many tasks as it fills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import any_changed
from strata.operators.dedup import last_per_key
from strata.operators.scd import EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT
from strata.sources.checkpoint import materialize

OPENS = "opens"


def observations(changes: DataFrame, key: str, time: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per member and event time: of several, the last by ``order_by`` and then by all columns.
    Rows without a key or a time have no place on a timeline and are left out (validation reports them)."""
    rows = changes.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    rows = rows.withColumn(EFFECTIVE_FROM, F.col(time).cast(T.TimestampNTZType()))
    return last_per_key(rows, [key, EFFECTIVE_FROM], [*order_by, *[c for c in changes.columns if c not in order_by]])


def fold(rows: DataFrame, key: str, tracked: Sequence[str], pieces: int | None = None) -> DataFrame:
    """``rows`` (one per ``key`` and effective_from) with opens, effective_to and is_current. ``pieces``: number of
    ranges that are sorted by themselves, by default the session's shuffle partitions."""
    spark = rows.sparkSession
    rows = rows.drop(OPENS, EFFECTIVE_TO, IS_CURRENT)
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(rows.repartitionByRange(pieces, key, EFFECTIVE_FROM).withColumn("_piece", F.spark_partition_id()))
    now = F.struct(*tracked) if tracked else F.struct(F.lit(0).alias("_none"))
    # at most one row a piece from here on: its first and its last key, and the values that its first row follows
    ends = placed.groupBy("_piece").agg(F.min(F.struct(F.col(key).alias("k"), EFFECTIVE_FROM)).alias("_head"),
                                        F.max_by(F.struct(F.col(key).alias("k"), now.alias("v")), F.struct(key, EFFECTIVE_FROM)).alias("_tail"))
    ends = materialize(ends.withColumn("_past", F.lag("_tail").over(Window.orderBy("_piece"))).select(
        "_piece", F.col("_head.k").alias("_first"), F.col("_tail.k").alias("_last"),
        F.when(F.col("_past.k") == F.col("_head.k"), F.col("_past.v")).alias("_past")))
    timeline = Window.partitionBy("_piece", key).orderBy(EFFECTIVE_FROM)
    past = F.broadcast(ends.where("_past is not null").select("_piece", F.col("_first").alias(key), "_past"))
    seen = placed.join(past, ["_piece", key], "left").withColumn("_before", F.coalesce(F.lag(now).over(timeline), "_past"))
    changed = any_changed([(F.col(f"_before.{c}"), F.col(c)) for c in tracked])
    seen = seen.withColumn(OPENS, F.col("_before").isNull() | changed).drop("_before", "_past")
    # what comes later in the piece, read backwards: a frame that only grows
    later = Window.partitionBy("_piece", key).orderBy(F.col(EFFECTIVE_FROM).desc()).rowsBetween(Window.unboundedPreceding, -1)
    opened = materialize(seen.withColumn("_next", F.min(F.when(F.col(OPENS), F.col(EFFECTIVE_FROM))).over(later)))
    # the next opening of a piece's last key in the pieces behind it
    head = opened.join(F.broadcast(ends.select("_piece", F.col("_first").alias(key))), ["_piece", key], "left_semi")
    head = head.where(OPENS).groupBy("_piece", key).agg(F.min(EFFECTIVE_FROM).alias("_opening"))
    edges = ends.select("_piece", F.explode(F.array_distinct(F.array("_first", "_last"))).alias(key)).join(head, ["_piece", key], "left")
    behind = Window.partitionBy(key).orderBy("_piece").rowsBetween(1, Window.unboundedFollowing)
    after = edges.select("_piece", key, F.min("_opening").over(behind).alias("_after")).where("_after is not null")
    out = opened.join(F.broadcast(after), ["_piece", key], "left")
    out = out.withColumn(EFFECTIVE_TO, F.when(F.col(OPENS), F.coalesce("_next", "_after")))
    return out.withColumn(IS_CURRENT, F.col(OPENS) & F.col(EFFECTIVE_TO).isNull()).select(*rows.columns, OPENS, EFFECTIVE_TO, IS_CURRENT)


def dimension(rows: DataFrame) -> DataFrame:
    """The versions among the rows of ``fold``: confirmations left out."""
    return rows.where(OPENS).drop(OPENS)


def version_changes(stored: DataFrame | None, batch: DataFrame, key: str, time: str, tracked: Sequence[str],
                    order_by: Sequence[str] = (), pieces: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows to add to a stored timeline table (stored), and identities (``key``, effective_from) of rows that they replace.

    ``stored``: the rows of ``fold`` (of the members of the batch at least), None without a table."""
    new = observations(batch, key, time, order_by)
    if stored is None:
        return materialize(fold(new, key, tracked, pieces)), None
    members = batch.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key).distinct()
    known = materialize(stored.join(members, key, "left_semi"))
    columns = [c for c in known.columns if c not in (OPENS, EFFECTIVE_TO, IS_CURRENT, EFFECTIVE_FROM)]
    columns += [c for c in new.columns if c not in columns and c != EFFECTIVE_FROM]
    both = known.drop(OPENS, EFFECTIVE_TO, IS_CURRENT).unionByName(new, allowMissingColumns=True)
    both = last_per_key(both, [key, EFFECTIVE_FROM], [*order_by, *[c for c in columns if c not in order_by and c != key]])
    folded = fold(both, key, tracked, pieces)
    names = [c for c in folded.columns if c not in (key, EFFECTIVE_FROM)]
    old = known.select(key, EFFECTIVE_FROM, F.struct(*[(F.col(c) if c in known.columns else F.lit(None).cast(folded.schema[c].dataType)).alias(c) for c in names]).alias("_old"))
    met = folded.join(old, [key, EFFECTIVE_FROM], "left")
    same = F.col("_old").isNotNull() & ~any_changed([(F.col(f"_old.{c}"), F.col(c)) for c in names])
    diff = materialize(met.where(~same).withColumn("_replaces", F.col("_old").isNotNull()).drop("_old"))
    return diff.drop("_replaces"), diff.where("_replaces").select(key, EFFECTIVE_FROM)
