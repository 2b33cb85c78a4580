"""Slowly changing dimensions, type 1 and type 2, as joins.

Both take the stored dimension and a fresh snapshot and return the next
version of the dimension; callers write it to a new version directory
(``strata.sources.versioned``) so the table being read is never
overwritten in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import any_changed

EFFECTIVE_FROM = "effective_from"
EFFECTIVE_TO = "effective_to"
IS_CURRENT = "is_current"
VERSION_COLUMNS = (EFFECTIVE_FROM, EFFECTIVE_TO, IS_CURRENT)


def scd1_merge(old: DataFrame | None, new: DataFrame, keys) -> DataFrame:
    """Type 1: snapshot rows replace same-key rows whole; keys missing from
    the snapshot keep their old row. Columns are the union of both sides.

    ``new`` must hold one row per key (it comes from the validated layer).
    Plan: anti join (old rows whose key is not in the snapshot) + union, so
    no row is sorted or ranked; rerunning with the same snapshot is a no-op.
    """
    keys = list(keys)
    if old is None:
        return new
    kept = old.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def _as_ts(value):
    if value is None:
        return F.current_timestamp().cast(T.TimestampNTZType())
    return F.lit(value).cast(T.TimestampNTZType())


def scd2_initial(snapshot: DataFrame, as_of=None) -> DataFrame:
    """First load: every snapshot row is a current version from ``as_of``."""
    return snapshot.withColumns({
        EFFECTIVE_FROM: _as_ts(as_of),
        EFFECTIVE_TO: F.lit(None).cast(T.TimestampNTZType()),
        IS_CURRENT: F.lit(True),
    })


def scd2_merge(history: DataFrame | None, snapshot: DataFrame, key: str, tracked,
               as_of=None) -> DataFrame:
    """Type 2 with half-open validity ``[effective_from, effective_to)``.

    * key only in the snapshot: new current version;
    * key in both, a tracked column differs (null equals null): the current
      version is closed at ``as_of`` and a new one opens at ``as_of``;
    * key in both, no tracked change: the current version stays untouched,
      even when untracked columns differ;
    * key missing from the snapshot: stays current (no delete detection);
    * closed versions pass through.

    One full outer join of the *current* versions with the snapshot, keyed
    on ``key`` (one row per key on each side, so no skew), yields 1 or 2
    output rows per key via ``inline``. The closed history is never joined.
    """
    if history is None:
        return scd2_initial(snapshot, as_of)
    # a history stored partitioned by is_current reads the flag back as text
    history = history.withColumn(IS_CURRENT, F.col(IS_CURRENT).cast("boolean"))
    stamp = _as_ts(as_of)
    business = [c for c in snapshot.columns if c not in VERSION_COLUMNS]
    hist_types = {f.name: f.dataType for f in history.schema.fields}
    snap_types = {f.name: f.dataType for f in snapshot.schema.fields}
    extra = [c for c in history.columns if c not in business and c not in VERSION_COLUMNS]
    out_cols = business + extra

    def typ(c):
        return snap_types.get(c, hist_types.get(c))

    cur = history.where(F.col(IS_CURRENT))
    closed = history.where(~F.col(IS_CURRENT))
    h = cur.select(*[F.col(c).alias(f"h_{c}") for c in history.columns], F.lit(True).alias("_in_h"))
    s = snapshot.select(*[F.col(c).alias(f"s_{c}") for c in business], F.lit(True).alias("_in_s"))
    j = h.join(s, F.col(f"h_{key}") == F.col(f"s_{key}"), "full_outer")

    in_h = F.coalesce(F.col("_in_h"), F.lit(False))
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    changed = in_h & in_s & any_changed([(F.col(f"h_{c}"), F.col(f"s_{c}")) for c in tracked])

    def hcol(c):
        return (F.col(f"h_{c}") if c in hist_types else F.lit(None)).cast(typ(c)).alias(c)

    def scol(c):
        return (F.col(f"s_{c}") if c in snap_types else F.lit(None)).cast(typ(c)).alias(c)

    old_version = F.when(in_h, F.struct(
        *[hcol(c) for c in out_cols],
        F.col(f"h_{EFFECTIVE_FROM}").cast(T.TimestampNTZType()).alias(EFFECTIVE_FROM),
        F.when(changed, stamp).otherwise(F.col(f"h_{EFFECTIVE_TO}"))
         .cast(T.TimestampNTZType()).alias(EFFECTIVE_TO),
        (~changed).alias(IS_CURRENT)))
    new_version = F.when(in_s & (~in_h | changed), F.struct(
        *[scol(c) for c in out_cols],
        stamp.alias(EFFECTIVE_FROM),
        F.lit(None).cast(T.TimestampNTZType()).alias(EFFECTIVE_TO),
        F.lit(True).alias(IS_CURRENT)))
    versions = j.select(F.inline(F.filter(F.array(old_version, new_version),
                                          lambda x: x.isNotNull())))
    closed = closed.select(*[F.col(c).cast(typ(c)) if c in hist_types else
                             F.lit(None).cast(typ(c)).alias(c) for c in out_cols],
                           F.col(EFFECTIVE_FROM).cast(T.TimestampNTZType()),
                           F.col(EFFECTIVE_TO).cast(T.TimestampNTZType()),
                           F.col(IS_CURRENT))
    return closed.unionByName(versions)


def not_in_current(snapshot: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Snapshot rows whose key has no current version (new members)."""
    cur = history.where(F.col(IS_CURRENT).cast("boolean")).select(key)
    return snapshot.join(cur, key, "left_anti")
