"""Mixing sources to target weights with hash-threshold histograms.

Every row has a 60-bit hash. A source whose budget is ``passes`` whole copies
and a remainder takes each row ``passes`` times, and once more those rows
whose hash is below the source's threshold. The threshold is found without
sorting rows: sizes are summed by source and hash bucket (256 buckets), the
running sum over a source's buckets shows the one bucket in which the budget
ends, and only the rows of that bucket are summed again by the next 8 bits of
the hash, until it holds one hash. Thresholds of larger budgets are larger,
so the mixes of growing budgets contain one another.

The boundary hash itself is taken if that brings the source nearer to its
budget, so a source misses it by at most half the rows of one hash.

Defined results: a null size counts as 0; null is a source of its own, last
in code-point order; rows equal in all key columns have one hash and are
taken or left together; sources without any size have the target 0; an empty
table gives an empty result; a column of the input that is named like a new
one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import salted_join
from strata.sources.checkpoint import materialize

HASH_BITS, LEVEL_BITS = 60, 8
MAX_PASSES = 3


def hash_key(*columns: Column) -> Column:
    """The first 60 bits of the MD5 of the columns' texts, nulls left out."""
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``weight`` for each row of ``sources`` (one row a source): ``weights`` in turn, sources in
    code-point order, null last. One task orders the sources, never the rows."""
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))


def targets(sources: DataFrame, share: float = 1.0, max_passes: int = MAX_PASSES) -> DataFrame:
    """Adds ``target``: ``share`` of all sizes dealt by ``weight``; a target stops at ``max_passes`` times
    its source's size and the excess goes to the others by weight, until none is above.

    The common factor that weights are multiplied with grows from round to round; a round sums up the
    sources that have reached their limit, so only three numbers come to the driver."""
    limit = F.lit(float(max_passes)) * F.col("source_size")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    factor = None
    while True:
        capped = F.lit(False) if factor is None else F.lit(factor) * F.col("weight") >= limit
        full, weight = sources.agg(F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        now = (total - full) / weight if weight else factor
        if now == factor or now is None:
            break
        factor = now
    target = F.lit(0.0) if factor is None else F.when(F.lit(factor) * F.col("weight") >= limit, limit).otherwise(F.lit(factor) * F.col("weight"))
    return sources.withColumn("target", target)


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (source key ``_s``, source_size, target) with ``passes`` and ``threshold``.

    ``rows``: ``_s``, ``_size`` and ``_key`` of every row, stored; it is read once whole, and once
    more for the rows of the boundary buckets, which are stored for the further levels."""
    size = F.greatest(F.col("source_size").cast("double"), F.lit(1.0))
    passes = F.floor(F.col("target") / size)
    budget = F.col("target") - passes * F.col("source_size")
    state = materialize(plan.withColumn("passes", passes.cast("long")).withColumn("_left", budget))
    found = None
    for shift in range(HASH_BITS - LEVEL_BITS, -LEVEL_BITS, -LEVEL_BITS):
        shift = max(shift, 0)
        bucket = F.shiftright(F.col("_key"), shift)
        sums = rows.groupBy("_s", bucket.alias("_bucket")).agg(
            F.sum("_size").alias("_sum"), F.min("_key").alias("_low"), F.max("_key").alias("_high"))
        upto = F.sum("_sum").over(Window.partitionBy("_s").orderBy("_bucket"))
        sums = sums.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_sum"))
        if found is None:
            left = state.select("_s", "_left")
        else:
            left = found.select("_s", "_left")
        edge = sums.join(left, "_s").where((F.col("_start") <= F.col("_left")) & (F.col("_end") > F.col("_left")))
        found = materialize(edge.select("_s", "_bucket", "_sum", "_low", "_high", (F.col("_left") - F.col("_start")).alias("_left")))
        if shift == 0 or not found.where("_low < _high").take(1):
            break
        inside = salted_join(rows.withColumn("_bucket", bucket), found.select("_s", "_bucket"), ["_s", "_bucket"], F.col("_key"), "inner")
        rows = materialize(inside.select("_s", "_size", "_key"))
    # one hash is left in each boundary bucket: take it if that comes nearer to the budget
    threshold = F.when(F.col("_sum") <= 2 * F.col("_left"), F.col("_high") + 1).otherwise(F.col("_low"))
    last = found.select("_s", threshold.alias("threshold"))
    return state.drop("_left").join(last, "_s", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0)))


def mix(docs: DataFrame, size: Column, source_col: str = "source", key_cols: Sequence[str] = ("doc_id", "text"),
        weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.0, max_passes: int = MAX_PASSES,
        keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or the columns ``keep``) with size, source_size, target and taken: the size that the mix
    takes of each row, a multiple of its own size up to ``max_passes`` times.

    Sizes and hashes are stored once; without ``keep`` they are worked out again beside the whole rows."""
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    added = ["size", "source_size", "target", "taken", "copies"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(*names, F.coalesce(size, F.lit(0)).cast("long").alias("_size"),
                       hash_key(*[F.col(c) for c in key_cols]).alias("_key"), source.alias("_s"))
    stored = materialize(rows if keep is not None else rows.select("_s", "_size", "_key"))
    sources = stored.groupBy("_s").agg(F.sum("_size").alias("source_size")).withColumn(
        "source", F.when(F.col("_s") != "n", F.substring("_s", 2, 1 << 30)))
    plan = targets(materialize(cycled_weights(sources, weights)), share, max_passes)
    cut = thresholds(stored.select("_s", "_size", "_key"), plan.select("_s", "source_size", "target"))
    joined = salted_join(stored if keep is not None else rows, materialize(cut), ["_s"], F.col("_key"))
    copies = F.col("passes") + F.when(F.col("_key") < F.col("threshold"), 1).otherwise(0)
    return joined.select(*names, F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * copies).alias("taken"),
                         copies.cast("int").alias("copies"))
