"""Dense rank without sending a whole group (or the whole table) to one task.

``dense_rank_by`` returns, for every row of ``df``, the dense rank of its
``order_col`` value among the distinct non-null values of its partition.
Rows whose value or partition key is null get a null rank.

A plain ``dense_rank().over(Window.partitionBy(p).orderBy(v))`` sorts every
group inside one task, and with no partition it sorts the whole table in a
single task. Here:

1. the distinct ``(p, v)`` pairs are stored (hash aggregate with map-side
   combine) and counted;
2. up to ``bucket_rows`` pairs are ranked by one window;
3. more are range-partitioned by ``(p, v)`` in the type's own order, and each
   range is sorted and cut into pieces of ``bucket_rows`` pairs: a piece is
   no task or file of its own. Each piece is ranked by
   itself, and a group that goes on from earlier pieces adds the number of
   its values there. A piece continues at most one group, so these offsets
   are at most as many rows as pieces, and are broadcast;
4. ranks are joined back on ``(p, v)``.

Pieces only decide which task does the work: values keep Spark's order (NaN
above all numbers, timestamps without zone as they are), whatever
``bucket_rows`` is. The call is eager: it stores the pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.checkpoint import materialize

DEFAULT_BUCKET_ROWS = 1_000_000


def dense_rank_by(df: DataFrame, order_col: str, partition_by=(), ascending: bool = True,
                  out: str = "rank", bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``df`` plus a BIGINT column ``out`` holding the null-aware dense rank."""
    parts = list(partition_by)
    keys = parts + [order_col]
    not_null = F.col(order_col).isNotNull()
    for p in parts:
        not_null = not_null & F.col(p).isNotNull()
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    vals = materialize(df.where(not_null).select(*keys).distinct())
    n = vals.count()
    if n <= bucket_rows:
        ranks = vals.withColumn("_rank", F.row_number().over(Window.partitionBy(*parts).orderBy(order)))
    else:
        ranks = _ranks_by_piece(vals, parts, order, n, bucket_rows)
    ranks = ranks.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(keys)],
                         F.col("_rank").cast("long").alias("_rank"), F.lit(0).cast("long").alias("_rsalt"))

    # One join back over the whole input. Rows with a null key or value get
    # a distinct non-zero salt: they never match and spread over partitions
    # instead of piling into the partition that null hashes to.
    salt = F.when(not_null, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    left = df.withColumn("_salt", salt)
    cond = [F.col(c) == F.col(f"_r{i}") for i, c in enumerate(keys)]
    cond.append(F.col("_salt") == F.col("_rsalt"))
    joined = left.join(ranks, cond, "left")
    return joined.select(*[c for c in df.columns if c != out], F.col("_rank").alias(out))


def _ranks_by_piece(vals: DataFrame, parts: list[str], order, n: int, bucket_rows: int) -> DataFrame:
    """``vals`` (``n`` rows) with ``_rank``, from contiguous pieces of at most ``bucket_rows`` rows."""
    shuffles = int(vals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(-(-n // bucket_rows), max(shuffles, -(-n // DEFAULT_BUCKET_ROWS)))
    # numbers of rows rise through the ranges and within each; a piece has the number of its first row.
    # Stored, so that every branch below sees the same pieces
    ranged = vals.repartitionByRange(ranges, *parts, order).sortWithinPartitions(*parts, order).withColumn("_at", F.monotonically_increasing_id())
    in_range = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = materialize(ranged.select(*vals.columns, (F.col("_at") - in_range % bucket_rows).alias("_piece")))
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*parts, "_piece").orderBy(order)))
    sizes = ranged.groupBy(*parts, "_piece").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*parts).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per piece: the group that it continues
    offsets = sizes.withColumn("_off", F.sum("_c").over(before)).where("_off > 0").drop("_c")
    return (local.join(F.broadcast(offsets), parts + ["_piece"], "left")
            .withColumn("_rank", F.col("_local") + F.coalesce("_off", F.lit(0))))


def dense_rank_window(df: DataFrame, order_col: str, partition_by=(), ascending: bool = True,
                      out: str = "rank") -> DataFrame:
    """Reference implementation with one window; for small inputs and tests."""
    parts = list(partition_by)
    not_null = F.col(order_col).isNotNull()
    for p in parts:
        not_null = not_null & F.col(p).isNotNull()
    order = F.col(order_col).asc_nulls_last() if ascending else F.col(order_col).desc_nulls_last()
    w = Window.partitionBy(*parts).orderBy(order)
    return df.withColumn(out, F.when(not_null, F.dense_rank().over(w)).cast("long"))
