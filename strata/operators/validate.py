"""Key validation with a reject side-output (null keys, repeated keys).

Semantics: a row is rejected when any key part is null (``null_key``) or
when an earlier row (by ``order_by``) has the same key (``duplicate_key``);
the first row of every key survives. With no key spec every row is valid.

Plan shape, chosen for size and skew:

1. The *repeated* keys are found by a hash aggregate that only counts,
   combined map-side, so a key holding a third of the data never lands in
   one task. One narrow row per repeated key is stored.
2. Only rows of repeated keys look for their first one
   (``min(struct(order_by))``); the result is stored as well.
3. Every row is flagged by a left join with those first rows. Spark decides
   from their stored size whether they are broadcast (the input is then not
   shuffled at all) or both sides are sorted, where adaptive execution
   splits a hot key's partition. Null keys match nothing; they take a salt
   of their own so that they never pile up in one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalar import any_null
from strata.sources.checkpoint import materialize

NULL_KEY = "null_key"
DUPLICATE_KEY = "duplicate_key"


def check_columns(df: DataFrame, columns, what: str = "key") -> None:
    """Raise ``ValueError`` naming the columns the frame lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing {what} columns {missing}")


def validate_keys(df: DataFrame, keys, order_by=("_seq",)) -> DataFrame:
    """Return ``df`` plus ``is_valid`` (bool) and ``reject_reason`` (string).

    ``order_by`` defines "first" and must be unique within a key; the
    default ``_seq`` column is captured at the scan (see sources.raw). The
    call is eager: it stores the repeated keys and their first rows.
    """
    keys = list(keys)
    if not keys:
        return df.withColumns({"is_valid": F.lit(True),
                               "reject_reason": F.lit(None).cast("string")})
    check_columns(df, keys)
    order_by = list(order_by)
    check_columns(df, order_by, "order")

    null_key = any_null(keys)
    keyed = df.where(~null_key).select(*dict.fromkeys(keys + order_by))
    repeated = materialize(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                           .where(F.col("_n") > 1).select(*keys))
    firsts = materialize(
        keyed.join(repeated, keys, "left_semi").groupBy(*keys)
        .agg(F.min(F.struct(*order_by)).alias("_first"))
        .select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
                *[F.col(f"_first.{c}").alias(f"_o_{i}") for i, c in enumerate(order_by)],
                F.lit(0).cast("long").alias("_rsalt")))

    salted = df.withColumn("_salt", F.when(null_key, F.monotonically_increasing_id() + 1).otherwise(F.lit(0)))
    on = [salted[k] == F.col(f"_k_{i}") for i, k in enumerate(keys)]
    joined = salted.join(firsts, on + [F.col("_salt") == F.col("_rsalt")], "left")
    later = F.col("_rsalt").isNotNull()
    first = F.lit(True)
    for i, c in enumerate(order_by):
        first = first & salted[c].eqNullSafe(F.col(f"_o_{i}"))
    reason = F.when(null_key, NULL_KEY).when(later & ~first, DUPLICATE_KEY)
    return joined.select(*[salted[c] for c in df.columns], reason.isNull().alias("is_valid"), reason.alias("reject_reason"))


def split_valid(flagged: DataFrame):
    """(valid rows without flags, rejected rows with ``reject_reason``)."""
    valid = flagged.where("is_valid").drop("is_valid", "reject_reason")
    rejected = flagged.where(~F.col("is_valid")).drop("is_valid")
    return valid, rejected
