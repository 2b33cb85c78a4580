"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.checkpoint import materialize

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run of anything but ASCII white space
SALTS = 16
SHARE = 4096  # rows of one key that go to one task
FEW_ROWS = 100_000  # rows of a narrow table that the driver can hold for a broadcast


def n_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Column, how: str = "left",
                salts: int = SALTS, grows: bool = False) -> DataFrame:
    """``left`` joined with ``right``, which has one row for a key (or a bounded few), so that a key with a
    large share of ``left`` is dealt to ``salts`` tasks: ``right``'s rows are repeated once for each salt,
    ``left``'s rows take the salt that ``spread`` hashes to. Null keys match nothing; rows are kept or
    dropped as ``how`` (left, inner, left_semi or left_anti) says. ``grows``: ``right`` grows with the input and is not
    broadcast (``sorted_join``)."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    joined = sorted_join(left, right, [*on, "_salt"], how) if grows else left.join(right, [*on, "_salt"], how)
    return joined.drop("_salt")


def sorted_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` by sorting, for a ``right`` that grows with the input. Spark takes the size of its
    compressed file for that of a stored table and broadcasts what is below a limit: the driver then holds all its rows,
    which can be many times as large."""
    return left.join(right.hint("merge"), on if isinstance(on, str) else [*on], how)


def dealt_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Column, how: str = "left") -> DataFrame:
    """``sorted_join`` of ``left`` (stored) with ``right``, which has one row for a key (or a bounded few), so that a key
    with more than SHARE rows of ``left`` is dealt to several tasks, by what ``spread`` hashes to; only such a key's rows
    of ``right`` are repeated. Null keys match nothing and are dealt out too; rows are kept or dropped as ``how``
    (left, inner, left_semi or left_anti) says."""
    many = left.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("_tasks"))
    many = materialize(many.where("_tasks > 1"))
    if not many.take(1):
        return sorted_join(left, right, on, how)
    no_key = F.concat(*[F.col(c).cast("string") for c in on]).isNull()
    tasks = F.when(no_key, F.lit(SALTS)).otherwise(F.coalesce("_tasks", F.lit(1)))
    left = left.join(many, [*on], "left").withColumn("_salt", F.pmod(F.xxhash64(spread), tasks).cast("int")).drop("_tasks")
    right = right.join(many, [*on], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_tasks", F.lit(1)) - 1))).drop("_tasks")
    return sorted_join(left, right, [*on, "_salt"], how).drop("_salt")
