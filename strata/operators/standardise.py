"""Silver standardisation: rename -> text dedup -> casts -> fills -> stamp.

The order matters and follows the source pipeline: duplicates are removed
on the *text* values (``1`` and ``1.0`` stay two rows), then declared
columns are cast tolerantly, then missing text becomes ``Unknown`` and
missing numbers 0, while missing timestamps stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import tolerant_number, tolerant_timestamp
from strata.specs import TECHNICAL_COLUMNS, UNKNOWN_TEXT, TableSpec

SEQ = "_seq"


def normalise_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case column names; refuse names that collide."""
    names = [c.strip().lower() for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalising: {dupes}")
    return df.toDF(*names)


def dedup_text(df: DataFrame, ignore=(SEQ, "batch", *TECHNICAL_COLUMNS)) -> DataFrame:
    """Drop repeated rows, comparing every column except ``ignore``.

    Hash aggregate on the compared columns with map-side combine: copies
    are merged before the shuffle, so a heavily repeated row costs little.
    """
    subset = [c for c in df.columns if c not in set(ignore)]
    return df.dropDuplicates(subset)


def cast_declared(df: DataFrame, spec: TableSpec, report: list | None = None) -> DataFrame:
    """Tolerant casts of the spec's date and number columns.

    Spec columns the frame does not have are skipped and, when ``report``
    is given, listed there (the source pipeline skipped them silently).
    """
    exprs = {}
    for c in spec.dates:
        if c in df.columns:
            exprs[c] = tolerant_timestamp(c)
        elif report is not None:
            report.append(c)
    for c, dtype in spec.numbers.items():
        if c in df.columns:
            exprs[c] = tolerant_number(c, dtype)
        elif report is not None:
            report.append(c)
    return df.withColumns(exprs) if exprs else df


def fill_defaults(df: DataFrame, skip=(SEQ, "batch")) -> DataFrame:
    """Null text -> ``Unknown``, null number -> 0; timestamps stay null."""
    exprs = {}
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.StringType):
            exprs[f.name] = F.coalesce(F.col(f.name), F.lit(UNKNOWN_TEXT))
        elif isinstance(f.dataType, T.NumericType):
            exprs[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
    return df.withColumns(exprs) if exprs else df


def standardise(df: DataFrame, spec: TableSpec, as_of=None, report: list | None = None) -> DataFrame:
    out = normalise_names(df)
    out = dedup_text(out)
    out = cast_declared(out, spec, report)
    out = fill_defaults(out)
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast(T.TimestampNTZType())
    return out.withColumn("silver_timestamp", stamp)
