"""Column expressions used across the layers. All are built-in Spark
expressions, so they stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.specs import NA_TOKENS, TIMESTAMP_FORMATS

# A number as pandas' to_numeric accepts it: optional blanks and sign,
# digits with an optional fraction, optional exponent; or inf / nan words.
# Spark's own cast also accepts suffixes such as "1d" or "1f", which the
# source pipeline turns into null, hence the guard.
_NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPECIAL_PATTERN = r"^\s*[+-]?(?i)(inf|infinity|nan)\s*$"

_MICROS_PER_DAY = 86_400_000_000


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c) -> Column:
    """Map the NA text tokens of a raw CSV field to null."""
    c = col_of(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def tolerant_number(c, dtype: T.DataType = T.DoubleType()) -> Column:
    """Text -> number; anything that is not a plain number becomes null."""
    c = col_of(c)
    ok = c.rlike(_NUMBER_PATTERN)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        ok = ok | c.rlike(_SPECIAL_PATTERN)
        return F.when(ok, F.trim(c).try_cast(dtype))
    if isinstance(dtype, T.DecimalType):
        return F.when(ok, F.trim(c).try_cast(dtype))
    # integral target: the text may be "3.0"; go through decimal, keep only whole values
    as_dec = F.trim(c).try_cast(T.DecimalType(38, 10))
    whole = as_dec == F.floor(as_dec)
    return F.when(ok & whole, as_dec.try_cast(dtype))


def tolerant_timestamp(c, formats=TIMESTAMP_FORMATS) -> Column:
    """Text -> naive timestamp using declared formats, first match wins.

    Unparseable text becomes null (never raises, ANSI mode or not).
    """
    c = col_of(c)
    parsed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*parsed).cast(T.TimestampNTZType())


def floor_days(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded toward -infinity.

    A 2-hour negative gap gives -1 (not 0 as a truncating difference would,
    and not the calendar-day count of ``datediff``).
    """
    micros = F.timestamp_diff("MICROSECOND", col_of(earlier), col_of(later))
    return F.floor(micros / F.lit(_MICROS_PER_DAY)).cast(T.LongType())


def any_null(cols) -> Column:
    """True when any of the columns is null."""
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [col_of(c).isNull() for c in cols])


def any_changed(pairs) -> Column:
    """True when any (old, new) pair differs; null equals null."""
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~col_of(o).eqNullSafe(col_of(n)) for o, n in pairs])


def elapsed_seconds(start, end) -> Column:
    """Seconds between two timestamps, rounded to 2 decimals."""
    ms = F.timestamp_diff("MILLISECOND", col_of(start), col_of(end))
    return F.round(ms / F.lit(1000.0), 2)


def run_id(ts, suffix) -> Column:
    """Run identifier ``RUN_yyyyMMdd_HHmmss_<suffix>``."""
    return F.concat(F.lit("RUN_"), F.date_format(col_of(ts), "yyyyMMdd_HHmmss"),
                    F.lit("_"), col_of(suffix))
