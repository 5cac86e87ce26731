"""Scalar expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Spark 4 runs with ANSI mode on: a plain ``x / 0.0`` raises and an
overflowing ``cast(.. as int)`` raises, so divisions and narrowing casts go
through ``try_divide`` / ``try_cast`` and yield null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellhealth import schema as S

# Path patterns of the telemetry layout battery_data/<type>/<id>.csv
BATTERY_ID_PATTERN = r"([^/]+)\.csv"
BATTERY_TYPE_PATTERN = r"battery_data/([^/]+)/"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def battery_id_from_path(path: str | Column, pattern: str = BATTERY_ID_PATTERN) -> Column:
    """File stem before ``.csv``; ``""`` (not null) when the path does not match."""
    return F.regexp_extract(_c(path), pattern, 1)


def battery_type_from_path(path: str | Column, pattern: str = BATTERY_TYPE_PATTERN) -> Column:
    """Directory directly under ``battery_data/``; ``""`` when absent."""
    return F.regexp_extract(_c(path), pattern, 1)


def to_double(c: str | Column) -> Column:
    """Safe coercion to double: text that is not a number becomes null."""
    return _c(c).try_cast("double")


def cycle_bucket(time: str | Column, width: float = S.CYCLE_WIDTH) -> Column:
    """Fixed-width bucket of the time axis, truncated toward zero (-0.5 -> 0).

    Out-of-range values become null instead of failing the job.
    """
    return (_c(time) / F.lit(float(width))).try_cast("int")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; null when ``den`` is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to ``[lo, hi]``; either bound may be open (None).  Null stays null."""
    out = _c(c)
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(_c(c).isNull(), F.lit(None).cast("double")).otherwise(out)


def health_status(soh_pct: str | Column) -> Column:
    """Health band of a SoH percentage: > 80 Healthy, 70..80 Degraded, < 70 Critical.

    80 and 70 exactly are Degraded; null stays null.
    """
    x = _c(soh_pct)
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(x > F.lit(S.HEALTHY_ABOVE), F.lit("Healthy"))
        .when(x >= F.lit(S.CRITICAL_BELOW), F.lit("Degraded"))
        .otherwise(F.lit("Critical"))
    )


def round6(c: str | Column) -> Column:
    """Report rounding to 6 places: ``floor(x * 1e6 + 0.5) / 1e6``.

    Plain IEEE arithmetic, so any engine gives the same bits for the same
    input (decimal HALF_UP rounding and binary rounding disagree on ties).
    Values that have no sixth place left (1e9 and beyond), infinities and NaN
    (which Spark orders above every number) stay as they are; null stays null.
    """
    x = _c(c).cast("double")
    return F.when(F.abs(x) >= F.lit(1e9), x).otherwise(
        F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6))
