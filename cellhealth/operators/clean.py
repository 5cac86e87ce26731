"""Telemetry cleaning (E1-E6): identity from the path, coercion, discharge
filter, incomplete-row removal, light projection.  All narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.functions.expressions import (
    BATTERY_ID_PATTERN,
    BATTERY_TYPE_PATTERN,
    battery_id_from_path,
    battery_type_from_path,
    to_double,
)


def with_identity(df: DataFrame, path_col: str = "file_path",
                  id_pattern: str = BATTERY_ID_PATTERN,
                  type_pattern: str = BATTERY_TYPE_PATTERN) -> DataFrame:
    """``battery_id`` = file stem, ``battery_type`` = folder under battery_data/.

    Other layouts give their own patterns (group 1 is the value).
    """
    return (df.withColumn("battery_id", battery_id_from_path(path_col, id_pattern))
              .withColumn("battery_type", battery_type_from_path(path_col, type_pattern)))


def coerce_numeric(df: DataFrame, cols: Sequence[str] = tuple(S.RAW_NUMERIC)) -> DataFrame:
    """Safe cast of the known numeric columns to double (bad text -> null)."""
    return df.withColumns({c: to_double(c) for c in cols})


def discharge_only(df: DataFrame, code: float = S.DISCHARGE_MODE) -> DataFrame:
    """Keep discharge readings; a null mode is dropped."""
    return df.filter(F.col("mode") == F.lit(float(code)))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """E5: drop rows with a null or NaN in any column (or in ``subset``).

    The default checks every column, also ones nobody uses afterwards; that
    keeps the reference's semantics but stops column pruning at the scan.
    """
    return df.dropna(how="any", subset=list(subset) if subset else None)


def light(df: DataFrame) -> DataFrame:
    """The six columns of the light dataset."""
    return df.select(*S.LIGHT_COLUMNS)


def clean_readings(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """E3-E5 without the identity columns: coercion, discharge filter, dropna.

    The identity columns are null exactly when the path is null (a regex
    extract of a string is never null), so checking the path here is the
    same as checking them later; parsing them after the filter keeps the
    regexes out of the filter and lets ``cycles.aggregate_cycles_by_file``
    parse them once per file and cycle instead of once per reading.
    """
    return drop_incomplete(discharge_only(coerce_numeric(df)), subset)


def clean_telemetry(df: DataFrame, subset: Sequence[str] | None = None,
                    path_col: str = "file_path") -> DataFrame:
    """Coercion, discharge filter, dropna, then identity from the path."""
    return with_identity(clean_readings(df, subset), path_col)
