"""Min-max scaling fitted on the training split only.

Statistics are one row (2 values per column); applying them reads those
numbers once and uses them as literals, as MLlib's scalers do.  Constant
columns follow the common convention of a unit range: (x - min) / 1, i.e. 0
on the training rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: ranges below 10 * machine epsilon count as zero.
TINY_RANGE = 10 * 2.220446049250313e-16


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``{c}__min`` and ``{c}__max`` for every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return train.agg(*aggs)


def scaler_long(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, min, max) rows of a fitted scaler."""
    parts = ", ".join(f"'{c}', double(`{c}__min`), double(`{c}__max`)" for c in cols)
    return stats.selectExpr(f"stack({len(cols)}, {parts}) as (feature, min, max)")


def scaler_params(stats: DataFrame | dict) -> dict:
    """The fitted statistics as plain numbers: one row, two values per column.

    Like MLlib's own scalers, a fitted scaler is a handful of numbers on the
    driver that ``scale`` applies as literals (no join with the data).
    """
    return stats if isinstance(stats, dict) else stats.first().asDict()


def _lo_rng(p: dict, c: str) -> tuple[F.Column, F.Column]:
    lo, hi = p[f"{c}__min"], p[f"{c}__max"]
    if lo is None or hi is None:                       # no training rows
        none = F.lit(None).cast("double")
        return none, none
    rng = float(hi) - float(lo)
    return F.lit(float(lo)), F.lit(1.0 if rng < TINY_RANGE else rng)


def _apply(df: DataFrame, stats, cols: Sequence[str], inverse: bool,
           suffix: str, src_suffix: str) -> DataFrame:
    p = scaler_params(stats)
    out = {}
    for c in cols:
        x = F.col(f"{c}{src_suffix}")
        lo, rng = _lo_rng(p, c)
        out[f"{c}{suffix}"] = x * rng + lo if inverse else (x - lo) / rng
    return df.withColumns(out)


def scale(df: DataFrame, stats, cols: Sequence[str], suffix: str = "",
          src_suffix: str = "") -> DataFrame:
    """(x - min) / range, no clipping (val/test may leave [0, 1]).

    Reads ``{c}{src_suffix}`` and writes ``{c}{suffix}`` (in place by default).
    """
    return _apply(df, stats, cols, False, suffix, src_suffix)


def unscale(df: DataFrame, stats, cols: Sequence[str], suffix: str = "",
            src_suffix: str = "") -> DataFrame:
    """E16 inverse: x * range + min."""
    return _apply(df, stats, cols, True, suffix, src_suffix)


def scale_with(df: DataFrame, stats, stat_col: str, cols: Sequence[str]) -> DataFrame:
    """Scale other columns (e.g. a prediction) with the statistics of ``stat_col``."""
    lo, rng = _lo_rng(scaler_params(stats), stat_col)
    return df.withColumns({c: (F.col(c) - lo) / rng for c in cols})


def unscale_with(df: DataFrame, stats, stat_col: str, cols: Sequence[str]) -> DataFrame:
    """Inverse of ``scale_with``: x * range + min with the statistics of ``stat_col``."""
    lo, rng = _lo_rng(scaler_params(stats), stat_col)
    return df.withColumns({c: F.col(c) * rng + lo for c in cols})
