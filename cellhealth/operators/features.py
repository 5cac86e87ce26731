"""Model-frame features.

One ordinal pass gives each battery's cycle position, size, running voltage
drop and cycle rank; one halo-segment pass then computes the 10-row rolling
statistics and the 11-point Savitzky-Golay smoothing.  Ordering is always
(cycle, battery_type) within battery_id, never file order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.functions.expressions import clip, safe_ratio
from cellhealth.operators import segments as seg
from cellhealth.operators.cycles import battery_ordinals

HALF = S.SAVGOL_WINDOW // 2  # 5


def with_targets(df: DataFrame) -> DataFrame:
    """remaining_cycles, rul_ratio and cycle_norm."""
    return (df.withColumn("remaining_cycles",
                          (F.lit(1.0) - F.col("cycle_ratio")) * F.col("max_cycle"))
              .withColumn("rul_ratio", safe_ratio("remaining_cycles", "max_cycle"))
              .withColumn("cycle_norm", safe_ratio("cycle", "max_cycle")))


def with_position(df: DataFrame, block_width: int = seg.DEFAULT_BLOCK_WIDTH,
                  bounded: bool = False) -> DataFrame:
    """W2 + W3 and the battery position columns.

    Adds ``cycle_index`` (1-based position in the battery), ``n_cycles``,
    ``cumul_voltage_drop`` (running sum of voltage_drop) and ``cycle_rank``
    (percentile rank of cycle, ties averaged, in (0, 1]).
    """
    d = battery_ordinals(df, block_width, bounded=bounded, prefix_sums=["voltage_drop"],
                         ties_on="cycle")
    avg_rank = F.col("_rank_min") + (F.col("_ties") - F.lit(1)) / F.lit(2.0)
    return (d.withColumn("cycle_index", F.col("_ord"))
              .withColumn("n_cycles", F.col("_n"))
              .withColumn("cumul_voltage_drop", F.col("_cum_voltage_drop"))
              .withColumn("cycle_rank", avg_rank / F.col("_n").cast("double"))
              .drop("_ord", "_n", "_cum_voltage_drop", "_rank_min", "_ties"))


def _savgol_terms(around: str) -> Column:
    """Savitzky-Golay (11 points, quadratic) in closed form, interp edge mode.

    For row i of n, centre c = min(max(i, 5), n - 6), t = i - c and
    smoothed = sum_k w(t, k) * v[c + k] for k in -5..5 with
    w(t, k) = 1/11 + t*k/110 + (k^2 - 10)(t^2 - 10)/858
    (least-squares quadratic over the 11 points, evaluated at offset t).
    ``around`` holds v[i-10 .. i+10] clipped at the battery's ends, so row i
    sits at 1-based index min(i, 10) + 1 and v[c + k] at that + (c - i) + k.
    """
    i = F.col("cycle_index") - 1
    n = F.col("n_cycles")
    c = F.least(F.greatest(i, F.lit(HALF)), n - F.lit(HALF + 1))
    t = (i - c).cast("double")
    centre = (F.least(i, F.lit(2 * HALF)) + F.lit(1) + (c - i)).cast("int")
    total = None
    for k in range(-HALF, HALF + 1):
        w = (F.lit(1.0 / 11) + t * F.lit(k / 110.0)
             + F.lit((k * k - 10) / 858.0) * (t * t - F.lit(10.0)))
        term = w * F.element_at(F.col(around), centre + F.lit(k))
        total = term if total is None else total + term
    return total


def model_frame(final: DataFrame, features: Sequence[str] = tuple(S.PHYSICAL_FEATURES),
                window: int = S.ROLLING_WINDOW, smooth: bool = True,
                block_width: int = seg.DEFAULT_BLOCK_WIDTH,
                seg_len: int = seg.DEFAULT_SEG_LEN, bounded: bool = False) -> DataFrame:
    """Final dataset -> targets, position features, rolling mean/std, SoH_smoothed.

    W4: ``{f}_mean`` = mean of the last ``window`` rows (fewer at the start).
    W5: ``{f}_std`` = sample std of the same rows, 0 for a single row.
    W6: SoH smoothed per battery when it has >= 11 rows (then clipped to
    [0, 1]); shorter batteries keep SoH unchanged.
    """
    d = with_position(with_targets(final), block_width, bounded=bounded)
    d = seg.halo_segments(d, "cycle_index", seg_len=seg_len,
                          before=max(window - 1, 2 * HALF), after=2 * HALF, bounded=bounded)
    w = seg.segment_window(["battery_id"], "cycle_index", bounded=bounded)
    roll = w.rowsBetween(-(window - 1), 0)
    cols = {}
    for f in features:
        cols[f"{f}_mean"] = F.avg(f).over(roll)
        cols[f"{f}_std"] = F.coalesce(F.stddev_samp(f).over(roll), F.lit(0.0))
    if smooth:
        cols["_sg_around"] = F.collect_list("SoH").over(w.rowsBetween(-2 * HALF, 2 * HALF))
    d = seg.drop_halo(d.withColumns(cols))
    if smooth:
        long_enough = F.col("n_cycles") >= S.SAVGOL_WINDOW
        d = (d.withColumn("_sg", F.when(long_enough, _savgol_terms("_sg_around")))
              .withColumn("SoH_smoothed", F.when(long_enough, clip("_sg", 0.0, 1.0))
                          .otherwise(F.col("SoH")))
              .drop("_sg", "_sg_around"))
    return d
