"""Per-cycle records and life labels.

``aggregate_cycles`` is a hash aggregate with map-side partial aggregation, so
raw readings are combined before the shuffle and a hot battery spreads over
its (battery, type, cycle) keys.  Everything after it runs on the per-cycle
table, orders of magnitude smaller than the raw telemetry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.functions.expressions import cycle_bucket, safe_ratio
from cellhealth.operators import segments as seg
from cellhealth.operators.clean import drop_incomplete

ORDER = ["cycle", "battery_type"]  # cycle order per battery; type breaks ties


def with_cycle(df: DataFrame, width: float = S.CYCLE_WIDTH) -> DataFrame:
    """``cycle = trunc(time / width)`` as int; out of range -> null."""
    return df.withColumn("cycle", cycle_bucket("time", width))


def cycle_measures() -> list[Column]:
    """A1 + E8: the aggregates of one cycle's readings (``S.CYCLE_MEASURES``)."""
    return [F.avg("voltage_load").alias("avg_voltage"),
            F.min("voltage_load").alias("min_voltage"),
            F.avg("current_load").alias("avg_current"),
            F.max("temperature_battery").alias("max_temp"),
            (F.max("time") - F.min("time")).alias("duration")]


def aggregate_cycles(df: DataFrame) -> DataFrame:
    """A1 + E8: one row per (battery_id, battery_type, cycle)."""
    return df.groupBy(*S.CYCLE_KEYS).agg(*cycle_measures())


def aggregate_cycles_by_file(readings: DataFrame, path_col: str = "file_path",
                             width: float = S.CYCLE_WIDTH, **patterns: str) -> DataFrame:
    """A1 from cleaned readings that still carry only their file path.

    Aggregates per (file, cycle) first - map-side combined like A1 - then
    parses battery_id / battery_type on those rows and merges files that map
    to the same identity (sums and counts for the means, min / max as they
    are).  The result equals ``aggregate_cycles`` on readings with identity
    columns, but the path regexes run once per file-cycle, not per reading.
    ``patterns``: ``id_pattern`` / ``type_pattern`` of another path layout.
    """
    from cellhealth.operators.clean import with_identity

    per_file = (with_cycle(readings, width).groupBy(path_col, "cycle")
                .agg(F.sum("voltage_load").alias("_sv"), F.count("voltage_load").alias("_nv"),
                     F.min("voltage_load").alias("_minv"),
                     F.sum("current_load").alias("_sc"), F.count("current_load").alias("_nc"),
                     F.max("temperature_battery").alias("_maxt"),
                     F.max("time").alias("_t1"), F.min("time").alias("_t0")))
    per_file = with_identity(per_file, path_col, **patterns)
    return (per_file.groupBy(*S.CYCLE_KEYS)
                    .agg((F.sum("_sv") / F.sum("_nv")).alias("avg_voltage"),
                         F.min("_minv").alias("min_voltage"),
                         (F.sum("_sc") / F.sum("_nc")).alias("avg_current"),
                         F.max("_maxt").alias("max_temp"),
                         (F.max("_t1") - F.min("_t0")).alias("duration")))


def _cycle_block(width: int) -> F.Column:
    return F.floor(F.col("cycle") / F.lit(width))


def placed(cycles: DataFrame) -> DataFrame:
    """Rows with a cycle: a null cycle cannot be placed on the cycle axis (such
    rows would be removed by the final null check anyway)."""
    return cycles.filter(F.col("cycle").isNotNull())


def battery_ordinals(cycles: DataFrame, block_width: int = seg.DEFAULT_BLOCK_WIDTH,
                     bounded: bool = False, **extra) -> DataFrame:
    """Position of every cycle row inside its battery (``_ord``, ``_n``)."""
    return seg.block_ordinals(placed(cycles), ["battery_id"], ORDER,
                              _cycle_block(block_width), bounded=bounded, **extra)


def _rul_soh(df: DataFrame) -> DataFrame:
    return (df.withColumn("RUL", F.col("max_cycle") - F.col("cycle"))
              .withColumn("SoH", F.lit(1.0) - safe_ratio("cycle", "max_cycle")))


def with_rul_soh(cycles: DataFrame, block_width: int = seg.DEFAULT_BLOCK_WIDTH,
                 bounded: bool = False) -> DataFrame:
    """A2 + E9 + E10 in skew-safe form: max cycle from the block table."""
    d = battery_ordinals(cycles, block_width, bounded=bounded, group_max=["cycle"])
    d = d.withColumn("max_cycle", F.col("_max_cycle")).drop("_max_cycle", "_ord", "_n")
    return _rul_soh(d)


def with_rul_soh_join(cycles: DataFrame) -> DataFrame:
    """The reference's self-join with the per-battery maximum.

    The aggregate combines map-side; the join is left to the planner, which
    broadcasts the per-battery table when its measured size is small and
    otherwise splits skewed join partitions (AQE skew join).
    """
    mx = cycles.groupBy("battery_id").agg(F.max("cycle").alias("max_cycle"))
    return _rul_soh(cycles.join(mx, on="battery_id", how="inner"))


def with_rul_soh_window(cycles: DataFrame) -> DataFrame:
    """Window form ``max(cycle) over (partition by battery_id)``.

    Kept for equivalence tests; it puts a whole battery into one task.
    """
    return _rul_soh(cycles.withColumn(
        "max_cycle", F.max("cycle").over(Window.partitionBy("battery_id"))))


def final_dataset(cycles: DataFrame, block_width: int = seg.DEFAULT_BLOCK_WIDTH,
                  seg_len: int = seg.DEFAULT_SEG_LEN, bounded: bool = False
                  ) -> DataFrame:
    """W1 + E9-E13 + E5: the per-cycle training table.

    ``prev_*`` is the previous cycle row of the same battery_id (ties on
    cycle broken by battery_type); the first row per battery and rows with
    any null are dropped.
    """
    d = battery_ordinals(cycles, block_width, bounded=bounded, group_max=["cycle"])
    d = d.withColumn("max_cycle", F.col("_max_cycle")).drop("_max_cycle", "_n")
    d = seg.halo_segments(d, seg_len=seg_len, before=1, bounded=bounded)
    w = seg.segment_window(["battery_id"], bounded=bounded)
    d = (d.withColumn("prev_voltage", F.lag("avg_voltage").over(w))
          .withColumn("prev_temp", F.lag("max_temp").over(w)))
    d = seg.drop_halo(d)
    d = _rul_soh(d)
    d = (d.withColumn("voltage_drop", F.col("avg_voltage") - F.col("prev_voltage"))
          .withColumn("temp_change", F.col("max_temp") - F.col("prev_temp"))
          .withColumn("cycle_ratio", safe_ratio("cycle", "max_cycle")))
    return drop_incomplete(d.select(*S.FINAL_COLUMNS))
