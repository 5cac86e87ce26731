"""Data behind the reference's plots (R3-R5); R1 is ``metrics.correlation``
and R2 is ``models.training_history``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S


def actual_vs_predicted(df: DataFrame, y: str, yhat: str,
                        threshold: float | None = S.FAILURE_THRESHOLD) -> DataFrame:
    """Actual / predicted pairs with an explicit order key and the threshold line."""
    out = df.select("battery_id", "battery_type", "cycle", F.col(y).alias("actual"),
                    F.col(yhat).alias("predicted"))
    if threshold is not None:
        out = out.withColumn("threshold", F.lit(float(threshold)))
    return out


def battery_curves(frame: DataFrame, scored: DataFrame, batteries: DataFrame,
                   y: str, yhat: str, seq_len: int = S.SEQ_LEN) -> DataFrame:
    """Per-battery actual/predicted curves; too-short batteries get one flag row.

    ``batteries`` holds the battery ids to draw (e.g. the test split).
    """
    ids = batteries.select("battery_id").distinct()
    sizes = (frame.join(ids, "battery_id", "left_semi")
                  .groupBy("battery_id").agg(F.max("n_cycles").alias("n_cycles")))
    curves = (scored.join(ids, "battery_id", "left_semi")
                    .select("battery_id", "cycle", F.col(y).alias("actual"),
                            F.col(yhat).alias("predicted")))
    short = (sizes.filter(F.col("n_cycles") <= seq_len)
                  .select("battery_id", F.lit(None).cast("int").alias("cycle"),
                          F.lit(None).cast("double").alias("actual"),
                          F.lit(None).cast("double").alias("predicted")))
    return (curves.unionByName(short)
                  .join(sizes, "battery_id")
                  .withColumn("too_short", F.col("n_cycles") <= F.lit(seq_len)))


def scatter_limits(df: DataFrame, y: str, yhat: str, name: str) -> DataFrame:
    """Axis limits = min / max over both columns."""
    return df.agg(F.least(F.min(y), F.min(yhat)).alias("lo"),
                  F.greatest(F.max(y), F.max(yhat)).alias("hi")).select(
        F.lit(name).alias("target"), "lo", "hi")
