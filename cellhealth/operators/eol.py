"""End-of-life report.

EOL cycle = first cycle whose SoH is below the failure threshold, for the
actual and the predicted SoH, per battery, as a conditional ``min`` in one
aggregate (no sort, partial aggregation before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S


def eol_report(scored: DataFrame, actual: str = "SoH", predicted: str = "predicted_SoH",
               threshold: float = S.FAILURE_THRESHOLD, skip: int = S.SEQ_LEN,
               ord_col: str = "cycle_index", key: str = "battery_id") -> DataFrame:
    """A12 + E20 + E24: per battery EOL cycles and their error.

    Rows with ``ord_col <= skip`` (the first cycles, which have no input
    window) are not evaluated.  The error is null when either cycle is null
    or 0.
    """
    d = scored.filter(F.col(ord_col) > F.lit(skip))
    thr = F.lit(float(threshold))
    rep = d.groupBy(key).agg(
        F.min(F.when(F.col(actual) < thr, F.col("cycle"))).alias("actual_eol_cycle"),
        F.min(F.when(F.col(predicted) < thr, F.col("cycle"))).alias("predicted_eol_cycle"))
    err = F.nullif(F.col("predicted_eol_cycle"), F.lit(0)) - F.nullif(
        F.col("actual_eol_cycle"), F.lit(0))
    return (rep.withColumn("error_cycles", err)
               .withColumn("abs_error_cycles", F.abs(F.col("error_cycles"))))


def eol_mae(report: DataFrame) -> DataFrame:
    """Mean absolute EOL error over batteries with an error."""
    return report.agg(F.avg("abs_error_cycles").alias("eol_mean_abs_error_cycles"),
                      F.count("abs_error_cycles").alias("n_batteries_with_error"))
