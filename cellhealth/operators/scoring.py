"""Scoring of single readings and fleet bands.

A reading carries the six per-cycle measurements of one cycle; it becomes a
cold-start feature row (window mean = the value, window std = 0), repeated
into a full-length sequence and scored by the fitted models.  Readings with
a missing required field are returned separately with the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.functions.expressions import health_status


def validate_readings(df: DataFrame,
                      required: Sequence[str] = tuple(S.REQUIRED_READING_FIELDS)
                      ) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); ``reason`` names the first missing field."""
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing field: {c}"))
                           for c in required])
    d = df.withColumn("reason", missing)
    return d.filter(F.col("reason").isNull()).drop("reason"), d.filter(F.col("reason").isNotNull())


def cold_start_features(df: DataFrame, features: Sequence[str] = tuple(S.CORR_FEATURES)
                        ) -> DataFrame:
    """The 27-column feature row of one reading.

    Defaults: cycle 1, cycle_rank 0.5; cumul_voltage_drop = cycle * voltage_drop;
    ``{f}_mean`` = value, ``{f}_std`` = 0.
    """
    d = (df.withColumn("cycle", F.coalesce(F.col("cycle").cast("double"),
                                           F.lit(S.DEFAULT_READING_CYCLE)))
           .withColumn("cycle_rank", F.coalesce(F.col("cycle_rank").cast("double"),
                                                F.lit(S.DEFAULT_READING_CYCLE_RANK)))
           .withColumn("cumul_voltage_drop", F.col("cycle") * F.col("voltage_drop")))
    cols = {}
    for f in features:
        cols[f"{f}_mean"] = F.col(f).cast("double")
        cols[f"{f}_std"] = F.lit(0.0)
    return d.withColumns(cols)


def cold_start_sequence(df: DataFrame, features: Sequence[str], seq_len: int = S.SEQ_LEN
                        ) -> DataFrame:
    """The feature row repeated ``seq_len`` times as the input window."""
    return df.withColumn("seq", F.array_repeat(F.array(*[F.col(f) for f in features]), seq_len))


def with_status(df: DataFrame, soh_pct: str = "soh_pct") -> DataFrame:
    """Health band of the SoH percentage."""
    return df.withColumn("status", health_status(soh_pct))


def fleet_summary(scored: DataFrame, key: str = "battery_id", order: str = "cycle_index",
                  soh_pct: str = "soh_pct", rul: str = "rul_cycles") -> DataFrame:
    """M8: latest state of every battery, counted and averaged per band.

    The latest row per battery comes from ``max_by`` over plain numbers: a hash
    aggregate combined map-side, without a sort.
    """
    last = with_status(scored.groupBy(key).agg(
        F.max_by(soh_pct, order).alias(soh_pct), F.max_by(rul, order).alias(rul)), soh_pct)
    return last.groupBy("status").agg(F.count(F.lit(1)).alias("n_batteries"),
                                      F.avg(soh_pct).alias("mean_soh_pct"),
                                      F.avg(rul).alias("mean_rul_cycles"))


def score_readings(readings: DataFrame, scorer_stats, soh_model, rul_model,
                   features: Sequence[str] = tuple(S.FEATURES_27),
                   seq_len: int = S.SEQ_LEN) -> tuple[DataFrame, DataFrame]:
    """M7: validate -> cold-start features -> scale -> repeat -> both models.

    Returns (scored, rejected).  ``SOH`` is the SoH model's output (held in
    [0, 1]) in percent, ``RUL`` the remaining-cycles model's output (held at 0
    or above, then brought back to cycles); both rounded to 2 places (half up),
    plus the health band.  ``scorer_stats``: the fitted scaler, as its one-row
    table or its resolved numbers (``scaling.scaler_params``).
    """
    from cellhealth.operators.models import score, score_rul
    from cellhealth.operators.scaling import scale, scaler_params, unscale_with
    from cellhealth.operators.sequences import assemble

    scorer_stats = scaler_params(scorer_stats)
    ok, rejected = validate_readings(readings)
    fr = scale(cold_start_features(ok), scorer_stats, list(features), suffix="_s")
    sq = assemble(cold_start_sequence(fr, [f"{f}_s" for f in features], seq_len))
    sq = sq.select("request_id", "features")
    s2 = score_rul(rul_model, score(soh_model, sq, "_soh", 0.0, 1.0), "_rul")
    s2 = unscale_with(s2, scorer_stats, "remaining_cycles", ["_rul"])
    out = s2.select("request_id", F.round(F.col("_soh") * F.lit(100.0), 2).alias("SOH"),
                    F.round("_rul", 2).alias("RUL"))
    return with_status(out, "SOH"), rejected.select("request_id", "reason")
