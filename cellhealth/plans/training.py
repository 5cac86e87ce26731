"""The training / evaluation job as Spark jobs.

final dataset -> model frame (features, smoothed SoH) -> stratified battery
split -> min-max scaling fitted on train -> 20-cycle sequences, built once per
battery and written once -> gradient-boosted regressors for SoH and RUL ratio
on Huber losses, ended by the validation loss -> all sequences scored once (written) ->
from that table the predictions, metrics, end-of-life report and summary.  A
second pair of models on the 27 features the single-reading scorer can build
serves ``scoring``; its windows are columns of the same sequences.  All steps
are DataFrame jobs; models are MLlib.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.operators import (eol, features, metrics, models, scaling, sequences, split,
                                  stages)
from cellhealth.operators.boosting import Fit
from cellhealth.operators.models import TreeParams
from cellhealth.session import write_stage
from cellhealth.sources import sinks


@dataclass(frozen=True)
class TrainingConfig:
    features: tuple = tuple(S.FEATURES_30)
    scorer_features: tuple = tuple(S.FEATURES_27)
    seq_len: int = S.SEQ_LEN
    params: TreeParams = TreeParams()
    threshold: float = S.FAILURE_THRESHOLD
    seed: int = S.SEED
    parallelism: int = 4        # parts of the summary worked out side by side


@dataclass
class Trained:
    frame: DataFrame
    assignment: DataFrame       # (battery_type, battery_id, split), written
    stats: DataFrame
    windows: DataFrame          # one row per target cycle of each battery, written
    seqs: DataFrame             # windows tagged with the split(s) of their battery
    soh_model: object
    rul_model: object
    scorer_stats: DataFrame
    scorer_soh: object
    scorer_rul: object
    scored: DataFrame = None    # every window with both predictions, written
    robust_rul: object = None   # linear regressor of the RUL ratio on Huber loss


TARGETS = [S.RUL_TARGET, "remaining_cycles"]


def _windows(frame: DataFrame, stats: DataFrame, feats: list[str], seq_len: int) -> DataFrame:
    """Scale features and targets with train statistics, then build windows per battery."""
    sc = scaling.scale(frame, stats, feats + TARGETS, suffix="_s")
    seqs = sequences.build_sequences(sc, [f"{c}_s" for c in feats], seq_len=seq_len)
    seqs = sequences.assemble(sequences.with_sample_weight(seqs))
    keep = ["battery_id", "battery_type", "cycle", "cycle_index", "max_cycle",
            "SoH", S.SOH_TARGET, S.RUL_TARGET, "remaining_cycles", "cycle_norm", "weight",
            "features"] + [f"{t}_s" for t in TARGETS]
    return seqs.select(*keep)


def fit_all(final: DataFrame, cfg: TrainingConfig = TrainingConfig(),
            frame: DataFrame | None = None) -> Trained:
    """Everything up to fitted models and scored windows; ``frame`` reuses an
    already written feature table instead of deriving it from ``final``."""
    if frame is None:
        frame = write_stage(features.model_frame(final), "features")
    asg = write_stage(split.assign_splits(frame, seed=cfg.seed), "assignment")
    if asg.filter(F.col("split") == "train").limit(1).count() == 0:
        raise ValueError("no training batteries: every battery type has fewer than 3 "
                         "batteries, so the split rules assign none to train")
    train = split.rows_in(frame, asg, "train")
    feats, sfeats = list(cfg.features), list(cfg.scorer_features)

    # One fit of the statistics; each scaler is a set of its columns.
    both = list(dict.fromkeys(feats + sfeats))
    full = write_stage(scaling.fit_scaler(train, both + TARGETS), "scaler")
    pick = lambda cols: full.select(*[f"{c}__{k}" for c in cols for k in ("min", "max")])
    stats, sstats = pick(feats + [S.RUL_TARGET]), pick(sfeats + ["remaining_cycles"])
    windows = write_stage(_windows(frame, full, both, cfg.seq_len), "windows")
    own = lambda cols: (windows if cols == both else
                        sequences.steps_of(windows, both, cols, cfg.seq_len))
    seqs = split.with_split(own(feats), asg)
    p, soh, rul = cfg.params, S.SOH_TARGET, f"{S.RUL_TARGET}_s"
    # Rows are binned and written once; the four fits share them and every pass over them.
    rows = models.bin_rows(models.with_validation_flag(split.with_split(windows, asg)),
                           [soh, rul, "remaining_cycles_s", "weight"], p)
    mine, scorer = (sequences.step_places(both, cols, cfg.seq_len) for cols in (feats, sfeats))
    try:
        soh_model, rul_model, scorer_soh, scorer_rul = models.fit_regressors(rows, [
            Fit(soh, None, S.SOH_HUBER_DELTA, mine),
            Fit(rul, "weight", S.RUL_HUBER_DELTA, mine),
            Fit(soh, None, S.SOH_HUBER_DELTA, scorer),
            Fit("remaining_cycles_s", None, S.RUL_HUBER_DELTA, scorer)], p)
    finally:
        rows.drop()
    robust = models.fit_robust(split.rows_in(own(feats), asg, "train"), rul, "weight")
    t = Trained(frame, asg, stats, windows, seqs, soh_model, rul_model, sstats, scorer_soh,
                scorer_rul, robust_rul=robust)
    t.scored = write_stage(score_windows(own(feats), soh_model, rul_model, stats), "scored")
    return t


def score_windows(windows: DataFrame, soh_model, rul_model, stats) -> DataFrame:
    """Every window with its SoH and RUL predictions (SoH held in [0, 1], the scaled
    RUL ratio at 0 or above; cycles = ratio x max_cycle)."""
    sc = models.score(soh_model, windows, "predicted_soh", 0.0, 1.0)
    sc = models.score_rul(rul_model, sc, "predicted_ratio_s")
    sc = scaling.unscale_with(sc.withColumn("_ratio", F.col("predicted_ratio_s")), stats,
                              S.RUL_TARGET, ["_ratio"])
    ratio = F.greatest(F.col("_ratio"), F.lit(0.0))
    return sc.select("battery_id", "battery_type", "cycle", "cycle_index", "SoH",
                     F.col(S.SOH_TARGET).alias("actual_soh"), "predicted_soh",
                     F.col(f"{S.RUL_TARGET}_s").alias("actual_ratio_s"), "predicted_ratio_s",
                     (F.col(S.RUL_TARGET) * F.col("max_cycle")).alias("actual_rul_cycles"),
                     (ratio * F.col("max_cycle")).alias("predicted_rul_cycles"))


def robust_predictions(t: Trained, split_name: str = "test") -> DataFrame:
    """M3, robust option: RUL in cycles of one split's windows, ratio held at 0 or above."""
    w = t.seqs.filter(F.col("split") == split_name)
    sc = scaling.unscale_with(models.score_rul(t.robust_rul, w, "_ratio"), t.stats,
                              S.RUL_TARGET, ["_ratio"])
    return sc.select("battery_id", "battery_type", "cycle",
                     (F.col(S.RUL_TARGET) * F.col("max_cycle")).alias("actual_rul_cycles"),
                     (F.greatest(F.col("_ratio"), F.lit(0.0)) * F.col("max_cycle"))
                     .alias("predicted_rul_cycles"))


def history(t: Trained) -> DataFrame:
    """R2/M5: training and validation loss / RMSE of every boosting round, also of those whose
    trees were not kept."""
    spark = t.seqs.sparkSession
    return models.training_history(t.soh_model, "soh", spark).unionByName(
        models.training_history(t.rul_model, "rul", spark))


def scored_split(t: Trained, split_name: str | None = "test") -> DataFrame:
    """The scored windows of one split's batteries (or of all, each once)."""
    return t.scored if split_name is None else split.rows_in(t.scored, t.assignment, split_name)


def soh_predictions(t: Trained, split_name: str | None = "test") -> DataFrame:
    """S7 data: actual vs predicted SoH."""
    return scored_split(t, split_name).select(
        "battery_id", "battery_type", "cycle", "cycle_index", "SoH", "actual_soh", "predicted_soh")


def rul_predictions(t: Trained, split_name: str | None = "test") -> DataFrame:
    """S8 data: RUL in cycles."""
    return scored_split(t, split_name).select(
        "battery_id", "battery_type", "cycle", "actual_rul_cycles", "predicted_rul_cycles")


def model_eol(t: Trained, threshold: float = S.FAILURE_THRESHOLD) -> DataFrame:
    """A12 with model predictions over every battery, each once."""
    return eol.eol_report(t.scored, actual="SoH", predicted="predicted_soh",
                          threshold=threshold)


def summary(t: Trained, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """The record of a training run, from its scored windows; beside the trees' RMSE of RUL
    that of the robust linear model."""
    record = summary_record(t.scored, t.assignment, history(t), cfg)
    linear = metrics.regression_metrics(robust_predictions(t), "actual_rul_cycles",
                                        "predicted_rul_cycles").first()
    rmse = None if linear.rmse is None else round(float(linear.rmse), 4)
    return record.withColumn("rul_linear_rmse_cycles", F.lit(rmse).cast("double"))


def summary_record(scored: DataFrame, assignment: DataFrame, epochs: DataFrame,
                   cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """One record with accuracy, EOL error, best epochs, split sizes, config.

    ``scored`` has the columns of ``score_windows`` (from whichever forecaster),
    one row per window; ``epochs`` the validation loss per model and epoch.
    Each part is one distributed aggregate returning one row (the parts run
    side by side); the record is assembled from those scalars.  The batteries
    of each split are in the assignment table, saved beside the record.
    """
    spark = scored.sparkSession
    test, val = (split.rows_in(scored, assignment, name) for name in ("test", "val"))
    parts = {
        "soh": lambda: metrics.regression_metrics(
            test, "actual_soh", "predicted_soh", scale=100.0, prefix="soh_").first(),
        "rul": lambda: metrics.regression_metrics(
            test, "actual_rul_cycles", "predicted_rul_cycles", prefix="rul_").first(),
        "mae": lambda: eol.eol_mae(eol.eol_report(
            scored, actual="SoH", predicted="predicted_soh", threshold=cfg.threshold)).first(),
        # Validation RMSE (SoH in its own units, RUL ratio scaled).
        "v_soh": lambda: metrics.regression_metrics(val, "actual_soh", "predicted_soh").first(),
        "v_rul": lambda: metrics.regression_metrics(
            val, "actual_ratio_s", "predicted_ratio_s").first(),
        "best": lambda: {r.model: r.best_epoch for r in metrics.best_epoch(epochs).collect()},
        "sizes": lambda: assignment.agg(*[F.count(F.when(F.col("split") == s, 1)).alias(s)
                                          for s in ("train", "val", "test")]).first(),
    }
    # Independent one-row aggregates: run them side by side.
    run = inheritable_thread_target(spark)(lambda fn: fn())
    with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
        done = {k: pool.submit(run, fn) for k, fn in parts.items()}
        got = {k: f.result() for k, f in done.items()}
    soh, rul, mae, v_soh, v_rul, best, sizes = (got[k] for k in parts)

    def r(x, n):
        return None if x is None else round(float(x), n)

    values = [
        ("soh_rmse_pct", r(soh.soh_rmse, 4), "double"), ("soh_mae_pct", r(soh.soh_mae, 4), "double"),
        ("soh_r2", r(soh.soh_r2, 4), "double"),
        ("rul_rmse_cycles", r(rul.rul_rmse, 4), "double"),
        ("rul_mae_cycles", r(rul.rul_mae, 4), "double"), ("rul_r2", r(rul.rul_r2, 4), "double"),
        ("eol_mean_abs_error_cycles", r(mae.eol_mean_abs_error_cycles, 1), "double"),
        ("soh_val_rmse", r(v_soh.rmse, 6), "double"),
        ("rul_val_rmse_scaled", r(v_rul.rmse, 6), "double"),
        ("best_soh_epoch", best.get("soh"), "int"), ("best_rul_epoch", best.get("rul"), "int"),
        ("train_batteries", sizes.train, "long"), ("val_batteries", sizes.val, "long"),
        ("test_batteries", sizes.test, "long"),
        ("split_table", "split_assignment", "string"),
        ("seq_len", cfg.seq_len, "int"), ("max_iter", cfg.params.max_iter, "int"),
        ("failure_threshold", cfg.threshold, "double"),
        ("soh_label_smoothing", S.SUMMARY_SMOOTHING, "string"),
        ("split_ratios", S.SUMMARY_SPLIT, "string"),
        ("rul_target", S.SUMMARY_RUL_TARGET, "string"),
    ]
    cols = [F.lit(v).cast(typ).alias(name) for name, v, typ in values]
    cols.insert(18, F.array(*[F.lit(f) for f in cfg.features]).alias("features"))
    return spark.range(1).select(*cols)


def pipelines(t: Trained, cfg: TrainingConfig = TrainingConfig()) -> dict:
    """The two whole ways of scoring, each one object: single readings, a model frame."""
    return {"reading_pipeline": stages.reading_pipeline(
                t.scorer_stats, t.scorer_soh, t.scorer_rul, cfg.scorer_features, cfg.seq_len),
            "window_pipeline": stages.window_pipeline(
                t.stats, t.soh_model, t.rul_model, cfg.features, cfg.seq_len)}


def write_outputs(t: Trained, out_dir: str, cfg: TrainingConfig = TrainingConfig()) -> dict:
    """Prediction CSVs with their keys, EOL CSV, split table, round history, summary
    JSON, scalers, models, whole pipelines.  Returns the summary record, which is computed once."""
    out = out_dir.rstrip("/")
    spark = t.scored.sparkSession
    # O1: the original writes its predictions and report in battery and cycle order.
    sinks.write_sorted_csv(soh_predictions(t).drop("cycle_index", "SoH"), f"{out}/soh_predictions")
    sinks.write_sorted_csv(rul_predictions(t), f"{out}/rul_predictions")
    sinks.write_sorted_csv(model_eol(t, cfg.threshold), f"{out}/eol_results", ["battery_id"])
    sinks.write_parquet(t.assignment, f"{out}/split_assignment")
    sinks.write_csv(history(t), f"{out}/training_history")
    record = summary(t, cfg)
    row = record.first()
    sinks.write_record(spark.createDataFrame([row], record.schema), f"{out}/metrics_summary")
    sinks.save_scaler(t.stats, f"{out}/scalers/feature_scaler")
    sinks.save_scaler(t.scorer_stats, f"{out}/scalers/scorer_scaler")
    for name, m in (("soh_model", t.soh_model), ("rul_model", t.rul_model),
                    ("scorer_soh_model", t.scorer_soh), ("scorer_rul_model", t.scorer_rul),
                    ("robust_rul_model", t.robust_rul)):
        models.save_model(m, f"{out}/models/{name}")
    for name, m in pipelines(t, cfg).items():
        stages.save_pipeline(m, f"{out}/models/{name}")
    return row.asDict()


def main(argv: list[str] | None = None) -> None:
    """``python -m cellhealth.plans.training <final dataset> <out dir> [--format F]``"""
    import argparse
    import json

    from pyspark.sql import SparkSession

    from cellhealth.sources import readers

    ap = argparse.ArgumentParser(description="final dataset -> models, predictions, report")
    ap.add_argument("final", help="final per-cycle dataset written by the ETL job")
    ap.add_argument("out", help="output folder")
    ap.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    ap.add_argument("--max-iter", type=int, default=TreeParams.max_iter)
    ap.add_argument("--max-depth", type=int, default=TreeParams.max_depth)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cellhealth-training").getOrCreate()
    cfg = TrainingConfig(params=TreeParams(max_iter=a.max_iter, max_depth=a.max_depth))
    t = fit_all(readers.read_cycles(spark, a.final, a.format), cfg)
    record = write_outputs(t, a.out, cfg)
    print(json.dumps({k: v for k, v in record.items() if k != "features"}))


if __name__ == "__main__":
    main()
