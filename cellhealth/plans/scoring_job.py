"""Batch scoring job: readings in, SoH % / RUL cycles / health band out.

Loads the one pipeline that ``training.write_outputs`` saved for single readings (S12:
validation, cold start, scaling, both models, bounds, band), scores every reading with it
and writes the scored and the rejected readings.
The streaming form of the same job is ``streaming.score_stream``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellhealth import schema as S
from cellhealth.operators import models, scoring, stages
from cellhealth.sources import readers, sinks


def load_scorer(spark: SparkSession, model_dir: str):
    """(scaler statistics, SoH model, RUL model) from a training output folder."""
    base = model_dir.rstrip("/")
    return (readers.load_scaler(spark, f"{base}/scalers/scorer_scaler"),
            models.load_model(f"{base}/models/scorer_soh_model"),
            models.load_model(f"{base}/models/scorer_rul_model"))


def run_scoring(readings: DataFrame, model_dir: str, out_dir: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    scorer = stages.load_pipeline(f"{model_dir.rstrip('/')}/models/reading_pipeline")
    scored = scorer.transform(readings)
    rejected = scoring.validate_readings(readings)[1].select("request_id", "reason")
    if out_dir:
        out = out_dir.rstrip("/")
        sinks.write_parquet(scored, f"{out}/scored")
        sinks.write_parquet(rejected, f"{out}/rejected")
    return scored, rejected


def main(argv: list[str] | None = None) -> None:
    """``python -m cellhealth.plans.scoring_job <readings json> <training out> <out dir>``"""
    import argparse

    ap = argparse.ArgumentParser(description="score readings with the trained scorer")
    ap.add_argument("readings", help="JSON lines with the reading fields")
    ap.add_argument("models", help="output folder of the training job")
    ap.add_argument("out", help="output folder (scored/, rejected/)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cellhealth-scoring").getOrCreate()
    run_scoring(spark.read.schema(S.READING_SCHEMA).json(a.readings), a.models, a.out)


if __name__ == "__main__":
    main()
