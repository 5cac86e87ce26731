"""Training plan outputs, persistence round trips, and stream = batch."""

import os

import pytest
from pyspark.sql import functions as F

from cellhealth import fixtures
from cellhealth.operators import models, scoring
from cellhealth.operators.models import TreeParams
from cellhealth.plans import catalog, training
from cellhealth.sources import readers
from tests.conftest import SF_SMALL

CFG = training.TrainingConfig(params=TreeParams(max_iter=3, max_depth=2, max_bins=8))


@pytest.fixture(scope="module")
def trained(small_trained):
    return small_trained[0]


def test_no_training_batteries_is_an_error(spark):
    st = catalog.Stages(spark, SF_SMALL)   # 2/2/1 batteries per type: none in train
    with pytest.raises(ValueError, match="no training batteries"):
        training.fit_all(st.final, CFG, frame=st.features)


def test_predictions_bounds_and_summary(spark, trained):
    soh = training.soh_predictions(trained).collect()
    assert soh and all(0.0 <= r.predicted_soh <= 1.0 for r in soh)
    rul = training.rul_predictions(trained).collect()
    assert rul and all(r.predicted_rul_cycles >= 0 for r in rul)
    h = training.history(trained).collect()
    assert {r.model for r in h} == {"soh", "rul"}
    rec = training.summary(trained, CFG).first()
    assert rec.train_batteries + rec.val_batteries + rec.test_batteries == 50
    assert 1 <= rec.best_soh_epoch <= 3


def test_outputs_round_trip(spark, trained, tmp_out):
    training.write_outputs(trained, tmp_out, CFG)
    st = readers.load_scaler(spark, os.path.join(tmp_out, "scalers/feature_scaler"))
    assert sorted(st.first().asDict().items()) == sorted(trained.stats.first().asDict().items())
    m = models.load_model(os.path.join(tmp_out, "models/soh_model"))
    test = trained.seqs.filter(F.col("split") == "test")
    a = sorted(r.prediction for r in m.transform(test).collect())
    b = sorted(r.prediction for r in trained.soh_model.transform(test).collect())
    assert a == b
    from cellhealth.plans import scoring_job
    rd = fixtures.readings(spark, SF_SMALL)
    got, rej = scoring_job.run_scoring(rd, tmp_out, os.path.join(tmp_out, "scoring"))
    exp, _ = scoring.score_readings(rd, trained.scorer_stats, trained.scorer_soh,
                                    trained.scorer_rul)
    assert sorted(got.collect()) == sorted(exp.collect())
    assert spark.read.parquet(os.path.join(tmp_out, "scoring", "rejected")).count() == rej.count()
    rec = spark.read.json(os.path.join(tmp_out, "metrics_summary"))
    assert rec.count() == 1 and "soh_rmse_pct" in rec.columns
    assert spark.read.option("header", True).csv(os.path.join(tmp_out, "eol_results")).count() > 0


def test_score_stream_equals_batch(spark, trained, tmp_out):
    from cellhealth.streaming import score_stream
    rd = fixtures.readings(spark, SF_SMALL)
    src = os.path.join(tmp_out, "src")
    rd.write.option("maxRecordsPerFile", 300).json(src)   # 1000 readings -> 4 batches
    q = score_stream.start_score_stream(spark, src, os.path.join(tmp_out, "out"),
                                        os.path.join(tmp_out, "ck"), trained.scorer_stats,
                                        trained.scorer_soh, trained.scorer_rul,
                                        max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(tmp_out, "out", "scored")).drop("batch")
    batch, rejected = scoring.score_readings(rd, trained.scorer_stats, trained.scorer_soh,
                                             trained.scorer_rul)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    rej = spark.read.parquet(os.path.join(tmp_out, "out", "rejected")).drop("batch")
    assert sorted(rej.collect()) == sorted(rejected.collect())


def test_cycle_stream_equals_batch(spark):
    a = sorted(catalog.q41_stream_cycle_aggregate(spark, SF_SMALL).collect())
    b = sorted(catalog.q03_cycle_aggregate(spark, SF_SMALL).collect())
    assert a == b


def test_models_beat_mean_and_are_deterministic(spark, trained):
    train = trained.seqs.filter(F.col("split") == "train")
    mean = train.agg(F.avg(S_TARGET)).first()[0]
    test = training.soh_predictions(trained)
    model_rmse = test.agg(F.sqrt(F.avg((F.col("predicted_soh") - F.col("actual_soh")) ** 2))).first()[0]
    mean_rmse = test.agg(F.sqrt(F.avg((F.lit(mean) - F.col("actual_soh")) ** 2))).first()[0]
    assert model_rmse < mean_rmse
    tv = models.with_validation_flag(trained.seqs)
    again = models.fit_regressor(tv, S_TARGET, CFG.params, delta=0.1)
    probe = trained.seqs.filter(F.col("split") == "test")
    a = [r.prediction for r in trained.soh_model.transform(probe).orderBy("battery_id", "cycle").collect()]
    b = [r.prediction for r in again.transform(probe).orderBy("battery_id", "cycle").collect()]
    assert a == b


S_TARGET = "SoH_smoothed"
