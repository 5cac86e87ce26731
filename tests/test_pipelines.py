"""One saved pipeline scores raw rows after reload, alike in another process."""

import json
import os
import subprocess
import sys

import pytest

from cellhealth import fixtures
from cellhealth.operators import models, scoring, stages
from cellhealth.operators.models import TreeParams
from cellhealth.plans import training
from tests.conftest import SF_SMALL

CFG = training.TrainingConfig(params=TreeParams(max_iter=3, max_depth=2, max_bins=8))


@pytest.fixture(scope="module")
def trained(small_trained):
    return small_trained[0]


def test_reading_pipeline_in_another_process(spark, trained, tmp_out):
    path = os.path.join(tmp_out, "reading_pipeline")
    stages.save_pipeline(training.pipelines(trained, CFG)["reading_pipeline"], path)
    rd = fixtures.readings(spark, SF_SMALL)
    rd.write.json(os.path.join(tmp_out, "readings"))
    code = f"""
import json
from cellhealth import schema as S
from cellhealth.operators import stages
from cellhealth.session import local_session
spark = local_session(cores=2, shuffle_partitions=2)
rows = spark.read.schema(S.READING_SCHEMA).json({os.path.join(tmp_out, 'readings')!r})
out = stages.load_pipeline({path!r}).transform(rows)
print("ROWS" + json.dumps(sorted(map(list, out.collect()))))
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr[-2000:]
    exp, rejected = scoring.score_readings(rd, trained.scorer_stats, trained.scorer_soh, trained.scorer_rul)
    want = sorted(map(list, exp.select("request_id", "SOH", "RUL", "status").collect()))
    assert json.loads(got.stdout.rpartition("ROWS")[2]) == want
    assert len(want) + rejected.count() == rd.count() and rejected.count() > 0


def test_window_pipeline_equals_the_steps(spark, trained, tmp_out):
    path = os.path.join(tmp_out, "window_pipeline")
    stages.save_pipeline(training.pipelines(trained, CFG)["window_pipeline"], path)
    got = stages.load_pipeline(path).transform(trained.frame)
    assert sorted(got.collect()) == sorted(trained.scored.select(*got.columns).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_robust_model_holds_against_outliers(spark, trained, tmp_out):
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense(float(i), float(i % 7)), 2.0 * i + (500.0 if i % 10 == 0 else 0.0), 1.0 + i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, ["features", "y", "w"])
    m = models.fit_robust(df, "y", "w", reg=0.0)
    assert abs(m.coefficients[0] - 2.0) < 0.05                # least squares would be drawn by 20 outliers of 500
    models.save_model(trained.robust_rul, os.path.join(tmp_out, "robust"))
    again = models.load_robust(os.path.join(tmp_out, "robust"))
    assert again.coefficients == trained.robust_rul.coefficients and again.scale == trained.robust_rul.scale
    p = training.robust_predictions(trained).collect()
    assert p and all(r.predicted_rul_cycles >= 0 for r in p)


def test_stages_keep_their_settings(spark, tmp_out):
    one = stages.Bounded(inputCol="p", outputCol="q", lower=0.0, minimum=2.0, maximum=4.0, factorCol="m", places=1)
    one.save(os.path.join(tmp_out, "stage"))
    again = stages.Bounded.load(os.path.join(tmp_out, "stage"))
    rows = spark.createDataFrame([(-1.0, 10), (0.5, 10), (2.0, 3), (None, 1)], "p double, m int")
    assert [r.q for r in again.transform(rows).collect()] == [20.0, 30.0, 18.0, None]
    nothing = stages.MinMaxScale(inputCols=["p"], mins=[float("nan")], maxs=[float("nan")])
    nothing.save(os.path.join(tmp_out, "scale"))
    again = stages.MinMaxScale.load(os.path.join(tmp_out, "scale"))
    assert {r.p_s for r in again.transform(rows).collect()} == {None}   # no training rows
