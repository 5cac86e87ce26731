"""Boosting ends itself: Huber rounds against a plain loop, history, and a contract that can fail."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellhealth.operators import models
from cellhealth.plans import catalog, training
from tests.conftest import SF_MID


def test_stop_rule_waits_for_patience():
    slow = [1e-4 * 0.995 ** i for i in range(50)]         # each improves by less than 1 %
    assert models.stop_rule(slow, 20) == (50, False)
    assert models.stop_rule([5, 4, 4.5, 4.4, 3, 3.5, 3, 4], 3) == (5, True)
    assert models.stop_rule([5, 4, 4.5, 4.4, 4.3, 1], 3) == (2, True)   # 1 comes too late
    assert models.stop_rule([float("nan")] * 4, 2) == (4, False)


def grow(x, y, w, depth, cuts):
    """A regression tree of least weighted squared error over the given cuts, as a function of rows."""
    mean = np.average(y, weights=w)
    best = (0.0, None, None)
    for f in range(x.shape[1]) if depth else ():
        for cut in cuts[f]:
            left = x[:, f] <= cut
            if left.all() or not left.any():
                continue
            sse = sum((w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum() for m in (left, ~left))
            gain = (w * (y - mean) ** 2).sum() - sse
            if gain > best[0] + 1e-12:
                best = (gain, f, cut)
    if best[1] is None:
        return lambda rows: np.full(len(rows), mean)
    left = x[:, best[1]] <= best[2]
    a, b = (grow(x[m], y[m], w[m], depth - 1, cuts) for m in (left, ~left))
    return lambda rows: np.where(rows[:, best[1]] <= best[2], a(rows), b(rows))


def huber(e, delta):
    a = np.abs(e)
    return e * e if delta is None else np.where(a <= delta, 0.5 * e * e, delta * (a - 0.5 * delta))


@pytest.mark.parametrize("delta,weighted", [(None, False), (0.3, True)])
def test_boosting_equals_a_plain_loop(spark, delta, weighted):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 9, (120, 3)).astype(float)
    y = np.sin(x[:, 0]) + 0.3 * x[:, 1] + 0.2 * rng.standard_normal(120)
    y[::10] += 4                                             # outliers that Huber holds
    w = rng.uniform(1, 2, 120) if weighted else np.ones(120)
    val = np.arange(120) % 3 == 0
    rows = [(str(i), "t", i, Vectors.dense(x[i]), float(y[i]), bool(val[i]), float(w[i])) for i in range(120)]
    df = spark.createDataFrame(rows, ["battery_id", "battery_type", "cycle", "features", "y", "is_val", "w"])
    params = models.TreeParams(max_iter=12, max_depth=3, patience=3, partitions=3)
    got = models.fit_regressor(df, "y", params, weight="w" if weighted else None, delta=delta)

    values = [np.unique(c) for c in x[~val].T]
    cuts = [(v[:-1] + v[1:]) / 2 for v in values]
    pred, exp, trees = np.zeros(120), [], []
    for i in range(12):
        e = y - pred
        target = y if not i else e if delta is None else np.clip(e, -delta, delta)
        tree = grow(x[~val], target[~val], w[~val], 3, cuts)
        trees.append(tree)
        pred = pred + (1.0 if not i else params.step_size) * tree(x)
        e = y - pred
        exp.append(((huber(e, delta) * w)[~val].sum() / (~val).sum(), huber(e, delta)[val].mean(),
                    np.sqrt((e[~val] ** 2).mean()), np.sqrt((e[val] ** 2).mean())))
        if models.stop_rule([r[1] for r in exp], 3)[1]:
            break
    kept = models.stop_rule([r[1] for r in exp], 3)[0]
    assert np.allclose([r[1:5] for r in got.rounds], exp)
    assert [r[5] for r in got.rounds] == [i < kept for i in range(len(exp))]
    want = sum((1.0 if not i else params.step_size) * t(x) for i, t in enumerate(trees[:kept]))
    out = got.transform(df).orderBy("cycle").select("prediction").collect()
    assert got.getNumTrees == kept and np.allclose([r.prediction for r in out], want)


def test_no_round_after_the_rule_and_no_worse_than_before(spark):
    t = catalog.trained(spark, SF_MID)
    # Validation mean squared errors of the models this library fitted before, with MLlib's own loop.
    before = {"soh": 0.0001698, "rul": 0.0002005}
    for name, m in (("soh", t.soh_model), ("rul", t.rul_model)):
        kept, ended = models.stop_rule([r[2] for r in m.rounds], models.TreeParams.patience)
        assert ended and len(m.rounds) == kept + models.TreeParams.patience and m.getNumTrees == kept > 1
        assert m.rounds[kept - 1][4] ** 2 <= before[name]
        val = t.seqs.filter(F.col("split") == "val")
        label = {"soh": "SoH_smoothed", "rul": "rul_ratio_s"}[name]
        rmse = m.transform(val).agg(F.sqrt(F.avg((F.col(label) - F.col("prediction")) ** 2))).first()[0]
        assert rmse == pytest.approx(m.rounds[kept - 1][4])


def test_history_contract_can_fail(spark):
    rounds = [(i + 1, 1.0, loss, 1.0, 1.0, i < 2) for i, loss in enumerate([3.0, 1.0, 2.0, 1.5])]

    def holds(rounds, n_trees, patience=2):
        h = spark.createDataFrame([("soh", *r) for r in rounds], "model string, " + models.ROUND_SCHEMA)
        trees = spark.createDataFrame([("soh", n_trees)], "model string, n_trees int")
        return catalog.history_contract(h, trees, patience).first().asDict()

    assert all(holds(rounds, 2).values())
    assert not holds(rounds, 3)["kept_up_to_best"]                       # a wrong cut
    assert not holds(rounds, 2, patience=1)["ended_by_patience"]         # a round too many
    assert not holds([(*r[:5], r[0] < 4) for r in rounds], 2)["kept_up_to_best"]
    assert not holds([(*rounds[0][:2], float("nan"), *rounds[0][3:]), *rounds[1:]], 2)["losses_finite"]


def test_history_holds_the_patience_rounds(spark):
    h = training.history(catalog.trained(spark, SF_MID))
    last = {r.model: (r.n, r.k) for r in h.groupBy("model").agg(
        F.count("*").alias("n"), F.count_if("kept").alias("k")).collect()}
    assert all(n == k + models.TreeParams.patience for n, k in last.values()) and len(last) == 2
