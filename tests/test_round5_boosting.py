"""Binning and boosting of many rows: the same trees from less work."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from cellhealth.operators import boosting, models

NAMES = ["battery_id", "battery_type", "cycle", "features", "y", "z", "k", "w", "is_val"]


def _rows(spark, n=400, dims=2 * boosting.CHUNK + 3, seed=3):
    """Rows with columns that are the same, columns that split alike and a label that never changes."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).round(1)
    x[:, 5], x[:, boosting.CHUNK + 1], x[:, 9] = x[:, 0], 2 * x[:, 0] + 1, np.floor(x[:, 1])
    y, w = x[:, 0] + x[:, 1] ** 2 + 0.1 * rng.normal(size=n), rng.random(n) + 1
    rows = [(f"b{i % 7}", "t", i, Vectors.dense(x[i]), float(y[i]), float(x[i, 3] > 0), 1.0, float(w[i]), i % 5 == 0)
            for i in range(n)]
    return x, spark.createDataFrame(rows, NAMES).repartition(5)


def test_rows_are_binned_before_they_are_dealt(spark, monkeypatch):
    x, df = _rows(spark)
    seen, before = [], boosting.write_stage
    monkeypatch.setattr(boosting, "write_stage", lambda d, name: (seen.append(d), before(d, name))[1])
    rows = models.bin_rows(df, ["y", "w"], models.TreeParams(max_bins=8, partitions=3))
    try:
        plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
        dealt = plan[plan.index("RepartitionByExpression"):].splitlines()
        assert "MapInArrow" in dealt[1] and "_bins" in dealt[1] and "_x" not in dealt[1].split("_bins")[1]
        assert rows.n_train == 320
        got = {}
        for r in rows.frame.collect():
            y, val = np.frombuffer(r["c0"]), np.frombuffer(r["val"], np.bool_)
            bins = np.frombuffer(r["bins"], np.uint8).reshape(x.shape[1], len(y))
            got |= {float(a): (bool(v), b.tolist()) for a, v, b in zip(y, val, bins.T, strict=True)}
        own = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(rows.cuts)]
        want = {r["y"]: (r["is_val"], [int(b[r["cycle"]]) for b in own]) for r in df.select("y", "is_val", "cycle").collect()}
        assert got == want
    finally:
        rows.drop()


@pytest.mark.parametrize(("max_bins", "rate"), [(8, 1.0), (8, 0.7), (100, 1.0)])
def test_trees_stay_when_features_are_ruled_out_first(spark, monkeypatch, max_bins, rate):
    x, df = _rows(spark)
    dims, order = x.shape[1], np.random.default_rng(4).permutation(x.shape[1])[:-9]
    rows = models.bin_rows(df, ["y", "z", "k", "w"], models.TreeParams(max_bins=max_bins, partitions=3))
    passes, before, got = [], boosting._pass, []
    monkeypatch.setattr(boosting, "_pass", lambda r, fits, *a: (
        passes.append([len(o) for o in a[4]] if a[4] is not None else None), before(r, fits, *a))[1])
    try:
        for least in (0, 1 << 60):
            monkeypatch.setattr(boosting, "SCREEN_ROWS", least)
            fits = [boosting.Fit("y", "w", 0.5), boosting.Fit("z", None, None, order), boosting.Fit("k", None, 0.1),
                    boosting.Fit("y", None, 0.3, order[::-1])]
            boosting.boost(rows, fits, 3, 0.2, lambda f: len(f.trees) >= 4, rate)
            got.append([([(t.feature.tolist(), t.cut.tolist(), t.weight.tolist(), t.total.tolist(), t.gain.tolist())
                          for t in f.trees], f.losses) for f in fits])
        assert got[0] == got[1]
        assert all(len(trees) == 4 and len(losses) == 4 for trees, losses in got[0])
        few = [p for p in passes if p is not None]
        assert few and passes.count(None) >= len(few) and all(p[0] < dims for p in few)
    finally:
        rows.drop()


def test_sums_that_are_no_numbers_rule_nothing_out():
    cuts, chosen = [np.arange(3.0)] * 4, np.array([2, 0, 3])
    sums = np.ones((2, 4, 4))
    sums[1, 2, 1:] = 5.0
    sums[1, 0] = sums[1, 2]
    assert boosting._near({1: sums}, cuts, chosen).tolist() == [2, 0]
    assert boosting._near({1: np.where(sums > 4, np.nan, sums)}, cuts, chosen).tolist() == chosen.tolist()
    none = np.zeros((2, 4, 4))
    none[:, :, 0] = 1.0
    assert boosting._near({1: none}, cuts, chosen).tolist() == [2]
