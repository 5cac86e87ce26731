"""Steps whose cost must not grow faster than their input."""

import glob

import numpy as np
import pytest
from pyspark.sql import Row

from cellhealth.operators import boosting
from cellhealth.plans import catalog
from cellhealth.sources import readers, sinks


def test_micro_batches_stay_when_files_grow(spark, tmp_out):
    spark.range(0, 60, 1, 1).write.option("maxRecordsPerFile", 1).json(f"{tmp_out}/many")
    spark.range(0, 3, 1, 1).write.option("maxRecordsPerFile", 1).json(f"{tmp_out}/few")
    files = len(glob.glob(f"{tmp_out}/many/part-*"))
    per = catalog.files_per_batch(spark, f"{tmp_out}/many")
    assert files == 60 and per == 3 and -(-files // per) <= catalog.MICRO_BATCHES
    assert catalog.files_per_batch(spark, f"{tmp_out}/few") == 1
    assert catalog.files_per_batch(spark, f"{tmp_out}/many", batches=1) == files


def _counts(df):
    return [(r.side, r.n) for r in df.collect()]


def test_differing_rows_read_each_side_once(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "z"), (4, "z")], "k int, v string")
    got = catalog._differing(a, b, "t")
    assert _counts(got) == [("t: only first", a.exceptAll(b).count()), ("t: only second", b.exceptAll(a).count())]
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "bigint"]
    assert _counts(catalog._differing(a, a, "t")) == [("t: only first", 0), ("t: only second", 0)]
    none = a.limit(0)
    assert _counts(catalog._differing(none, none, "t")) == [("t: only first", 0), ("t: only second", 0)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2


def test_a_folder_is_written_by_one_task(spark, tmp_out):
    rows = [Row(kind=f"k{i % 2}", file=f"b{i % 5}.csv", time=str(i)) for i in range(200)]
    sinks.write_csv_tree(spark.createDataFrame(rows).repartition(8), f"{tmp_out}/t", ["kind", "file"])
    assert len(glob.glob(f"{tmp_out}/t/*/*/part-*")) == 10
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    got = readers.read_telemetry(spark, f"{tmp_out}/t", recursive=True)
    assert sorted(int(r.time) for r in got.collect()) == list(range(200))
    assert spark.conf.get(name) == before
    with readers.few_listing_tasks(spark):
        assert int(spark.conf.get(name)) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before


def _walk(tree, row):
    i = 1
    while tree.feature[i] >= 0:
        i = 2 * i + int(row[tree.feature[i]] > tree.cut[i])
    return tree.total[i] / tree.weight[i], i


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_model_applied_to_blocks_by_feature(depth):
    rng = np.random.default_rng(depth)
    bins, trees = rng.integers(0, 8, (30, 700)).astype(np.uint8), []
    for _ in range(9):
        t = boosting.Tree(depth)
        t.weight[:], t.total[:] = rng.random(len(t.weight)) + 1, rng.normal(size=len(t.total))
        for i in range(1, 1 << depth):
            if (i == 1 or t.feature[i // 2] >= 0) and rng.random() < 0.8:
                t.feature[i], t.cut[i] = rng.integers(30), rng.integers(7)
        trees.append(t)
    want = [sum(_walk(t, row)[0] * (0.2 if j else 1.0) for j, t in enumerate(trees)) for row in bins.T]
    assert np.allclose(boosting.predict(trees, bins, 0.2), want, rtol=0, atol=1e-12)
    ends = trees[0].nodes(bins, depth)
    assert [int(i) for i in ends] == [_walk(trees[0], row)[1] for row in bins.T]


def test_sums_by_node_feature_and_bin():
    rng = np.random.default_rng(5)
    n_nodes, width, dims = 4, 8, 2 * boosting.TOGETHER + 3
    bins, node = rng.integers(0, width, (dims, 300)).astype(np.uint8), rng.integers(0, n_nodes + 1, 300)
    weight, target = rng.random(300), rng.normal(size=300)
    for w in (None, weight):
        got = boosting._sums(bins, node, n_nodes, width, w, target)
        for f in range(dims):
            for k in range(n_nodes):
                for b in range(width):
                    here = (node == k) & (bins[f] == b)
                    assert got[0, k, f, b] == pytest.approx(here.sum() if w is None else w[here].sum())
                    assert got[1, k, f, b] == pytest.approx(target[here].sum())


def test_targets_alone_are_added_up_alike():
    rng = np.random.default_rng(6)
    bins, node = rng.integers(0, 8, (boosting.TOGETHER + 1, 200)).astype(np.uint8), rng.integers(0, 3, 200)
    weight, target = rng.random(200), rng.normal(size=200)
    whole = boosting._sums(bins, node, 2, 8, weight, target)
    alone = boosting._sums(bins, node, 2, 8, weight, target, both=False)
    assert alone.shape == (1, *whole.shape[1:]) and (alone[0] == whole[1]).all()


@pytest.mark.parametrize("weight", [None, "w"])
def test_root_weights_are_added_up_once(spark, weight, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from cellhealth.operators import models

    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(300, boosting.CHUNK + 3)), rng.random(300) + 1
    df = spark.createDataFrame([(str(i), "t", i, Vectors.dense(x[i]), float(x[i, 0] + x[i, 1] ** 2), float(w[i]), i % 5 == 0)
                                for i in range(300)], ["battery_id", "battery_type", "cycle", "features", "y", "w", "is_val"])
    params = models.TreeParams(max_iter=4, max_depth=2, max_bins=8, partitions=3)
    rows = models.bin_rows(df, ["y", "w"], params)
    assert rows.frame.storageLevel.useMemory and rows.frame.storageLevel.useDisk
    trees = []
    try:
        for forget in (False, True):                # the weights of the first tree again, or added up anew
            fit, before = boosting.Fit("y", weight, 0.5), boosting._pass
            if forget:
                monkeypatch.setattr(boosting, "_pass", lambda r, fits, *a: (
                    [setattr(f, "root", None) for f, _ in fits], before(r, fits, *a))[1])
            boosting.boost(rows, [fit], 2, 0.2, lambda f: len(f.trees) >= 4)
            trees.append([(t.feature.tolist(), t.cut.tolist(), t.weight.tolist(), t.total.tolist()) for t in fit.trees])
            if not forget:
                train = np.arange(300) % 5 != 0
                own = w[train] if weight else np.ones(train.sum())
                for f in (0, boosting.CHUNK + 2):
                    at = np.searchsorted(rows.cuts[f], x[train, f], side="left")
                    assert np.allclose(fit.root[f], np.bincount(at, own, fit.root.shape[1]))
    finally:
        rows.drop()
    assert trees[0] == trees[1] and not rows.frame.storageLevel.useMemory


def test_folders_are_dealt_over_all_cores(spark, tmp_out):
    """Few bytes in many folders: their cost is that of the folders, so one task must not write them all."""
    rows = [Row(kind="k", file=f"b{i}.csv", time=str(i)) for i in range(120)]
    sinks.write_csv_tree(spark.createDataFrame(rows), f"{tmp_out}/t", ["kind", "file"])
    files = glob.glob(f"{tmp_out}/t/*/*/part-*")
    tasks = {f.rsplit("/part-", 1)[1].split("-")[0] for f in files}
    assert len(files) == 120 and len(tasks) > spark.sparkContext.defaultParallelism
