"""Split size rules, scaling conventions, sequence counts and weights."""

import pytest

from cellhealth.operators import scaling, sequences, split


@pytest.mark.parametrize("n,expected", [(1, (0, 1, 0)), (2, (0, 1, 1)), (3, (1, 1, 1)),
                                        (10, (7, 2, 1)), (90, (62, 18, 10))])
def test_split_sizes(spark, n, expected):
    df = spark.createDataFrame([(f"t{n}", f"b{i:03d}") for i in range(n)],
                               "battery_type string, battery_id string")
    a = split.assign_splits(df).collect()
    got = tuple(sum(1 for r in a if r.split == s) for s in ("train", "val", "test"))
    assert got == expected
    assert sorted(a) == sorted(split.assign_splits(df, bounded=False).collect())
    assert len({r.battery_id for r in a}) == n


def test_split_is_stratified_and_disjoint(spark):
    rows = [(t, f"{t}-{i}") for t, k in (("x", 1), ("y", 2), ("z", 13)) for i in range(k)]
    a = split.assign_splits(spark.createDataFrame(rows, "battery_type string, battery_id string"))
    got = a.collect()
    assert len(got) == len(rows)
    assert len({r.battery_id for r in got}) == len(rows)
    again = split.assign_splits(spark.createDataFrame(rows, "battery_type string, battery_id string"))
    assert sorted(got) == sorted(again.collect())      # deterministic


def test_scaler_constant_column_and_roundtrip(spark):
    df = spark.createDataFrame([(1.0, 5.0, "train"), (3.0, 5.0, "train"), (7.0, 6.0, "test")],
                               "x double, k double, split string")
    st = scaling.fit_scaler(df.filter("split = 'train'"), ["x", "k"])
    sc = scaling.scale(df, st, ["x", "k"], suffix="_s").orderBy("x").collect()
    assert [r.x_s for r in sc] == [0.0, 1.0, 3.0]          # no clipping
    assert [r.k_s for r in sc] == [0.0, 0.0, 1.0]          # constant -> unit range
    back = scaling.unscale(scaling.scale(df, st, ["x", "k"], suffix="_s"), st, ["x", "k"],
                           suffix="_b", src_suffix="_s").collect()
    for r in back:
        assert r.x_b == pytest.approx(r.x) and r.k_b == pytest.approx(r.k)
    long = {r.feature: (r.min, r.max) for r in scaling.scaler_long(st, ["x", "k"]).collect()}
    assert long == {"x": (1.0, 3.0), "k": (5.0, 5.0)}


def _frame(spark, sizes):
    rows = [(f"b{b}", "regular", c, c, float(c), float(b), c / n)
            for b, n in enumerate(sizes) for c in range(1, n + 1)]
    return spark.createDataFrame(rows, "battery_id string, battery_type string, cycle int, "
                                       "cycle_index long, f1 double, f2 double, cycle_norm double")


def test_sequence_counts_and_content(spark):
    df = _frame(spark, [20, 21, 45])
    for seg_len in (4096, 23):
        seqs = sequences.build_sequences(df, ["f1", "f2"], seg_len=seg_len).collect()
        counts = {}
        for r in seqs:
            counts[r.battery_id] = counts.get(r.battery_id, 0) + 1
            assert len(r.seq) == 20
            assert [x[0] for x in r.seq] == [float(c) for c in range(r.cycle - 20, r.cycle)]
            assert all(x[1] == float(r.battery_id[1:]) for x in r.seq)   # never crosses
        assert counts == {"b1": 1, "b2": 25}


def test_weights_in_range(spark):
    df = _frame(spark, [30])
    w = sequences.with_sample_weight(sequences.build_sequences(df, ["f1"])).collect()
    assert all(1.0 <= r.weight <= 2.0 for r in w)
    vec = sequences.assemble(sequences.build_sequences(df, ["f1", "f2"])).first().features
    assert vec.size == 40
