"""The skew-safe window kernel against plain per-group windows.

Tiny block widths and segment lengths force the multi-block and
multi-segment paths that the small test tables never reach.
"""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cellhealth.operators import segments as seg


def _frame(spark, groups):
    rows = [(g, c, float(v)) for g, cs in groups.items() for c, v in cs]
    return spark.createDataFrame(rows, "g string, c int, v double")


def _check(spark, groups, block_width, seg_len, bounded=False):
    df = _frame(spark, groups)
    o = seg.block_ordinals(df, ["g"], ["c"], F.floor(F.col("c") / block_width),
                           prefix_sums=["v"], group_max=["c"], bounded=bounded)
    h = seg.halo_segments(o, seg_len=seg_len, before=3, after=2, bounded=bounded)
    w = seg.segment_window(["g"], bounded=bounded)
    got = seg.drop_halo(h.select(
        "*", F.sum("v").over(w.rowsBetween(-3, 0)).alias("roll"),
        F.lead("v", 2).over(w).alias("ahead"))).collect()
    pw = Window.partitionBy("g").orderBy("c")
    ref = df.select("*", F.row_number().over(pw).alias("rn"),
                    F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"),
                    F.sum("v").over(pw.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                    F.max("c").over(Window.partitionBy("g")).alias("mx"),
                    F.sum("v").over(pw.rowsBetween(-3, 0)).alias("roll"),
                    F.lead("v", 2).over(pw).alias("ahead")).collect()
    g = {(r.g, r.c): (r._ord, r._n, round(r._cum_v, 9), r._max_c, round(r.roll, 9), r.ahead)
         for r in got}
    e = {(r.g, r.c): (r.rn, r.n, round(r.cum, 9), r.mx, round(r.roll, 9), r.ahead)
         for r in ref}
    assert g == e


def test_dense_and_sparse_groups(spark):
    rnd = random.Random(7)
    groups = {
        "dense": [(c, rnd.random()) for c in range(50)],
        "sparse": [(c, rnd.random()) for c in range(0, 500, 37)],
        "one": [(5, 1.0)],
        "neg": [(c, rnd.random()) for c in range(-20, 10)],
    }
    _check(spark, groups, block_width=4, seg_len=5)
    _check(spark, groups, block_width=1000, seg_len=4096)
    _check(spark, groups, block_width=4, seg_len=5, bounded=True)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from("abcd"),
                       st.sets(st.integers(-50, 200), min_size=1, max_size=40),
                       min_size=1, max_size=4),
       st.integers(1, 9), st.integers(3, 7))
def test_random_groups(spark, groups, block_width, seg_len):
    g = {k: [(c, (c * 37 % 11) / 7.0) for c in sorted(v)] for k, v in groups.items()}
    _check(spark, g, block_width, seg_len)
    _check(spark, g, block_width, seg_len, bounded=True)


def test_ties_rank(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", 3, "x"),
                                ("a", 3, "y"), ("a", 3, "z")], "g string, c int, t string")
    for bounded in (False, True):
        o = seg.block_ordinals(df, ["g"], ["c", "t"], F.floor(F.col("c") / 2), ties_on="c",
                               bounded=bounded)
        got = sorted((r.c, r.t, r._ord, r._rank_min, r._ties) for r in o.collect())
        _ties_expected(got)


def _ties_expected(got):
    assert got == [(1, "x", 1, 1, 2), (1, "y", 2, 1, 2), (2, "x", 3, 3, 1),
                   (3, "x", 4, 4, 3), (3, "y", 5, 4, 3), (3, "z", 6, 4, 3)]
