"""Fixed-length cycle sequences (W7, E15, M1) and the window-mean baseline.

The sequence of a target row is the feature rows of the ``seq_len``
preceding cycles of the same battery; a battery of n rows yields
max(0, n - seq_len) sequences and sequences never cross batteries.  Built
with a ROWS frame over halo segments, so no task holds an unbounded battery.
Build them before rows are tagged with splits: a battery id in two splits then
has the same windows in both, and no window sees a row twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.operators import segments as seg


def build_sequences(frame: DataFrame, features: Sequence[str], seq_len: int = S.SEQ_LEN,
                    ord_col: str = "cycle_index", keys: Sequence[str] = ("battery_id",),
                    baselines: Sequence[str] = (),
                    seg_len: int = seg.DEFAULT_SEG_LEN,
                    bounded: bool = False) -> DataFrame:
    """Add ``seq`` (array of ``seq_len`` feature arrays) to every target row.

    ``baselines``: for column c also adds ``{c}_window_mean``, the mean of c
    over the same input window (a naive forecaster used as reference model).
    """
    d = seg.halo_segments(frame, ord_col, seg_len=seg_len, before=seq_len, bounded=bounded)
    w = seg.segment_window(list(keys), ord_col, bounded=bounded).rowsBetween(-seq_len, -1)
    cols = {"seq": F.collect_list(F.array(*[F.col(f).cast("double") for f in features])).over(w)}
    for c in baselines:
        cols[f"{c}_window_mean"] = F.avg(c).over(w)
    d = d.withColumns(cols)
    return seg.drop_halo(d).filter(F.col(ord_col) > F.lit(seq_len))


def with_sample_weight(seqs: DataFrame) -> DataFrame:
    """Early-life weight 1 + (1 - cycle_norm) of the target row."""
    return seqs.withColumn("weight", F.lit(2.0) - F.col("cycle_norm"))


def step_places(features: Sequence[str], chosen: Sequence[str], seq_len: int = S.SEQ_LEN
                ) -> list[int]:
    """Where the columns ``chosen`` stand in windows assembled over ``features``."""
    at = {f: i for i, f in enumerate(features)}
    return [step * len(features) + at[f] for step in range(seq_len) for f in chosen]


def steps_of(seqs: DataFrame, features: Sequence[str], chosen: Sequence[str],
             seq_len: int = S.SEQ_LEN, src: str = "features", out: str = "features"
             ) -> DataFrame:
    """M1: of windows assembled over ``features`` keep the columns ``chosen``."""
    from pyspark.ml.feature import VectorSlicer

    wanted = step_places(features, chosen, seq_len)
    cut = VectorSlicer(inputCol=src, outputCol="_cut", indices=wanted).transform(seqs)
    return cut.drop(src).withColumnRenamed("_cut", out)


def assemble(seqs: DataFrame, out: str = "features") -> DataFrame:
    """M1: flatten the (seq_len x n_feat) window into one ML vector."""
    from pyspark.ml.functions import array_to_vector
    return seqs.withColumn(out, array_to_vector(F.flatten("seq")))


def explode_sequences(seqs: DataFrame, features: Sequence[str],
                      keys: Sequence[str] = ("battery_id", "battery_type", "cycle")) -> DataFrame:
    """Long form: one row per (target, position) with the feature values as columns."""
    d = seqs.select(*keys, F.posexplode("seq").alias("pos", "_v"))
    return d.select(*keys, "pos", *[F.col("_v")[i].alias(f) for i, f in enumerate(features)])
