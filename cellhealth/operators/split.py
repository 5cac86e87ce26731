"""Battery-group split stratified by battery type.

Every battery of a type gets a pseudo-random position from
``md5(battery_id || '-' || seed)``; positions are computed with block
ordinals (the hash prefix is the block), so even a type holding a third of
all batteries is never ranked inside one task.  Size rules per type with n
batteries: n_tr = max(1, int(0.7 n)), n_vl = max(1, int(0.2 n)),
n_te = max(1, n - n_tr - n_vl), and one fewer train battery when the three
exceed n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.operators import segments as seg


def split_order_key(key: str = "battery_id", seed: int = S.SEED) -> F.Column:
    """Deterministic shuffle key: md5 of ``<id>-<seed>`` as hex."""
    return F.md5(F.concat_ws("-", F.col(key), F.lit(str(seed))))


def assign_splits(frame: DataFrame, seed: int = S.SEED,
                  ratios: tuple[float, float] = S.SPLIT_RATIOS,
                  key: str = "battery_id", strata: str = "battery_type",
                  bounded: bool = False) -> DataFrame:
    """One row per (strata, key) with ``split`` in train / val / test."""
    bats = frame.select(strata, key).distinct().withColumn("_h", split_order_key(key, seed))
    blk = F.conv(F.substring("_h", 1, 4), 16, 10).cast("long")
    d = seg.block_ordinals(bats, [strata], ["_h", key], blk, bounded=bounded)
    p, n = F.col("_ord") - 1, F.col("_n")
    d = (d.withColumn("_a", F.greatest(F.lit(1), F.floor(n * F.lit(float(ratios[0])))))
          .withColumn("_v", F.greatest(F.lit(1), F.floor(n * F.lit(float(ratios[1])))))
          .withColumn("_t", F.greatest(F.lit(1), n - F.col("_a") - F.col("_v")))
          .withColumn("_a", F.when(F.col("_a") + F.col("_v") + F.col("_t") > n,
                                   F.col("_a") - 1).otherwise(F.col("_a"))))
    a, v, t = F.col("_a"), F.col("_v"), F.col("_t")
    split = (F.when(p < a, "train").when(p < a + v, "val").when(p < a + v + t, "test"))
    return d.select(strata, key, split.alias("split"))


def with_split(frame: DataFrame, assignment: DataFrame, key: str = "battery_id") -> DataFrame:
    """Tag every row with the split(s) of its battery (membership on ``key``).

    The assignment has one row per battery; the planner broadcasts it when
    its measured size is small and otherwise splits the skewed side.
    """
    return frame.join(assignment.select(key, "split").distinct(), on=key, how="inner")


def rows_in(frame: DataFrame, assignment: DataFrame, split: str,
            key: str = "battery_id") -> DataFrame:
    """J2 as a semi-join: rows of the batteries assigned to ``split``."""
    members = assignment.filter(F.col("split") == split).select(key)
    return frame.join(members, on=key, how="left_semi")


def split_summary(tagged: DataFrame, key: str = "battery_id",
                  strata: str = "battery_type") -> DataFrame:
    """A4: per split, rows, batteries and the sorted list of types.

    The battery ids themselves stay in the assignment table (one row each)
    rather than in an unbounded list.
    """
    return (tagged.groupBy("split")
                  .agg(F.count(F.lit(1)).alias("n_rows"),
                       F.countDistinct(key).alias("n_batteries"),
                       F.concat_ws(",", F.array_sort(F.collect_set(strata))).alias("types")))
