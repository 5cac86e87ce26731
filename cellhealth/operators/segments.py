"""Skew-safe ordered windows over very long groups.

``Window.partitionBy("battery_id")`` sends every row of a battery to one task.
One battery may hold a third of all cycles, so the per-battery windows of this
package (lag, running sums, ranks, rolling statistics, smoothing, sequences)
never partition by the group key alone.  They run in two steps:

1. ``block_ordinals`` - the 1-based position of every row inside its group,
   computed without a per-group task: rows are cut into blocks of a monotone
   block key (e.g. ``floor(cycle / 4096)``), each block is counted (a partial
   aggregate), a running sum over the *block* table gives every block its
   offset, and a ``row_number`` inside ``(group, block)`` finishes the job.
   Group totals (size, max, running sums) come from the same block table.
   The block table is ``rows / block_width`` long; AQE broadcasts it when its
   measured size is under the broadcast threshold and otherwise shuffles it on
   ``(group, block)``, a balanced key.
2. ``halo_segments`` - rows are cut into segments of ``seg_len`` consecutive
   ordinals; the last ``before`` rows of a segment are copied into the next
   segment and the first ``after`` rows into the previous one, flagged
   ``_halo``.  A window ``partitionBy(group, _seg).orderBy(_ord)`` then sees
   every row its bounded ROWS frame needs, and the halo copies are filtered
   out afterwards.  A task holds at most ``seg_len + before + after`` rows.

This form is used whatever the input's size: nothing is measured first, no
job starts while a plan is built, and the order of running sums depends on
``block_width`` alone.  A caller who knows that every group is small may pass
``bounded=True`` and get plain ``partitionBy(group)`` windows instead; it is
never chosen automatically.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_WIDTH = 4096
DEFAULT_SEG_LEN = 4096


def block_ordinals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    block: Column,
    prefix_sums: Sequence[str] = (),
    group_max: Sequence[str] = (),
    ties_on: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Attach ``_ord`` (1-based position in ``keys`` ordered by ``order``) and ``_n``.

    ``block`` must be non-decreasing along ``order`` and non-null.  Extras:

    * ``prefix_sums`` - for column ``c`` adds ``_cum_c``, the running sum up to
      and including the row (block prefix + in-block running sum).
    * ``group_max`` - for column ``c`` adds ``_max_c``, the group maximum.
    * ``ties_on`` - adds ``_rank_min`` (1-based rank of the first row holding
      the same ``ties_on`` value) and ``_ties`` (rows sharing it).  Equal values
      must fall into one block, which holds when ``block`` is a function of
      ``ties_on``.
    """
    keys = list(keys)
    if bounded:
        return _plain_ordinals(df, keys, order, prefix_sums, group_max, ties_on)
    d = df.withColumn("_blk", block)
    blk_aggs = [F.count(F.lit(1)).alias("_bn")]
    blk_aggs += [F.sum(c).alias(f"_bs_{c}") for c in prefix_sums]
    blk_aggs += [F.max(c).alias(f"_bm_{c}") for c in group_max]
    stats = d.groupBy(*keys, "_blk").agg(*blk_aggs)

    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, "_blk",
            F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
            F.sum("_bn").over(whole).alias("_n")]
    cols += [F.coalesce(F.sum(f"_bs_{c}").over(before), F.lit(0.0)).alias(f"_bo_{c}")
             for c in prefix_sums]
    cols += [F.max(f"_bm_{c}").over(whole).alias(f"_max_{c}") for c in group_max]
    stats = stats.select(*cols)

    j = d.join(stats, on=[*keys, "_blk"], how="inner")
    in_block = Window.partitionBy(*keys, "_blk").orderBy(*order)
    j = j.withColumn("_ord", F.col("_off") + F.row_number().over(in_block))
    running = in_block.rowsBetween(Window.unboundedPreceding, 0)
    for c in prefix_sums:
        j = j.withColumn(f"_cum_{c}", F.col(f"_bo_{c}") + F.sum(c).over(running))
    if ties_on is not None:
        by_value = Window.partitionBy(*keys, "_blk").orderBy(ties_on)
        j = j.withColumn("_rank_min", F.col("_off") + F.rank().over(by_value))
        j = j.withColumn(
            "_ties", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_blk", ties_on)))
    drop = ["_blk", "_off"] + [f"_bo_{c}" for c in prefix_sums]
    return j.drop(*drop)


def _plain_ordinals(df, keys, order, prefix_sums, group_max, ties_on) -> DataFrame:
    """The columns of ``block_ordinals`` with per-group windows (bounded groups)."""
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(*order)
    cols = {"_ord": F.row_number().over(ordered).cast("long"),
            "_n": F.count(F.lit(1)).over(whole)}
    for c in prefix_sums:
        cols[f"_cum_{c}"] = F.sum(c).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    for c in group_max:
        cols[f"_max_{c}"] = F.max(c).over(whole)
    if ties_on is not None:
        cols["_rank_min"] = F.rank().over(whole.orderBy(ties_on)).cast("long")
        cols["_ties"] = F.count(F.lit(1)).over(Window.partitionBy(*keys, ties_on))
    return df.withColumns(cols)


def halo_segments(
    df: DataFrame,
    ord_col: str = "_ord",
    seg_len: int = DEFAULT_SEG_LEN,
    before: int = 0,
    after: int = 0,
    bounded: bool = False,
) -> DataFrame:
    """Copy each row into its segment plus neighbouring segments' halos.

    Adds ``_seg`` (segment number) and ``_halo`` (True on copies).  Window over
    ``segment_window(keys, ord_col, bounded)`` and keep ``~_halo`` rows.  With
    ``bounded`` every group is one segment and nothing is copied.
    """
    if bounded:
        return df.withColumn("_seg", F.lit(0).cast("long")).withColumn("_halo", F.lit(False))
    if before > seg_len or after > seg_len:
        raise ValueError("halo wider than a segment")
    i0 = F.col(ord_col) - 1
    seg = F.floor(i0 / F.lit(seg_len))
    pos = i0 - seg * F.lit(seg_len)
    copies = [F.struct(seg.alias("s"), F.lit(False).alias("h"))]
    if before:
        copies.append(F.when(pos >= seg_len - before,
                             F.struct((seg + 1).alias("s"), F.lit(True).alias("h"))))
    if after:
        copies.append(F.when(pos < after,
                             F.struct((seg - 1).alias("s"), F.lit(True).alias("h"))))
    if len(copies) == 1:
        return df.withColumn("_seg", seg).withColumn("_halo", F.lit(False))
    # Plain explode + null filter (no lambda), so the step stays in codegen.
    return (df.withColumn("_copy", F.explode(F.array(*copies)))
              .filter(F.col("_copy").isNotNull())
              .withColumn("_seg", F.col("_copy.s"))
              .withColumn("_halo", F.col("_copy.h"))
              .drop("_copy"))


def segment_window(keys: Sequence[str], ord_col: str = "_ord", bounded: bool = False):
    """The window spec to use on ``halo_segments`` output."""
    if bounded:
        return Window.partitionBy(*keys).orderBy(ord_col)
    return Window.partitionBy(*keys, "_seg").orderBy(ord_col)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_seg", "_halo")
