"""Aggregate metrics.

Every metric is one distributed aggregate (partial aggregation before the
shuffle); nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, key: str = "battery_id", strata: str = "battery_type") -> DataFrame:
    """A3: rows, distinct batteries, distinct types and their sorted list.

    One aggregate per (battery, type), combined map-side; the rest runs on
    that small table, so no row is copied per distinct count.
    """
    own = df.groupBy(key, strata).agg(F.count(F.lit(1)).alias("_n"))
    per_key = own.groupBy(key).agg(F.sum("_n").alias("_n"), F.collect_set(strata).alias("_t"))
    types = F.array_sort(F.array_distinct(F.flatten(F.collect_set("_t"))))
    return (per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                        F.count(key).alias("n_batteries"), types.alias("_types"))
                   .select("n_rows", "n_batteries", F.size("_types").cast("long").alias("n_types"),
                           F.concat_ws(",", "_types").alias("types")))


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (row_feature, col_feature, r).

    Two passes, each one aggregate: the column means and ranges (a few
    numbers, used as literals), then the sums of centred products for every pair (the stable
    two-pass form).  Plain sums
    keep the aggregation buffer small enough for whole-stage code generation
    (one buffer field per pair instead of four for ``covar_pop``).  A
    constant column (smallest value = largest value) gives null.
    """
    cols = list(cols)
    means = df.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                   *[(F.min(c) == F.max(c)).alias(f"_c{i}") for i, c in enumerate(cols)]).first()
    constant = {i for i in range(len(cols)) if means[f"_c{i}"]}
    centred = df.select(*[(F.col(c) - F.lit(means[f"_m{i}"]).cast("double")).alias(f"_d{i}")
                          for i, c in enumerate(cols)])
    sums = []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            sums.append(F.sum(F.col(f"_d{i}") * F.col(f"_d{j}")).alias(f"s{i}_{j}"))
    one = centred.agg(*sums)
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            if constant & {i, j}:
                parts.append(f"'{a}', '{b}', double(null)")
                continue
            parts.append(f"'{a}', '{b}', try_divide(s{lo}_{hi}, sqrt(s{i}_{i} * s{j}_{j}))")
    return one.selectExpr(
        f"stack({len(cols) ** 2}, {', '.join(parts)}) as (row_feature, col_feature, r)")


def regression_metrics(df: DataFrame, y: str, yhat: str, scale: float = 1.0,
                       prefix: str = "") -> DataFrame:
    """RMSE and MAE (times ``scale``) and R^2 in one aggregate.

    R^2 = 1 - SS_res / SS_tot; with SS_tot = 0 it is 1 for a perfect fit and
    0 otherwise.
    """
    e = F.col(yhat) - F.col(y)
    d = df.agg(F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("_mae"),
               F.sum(e * e).alias("_ssr"), (F.var_pop(y) * F.count(y)).alias("_sst"))
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_ssr") == 0, 1.0).otherwise(0.0))
           .otherwise(F.lit(1.0) - F.col("_ssr") / F.col("_sst")))
    return d.select((F.sqrt("_mse") * F.lit(scale)).alias(f"{prefix}rmse"),
                    (F.col("_mae") * F.lit(scale)).alias(f"{prefix}mae"),
                    r2.alias(f"{prefix}r2"))


def huber(e: Column, delta: float) -> Column:
    a = F.abs(e)
    return F.when(a <= F.lit(delta), F.lit(0.5) * e * e).otherwise(
        F.lit(delta) * (a - F.lit(0.5 * delta)))


def huber_loss(df: DataFrame, y: str, yhat: str, delta: float,
               weight: str | None = None) -> DataFrame:
    """A10: mean Huber loss; weighted form is sum(w * loss) / count."""
    loss = huber(F.col(yhat) - F.col(y), delta)
    if weight is not None:
        loss = loss * F.col(weight)
    return df.agg((F.sum(loss) / F.count(F.lit(1))).alias("huber_loss"),
                  F.count(F.lit(1)).alias("n"))


def weight_range(df: DataFrame, weight: str = "weight") -> DataFrame:
    """Smallest and largest sample weight."""
    return df.agg(F.min(weight).alias("min_weight"), F.max(weight).alias("max_weight"))


def best_epoch(history: DataFrame, group: str = "model") -> DataFrame:
    """First epoch of minimum validation loss (ties -> smaller epoch)."""
    best = F.min(F.struct("val_loss", "epoch"))
    return (history.groupBy(group).agg(best.alias("_b"))
                   .select(group, F.col("_b.epoch").alias("best_epoch"),
                           F.col("_b.val_loss").alias("best_val_loss")))
