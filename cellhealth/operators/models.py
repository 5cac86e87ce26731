"""Distributed regressors on cycle windows (M2-M7).

The reference trains two recurrent networks on one machine.  The Spark form
of the same capability: flatten each 20-cycle window into one vector (M1)
and boost regression trees on all training sequences, on the Huber loss
and with the stopping rule of the original (M4, ``fit_regressor``).  Bounds of the
reference's output activations are kept by clipping: SoH in [0, 1], RUL ratio >= 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import (GBTRegressionModel, LinearRegression,
                                   LinearRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhealth.functions.expressions import clip
from cellhealth.operators import boosting

ROUND_SCHEMA = ("epoch int, loss double, val_loss double, rmse double, val_rmse double, "
                "kept boolean")
WINDOW_KEYS = ("battery_id", "battery_type", "cycle")


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters.

    ``max_iter`` is a ceiling.  Boosting ends before it once ``patience``
    iterations in a row bring no smaller validation loss; the trees up to the
    least one are kept.  ``partitions``: over how many partitions at least the training
    rows are dealt by a hash of their keys, whatever the machine; more rows take more.
    ``max_bins``: at most 256.  ``step_size`` applies
    to plain residuals (MLlib's own boosting doubles them: its 0.1 is 0.2 here).
    """
    max_iter: int = 50
    max_depth: int = 4
    max_bins: int = 32
    step_size: float = 0.2
    subsampling_rate: float = 1.0
    patience: int = 20
    seed: int = 42
    partitions: int = 16


def stop_rule(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """M4: how many iterations to keep, and whether the rule ended before the losses did.

    Kept are those up to the first least loss that ``patience`` iterations after
    it do not beat.  Losses that are not finite (no validation rows) say nothing:
    all iterations are kept.
    """
    best = None
    for i, loss in enumerate(losses):
        if math.isfinite(loss) and (best is None or loss < losses[best]):
            best = i
        elif best is not None and i - best >= patience:
            return best + 1, True
    return (len(losses) if best is None else best + 1), False


def bin_rows(train_val: DataFrame, columns: Sequence[str], params: TreeParams,
             features: str = "features", validation: str = "is_val",
             keys: Sequence[str] = WINDOW_KEYS) -> boosting.Binned:
    """The rows of one or more fits on the same features, binned and written once."""
    return boosting.bin_rows(train_val, columns, keys, params.max_bins, params.partitions,
                             features, validation)


def fit_regressors(rows: boosting.Binned, fits: Sequence[boosting.Fit],
                   params: TreeParams = TreeParams()) -> list[GBTRegressionModel]:
    """M2/M3/M4: stage-wise boosting of regression trees that ends itself, for several models
    on the same rows, side by side: one job a tree level for all of them.

    Each fit names its label, the weights of training rows, the ``delta`` of its Huber loss
    (None: squared) and the features it may use.  The first tree is fitted on the label, each
    further one on the pseudo-residuals of the model so far (``boosting``).  Once ``patience``
    rounds in a row bring no smaller validation loss no further tree is fitted, and the model
    is cut at the least one (``stop_rule``).

    A model's ``rounds`` are (epoch, loss, val_loss, rmse, val_rmse, kept) of every round.
    """
    def ended(fit: boosting.Fit) -> bool:
        return (len(fit.trees) >= params.max_iter
                or stop_rule([x[1] for x in fit.losses], params.patience)[1])

    boosting.boost(rows, fits, params.max_depth, params.step_size, ended,
                   params.subsampling_rate, params.seed)
    out = []
    for fit in fits:
        kept = stop_rule([x[1] for x in fit.losses], params.patience)[0]
        model = boosting.to_model(fit.trees[:kept], rows.cuts, params.step_size, rows.features,
                                  fit.chosen)
        model.rounds = [(i + 1, *x, i < kept) for i, x in enumerate(fit.losses)]
        out.append(model)
    return out


def fit_regressor(train_val: DataFrame, label: str, params: TreeParams = TreeParams(),
                  weight: str | None = None, features: str = "features",
                  validation: str = "is_val", keys: Sequence[str] = WINDOW_KEYS,
                  delta: float | None = None) -> GBTRegressionModel:
    """One model of ``fit_regressors``; ``train_val`` holds the training rows and the
    validation rows, told apart by the boolean column ``validation``."""
    rows = bin_rows(train_val, [label, *([weight] if weight else [])], params, features,
                    validation, keys)
    try:
        return fit_regressors(rows, [boosting.Fit(label, weight, delta)], params)[0]
    finally:
        rows.drop()


def fit_robust(train: DataFrame, label: str, weight: str | None = None,
               features: str = "features", epsilon: float = 1.35, reg: float = 1e-3,
               max_iter: int = 100) -> LinearRegressionModel:
    """M3, robust option: a linear regressor on MLlib's own Huber loss.

    ``epsilon`` counts in units of the scale that is fitted with it (it must exceed 1, so it is
    not the original's delta); features are standardised while fitting, the L2 penalty keeps
    correlated steps of a window in bounds.
    """
    lr = LinearRegression(featuresCol=features, labelCol=label, predictionCol="prediction",
                          loss="huber", epsilon=epsilon, regParam=reg, standardization=True,
                          maxIter=max_iter)
    return (lr.setWeightCol(weight) if weight else lr).fit(train)


def training_history(model: GBTRegressionModel, name: str, spark: SparkSession) -> DataFrame:
    """M5/R2: losses and RMSE of every boosting round (1-based ``epoch``), training and
    validation; ``kept`` tells the rounds of the model from those of its patience."""
    h = spark.createDataFrame(model.rounds, ROUND_SCHEMA)
    return h.select(F.lit(name).alias("model"), "*")


def score(model: GBTRegressionModel, seqs: DataFrame, out: str,
          lo: float | None = None, hi: float | None = None) -> DataFrame:
    """M6: batch scoring, prediction clipped to the model's output range."""
    scored = model.transform(seqs)
    return scored.withColumn(out, clip("prediction", lo, hi)).drop("prediction")


def score_rul(model: GBTRegressionModel, seqs: DataFrame, out: str) -> DataFrame:
    """M6 for remaining life: the scaled prediction is held at 0 or above."""
    return score(model, seqs, out, 0.0)


def save_model(model: GBTRegressionModel, path: str) -> None:
    """Persist a fitted model."""
    model.write().overwrite().save(path)


def load_robust(path: str) -> LinearRegressionModel:
    """Reload a robust linear model."""
    return LinearRegressionModel.load(path)


def load_model(path: str) -> GBTRegressionModel:
    """Reload a fitted model."""
    return GBTRegressionModel.load(path)


def with_validation_flag(seqs: DataFrame, split_col: str = "split") -> DataFrame:
    """Training + validation rows with the boolean flag GBT early stopping needs."""
    return (seqs.filter(F.col(split_col).isin("train", "val"))
                .withColumn("is_val", F.col(split_col) == F.lit("val")))
