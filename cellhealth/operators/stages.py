"""Spark ML transformers for what stands around a fitted model.

Each wraps an operator of this package and keeps its settings and fitted numbers as params, so
a whole way of scoring - validation, cold start or windows, scaling, both models, bounds, health
band - is one ``PipelineModel`` that is saved, reloaded and applied as one object.  All of them
are column expressions or the window kernel: no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.functions.expressions import clip
from cellhealth.operators import scaling, scoring, sequences


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose keyword arguments are its params."""

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)


class ValidReadings(_Stage, HasInputCols):
    """Only readings with every required field (``scoring.validate_readings`` gives the others)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return scoring.validate_readings(df, self.getInputCols())[0]


class ColdStart(_Stage, HasInputCols):
    """The 27 feature columns of single readings; ``inputCols`` are the physical ones."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return scoring.cold_start_features(df, self.getInputCols())


class MinMaxScale(_Stage, HasInputCols):
    """(x - min) / range into ``{c}_s`` with fitted numbers, given in the order of ``inputCols``."""

    mins = Param(Params._dummy(), "mins", "fitted minima; nan without training rows", TypeConverters.toListFloat)
    maxs = Param(Params._dummy(), "maxs", "fitted maxima; nan without training rows", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        return scaling.scale(df, _stats(cols, self.getOrDefault("mins"), self.getOrDefault("maxs")), cols, suffix="_s")


class RepeatedWindow(_Stage, HasInputCols, HasOutputCol):
    """E23 + M1: the row's ``inputCols`` repeated ``steps`` times as one vector."""

    steps = Param(Params._dummy(), "steps", "rows of a window", TypeConverters.toInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        seqs = scoring.cold_start_sequence(df, self.getInputCols(), self.getOrDefault("steps"))
        return sequences.assemble(seqs, self.getOutputCol()).drop("seq")


class CycleWindows(_Stage, HasInputCols, HasOutputCol):
    """W7 + M1: the preceding ``steps`` cycles of the same battery as one vector; earlier rows go."""

    steps = Param(Params._dummy(), "steps", "rows of a window", TypeConverters.toInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        seqs = sequences.build_sequences(df, self.getInputCols(), seq_len=self.getOrDefault("steps"))
        return sequences.assemble(seqs, self.getOutputCol()).drop("seq")


class Bounded(_Stage, HasInputCol, HasOutputCol):
    """A raw prediction held at its bounds, brought to units and rounded.

    ``clip`` to [lower, upper], then x * (maximum - minimum) + minimum as the scaler has it,
    then times ``factor``, or the row's ``factorCol``, at 0 or above, rounded half up.
    """

    lower = Param(Params._dummy(), "lower", "least value of the model's output", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "largest value of the model's output", TypeConverters.toFloat)
    minimum = Param(Params._dummy(), "minimum", "fitted minimum of the target", TypeConverters.toFloat)
    maximum = Param(Params._dummy(), "maximum", "fitted maximum of the target", TypeConverters.toFloat)
    factor = Param(Params._dummy(), "factor", "unit of the result", TypeConverters.toFloat)
    factorCol = Param(Params._dummy(), "factorCol", "column that the result is a ratio of", TypeConverters.toString)
    places = Param(Params._dummy(), "places", "decimal places", TypeConverters.toInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        def given(name):
            return self.getOrDefault(name) if self.isDefined(name) else None

        out = self.getOutputCol()
        df = df.withColumn(out, clip(self.getInputCol(), given("lower"), given("upper")))
        if given("minimum") is not None:
            one = _stats([out], [given("minimum")], [given("maximum")])
            df = scaling.unscale_with(df, one, out, [out])
        x = F.col(out)
        if given("factorCol") is not None:
            x = clip(x, 0.0) * F.col(given("factorCol"))
        if given("factor") is not None:
            x = x * F.lit(given("factor"))
        return df.withColumn(out, x if given("places") is None else F.round(x, given("places")))


class HealthBand(_Stage, HasInputCol):
    """``status`` of a state of health in percent."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return scoring.with_status(df, self.getInputCol())


class Columns(_Stage, HasInputCols):
    """Those of ``inputCols`` that the rows have, in this order."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[c for c in self.getInputCols() if c in df.columns])


def _stats(cols: Sequence[str], mins: Sequence[float], maxs: Sequence[float]) -> dict:
    known = lambda v: None if math.isnan(v) else v
    return {f"{c}__{k}": known(v) for c, lo, hi in zip(cols, mins, maxs, strict=True)
            for k, v in (("min", lo), ("max", hi))}


def _numbers(stats, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    p = scaling.scaler_params(stats)
    side = lambda k: [math.nan if p[f"{c}__{k}"] is None else float(p[f"{c}__{k}"]) for c in cols]
    return side("min"), side("max")


def _named(model: GBTRegressionModel, column: str) -> GBTRegressionModel:
    return model.copy({model.predictionCol: column})


def reading_pipeline(stats, soh_model: GBTRegressionModel, rul_model: GBTRegressionModel,
                     features: Sequence[str] = tuple(S.FEATURES_27), steps: int = S.SEQ_LEN) -> PipelineModel:
    """M7 as one object: raw readings -> request_id, SOH (percent), RUL (cycles), status."""
    features = list(features)
    mins, maxs = _numbers(stats, features)
    (low,), (high,) = _numbers(stats, ["remaining_cycles"])
    return PipelineModel([
        ValidReadings(inputCols=list(S.REQUIRED_READING_FIELDS)),
        ColdStart(inputCols=list(S.CORR_FEATURES)),
        MinMaxScale(inputCols=features, mins=mins, maxs=maxs),
        RepeatedWindow(inputCols=[f"{c}_s" for c in features], outputCol="features", steps=steps),
        Columns(inputCols=["request_id", "features"]),
        _named(soh_model, "_soh"), _named(rul_model, "_rul"),
        Bounded(inputCol="_soh", outputCol="SOH", lower=0.0, upper=1.0, factor=100.0, places=2),
        Bounded(inputCol="_rul", outputCol="RUL", lower=0.0, minimum=low, maximum=high, places=2),
        HealthBand(inputCol="SOH"), Columns(inputCols=["request_id", "SOH", "RUL", "status"])])


def window_pipeline(stats, soh_model: GBTRegressionModel, rul_model: GBTRegressionModel,
                    features: Sequence[str] = tuple(S.FEATURES_30), steps: int = S.SEQ_LEN) -> PipelineModel:
    """M6 as one object: the model frame -> predicted_soh and predicted_rul_cycles of every cycle
    that has ``steps`` before it."""
    features = list(features)
    mins, maxs = _numbers(stats, features)
    (low,), (high,) = _numbers(stats, [S.RUL_TARGET])
    return PipelineModel([
        MinMaxScale(inputCols=features, mins=mins, maxs=maxs),
        CycleWindows(inputCols=[f"{c}_s" for c in features], outputCol="features", steps=steps),
        _named(soh_model, "_soh"), _named(rul_model, "_rul"),
        Bounded(inputCol="_soh", outputCol="predicted_soh", lower=0.0, upper=1.0),
        Bounded(inputCol="_rul", outputCol="predicted_rul_cycles", lower=0.0, minimum=low, maximum=high,
                factorCol="max_cycle"),
        Columns(inputCols=[*S.CYCLE_KEYS, "predicted_soh", "predicted_rul_cycles"])])


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Persist a whole way of scoring as one object."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    """Reload it; nothing else is needed to score."""
    return PipelineModel.load(path)
