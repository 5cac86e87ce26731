"""Metrics, EOL report and scoring edge cases."""

import math

import pytest

from cellhealth.functions.expressions import health_status
from cellhealth.operators import eol, metrics, scoring


def test_regression_metrics_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double")
    m = metrics.regression_metrics(df, "y", "p").first()
    assert m.rmse == pytest.approx(math.sqrt(0.5 / 3))
    assert m.mae == pytest.approx(1 / 3)
    assert m.r2 == pytest.approx(1 - 0.5 / 2)
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(const, "y", "p").first().r2 == 1.0
    off = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(off, "y", "p").first().r2 == 0.0


def test_huber_plain_and_weighted(spark):
    df = spark.createDataFrame([(0.0, 0.05, 2.0), (0.0, 0.3, 1.0)], "y double, p double, w double")
    plain = metrics.huber_loss(df, "y", "p", 0.1).first().huber_loss
    assert plain == pytest.approx((0.5 * 0.05 ** 2 + 0.1 * (0.3 - 0.05)) / 2)
    wt = metrics.huber_loss(df, "y", "p", 0.1, weight="w").first().huber_loss
    assert wt == pytest.approx((2 * 0.5 * 0.05 ** 2 + 0.1 * (0.3 - 0.05)) / 2)


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0)],
                               "a double, b double, k double")
    r = {(x.row_feature, x.col_feature): x.r for x in metrics.correlation(df, ["a", "b", "k"])
         .collect()}
    assert r[("a", "a")] == pytest.approx(1.0)
    assert r[("a", "b")] == pytest.approx(r[("b", "a")])
    assert r[("a", "k")] is None and r[("k", "k")] is None


def test_best_epoch_ties_smaller(spark):
    h = spark.createDataFrame([("m", 3, 0.5), ("m", 1, 0.7), ("m", 2, 0.5)],
                              "model string, epoch int, val_loss double")
    assert metrics.best_epoch(h).first().best_epoch == 2


def test_eol_nulls(spark):
    rows = [("never", c, c, 0.9, 0.8) for c in range(1, 30)]
    rows += [("zero", c, c, 0.5 if c >= 21 else 0.9, 0.5) for c in range(1, 30)]
    df = spark.createDataFrame(rows, "battery_id string, cycle int, cycle_index int, "
                                     "SoH double, predicted_SoH double")
    rep = {r.battery_id: r for r in eol.eol_report(df).collect()}
    assert rep["never"].actual_eol_cycle is None and rep["never"].error_cycles is None
    assert rep["zero"].actual_eol_cycle == 21 and rep["zero"].error_cycles == 0
    df0 = spark.createDataFrame([("c0", 0, 25, 0.5, 0.6)], "battery_id string, cycle int, "
                                "cycle_index int, SoH double, predicted_SoH double")
    r0 = eol.eol_report(df0).first()
    assert r0.actual_eol_cycle == 0 and r0.error_cycles is None


def test_health_bands(spark):
    df = spark.createDataFrame([(80.0,), (80.01,), (70.0,), (69.99,), (None,)], "x double")
    got = [r.s for r in df.select(health_status("x").alias("s")).collect()]
    assert got == ["Degraded", "Healthy", "Degraded", "Critical", None]


def test_readings_defaults_and_rejects(spark):
    df = spark.createDataFrame(
        [(1, 4.0, 3.9, 1.0, 100.0, -0.01, 0.5, None, None),
         (2, None, 3.9, 1.0, 100.0, -0.01, 0.5, 5.0, 0.2)],
        "request_id long, avg_voltage double, min_voltage double, avg_current double, "
        "duration double, voltage_drop double, temp_change double, cycle double, "
        "cycle_rank double")
    ok, bad = scoring.validate_readings(df)
    assert [r.reason for r in bad.collect()] == ["missing field: avg_voltage"]
    f = scoring.cold_start_features(ok).first()
    assert (f.cycle, f.cycle_rank, f.cumul_voltage_drop) == (1.0, 0.5, -0.01)
    assert f.avg_voltage_mean == 4.0 and f.avg_voltage_std == 0.0
    sq = scoring.cold_start_sequence(scoring.cold_start_features(ok), ["avg_voltage", "cycle"])
    assert sq.first().seq == [[4.0, 1.0]] * 20
