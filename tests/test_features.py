"""Model-frame features: segment sizes do not change results; smoothing equals
least-squares polynomial fits; short batteries keep SoH."""

import numpy as np
import pytest

from cellhealth import schema as S
from cellhealth.operators import features

FINAL = ("battery_id string, battery_type string, cycle int, avg_voltage double, "
         "min_voltage double, avg_current double, max_temp double, duration double, "
         "max_cycle int, RUL int, SoH double, prev_voltage double, voltage_drop double, "
         "prev_temp double, temp_change double, cycle_ratio double")


def _final(spark, sizes, soh=None):
    rows = []
    for b, n in enumerate(sizes):
        m = n + 1
        for c in range(1, n + 1):
            s = float(soh(c, n)) if soh else 1 - c / m
            v = 4.0 - 0.01 * c + 0.003 * ((c * 7) % 5)
            rows.append((f"b{b}", "regular", c, v, v - 0.1, 1.0 + (c % 3) / 10, 20.0 + c % 4,
                         900.0 - c, m, m - c, s, v + 0.01, -0.01 + 0.001 * (c % 4), 20.0, 0.5,
                         c / m))
    return spark.createDataFrame(rows, FINAL)


def _savgol_ref(v):
    n, out = len(v), []
    for i in range(n):
        c = min(max(i, 5), n - 6)
        coef = np.polyfit(np.arange(-5, 6), v[c - 5:c + 6], 2)
        out.append(np.polyval(coef, i - c))
    return np.clip(out, 0, 1)


def test_savgol_matches_polyfit_and_short_batteries(spark):
    rnd = np.random.default_rng(3)
    noise = rnd.normal(0, 0.02, 200)
    df = _final(spark, [10, 11, 12, 37], soh=lambda c, n: 1 - c / (n + 1) + noise[c])
    got = features.model_frame(df, seg_len=12, block_width=5).select(
        "battery_id", "cycle", "SoH", "SoH_smoothed").collect()
    by = {}
    for r in got:
        by.setdefault(r.battery_id, []).append(r)
    for b, rows in by.items():
        rows.sort(key=lambda r: r.cycle)
        raw = np.array([r.SoH for r in rows])
        sm = np.array([r.SoH_smoothed for r in rows])
        if len(rows) < 11:
            assert np.array_equal(raw, sm)          # unchanged and unclipped
        else:
            assert np.allclose(sm, _savgol_ref(raw), atol=1e-12)


def test_savgol_reproduces_quadratics(spark):
    df = _final(spark, [25], soh=lambda c, n: 0.9 - 0.001 * c - 0.0004 * c * c)
    got = features.model_frame(df).select("SoH", "SoH_smoothed").collect()
    for r in got:
        assert r.SoH_smoothed == pytest.approx(min(max(r.SoH, 0), 1), abs=1e-12)


def test_segment_size_does_not_change_features(spark):
    df = _final(spark, [3, 15, 40, 90])
    cols = ["battery_id", "cycle", "cycle_index", "n_cycles", "cumul_voltage_drop",
            "cycle_rank", "SoH_smoothed"] + [c for c in S.FEATURES_30 if c.endswith(("_mean",
                                                                                      "_std"))]
    small = features.model_frame(df, block_width=4, seg_len=11).select(*cols)
    big = features.model_frame(df, bounded=False).select(*cols)
    plain = features.model_frame(df, bounded=True).select(*cols)
    measured = features.model_frame(df).select(*cols)
    norm = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                               for r in rows)
    ref = norm(small.collect())
    assert ref == norm(big.collect()) == norm(plain.collect()) == norm(measured.collect())


def test_rolling_matches_pandas(spark):
    import pandas as pd
    df = _final(spark, [30])
    got = features.model_frame(df).orderBy("cycle").toPandas()
    for f in ["avg_voltage", "duration", "voltage_drop"]:
        exp_m = got[f].rolling(10, min_periods=1).mean()
        exp_s = got[f].rolling(10, min_periods=1).std().fillna(0)
        assert np.allclose(got[f"{f}_mean"], exp_m, atol=1e-9)
        assert np.allclose(got[f"{f}_std"], exp_s, atol=1e-9)
    assert got["cycle_rank"].max() == 1.0
    cum = got["voltage_drop"].cumsum()
    assert np.allclose(got["cumul_voltage_drop"], cum, atol=1e-12)
    assert isinstance(pd.__version__, str)


def test_hot_battery_default_settings(spark):
    """One battery of 9000 cycles (three 4096-row segments) among short ones:
    the measured path is the segmented kernel and equals plain windows."""
    from cellhealth.operators import segments as seg
    from cellhealth.operators import sequences
    df = _final(spark, [9000, 12, 30])
    cols = ["battery_id", "cycle", "cycle_index", "n_cycles", "cumul_voltage_drop",
            "cycle_rank", "SoH_smoothed", "avg_voltage_mean", "avg_voltage_std"]
    seg_rows = features.model_frame(df).select(*cols)
    plain_rows = features.model_frame(df, bounded=True).select(*cols)
    norm = lambda rows: sorted(tuple(round(x, 7) if isinstance(x, float) else x for x in r)
                               for r in rows)
    assert norm(seg_rows.collect()) == norm(plain_rows.collect())
    frame = features.model_frame(df)
    a = sequences.build_sequences(frame, ["cycle_rank", "duration"]).filter(
        "battery_id = 'b0' AND cycle_index BETWEEN 4090 AND 4120")
    b = sequences.build_sequences(frame, ["cycle_rank", "duration"], bounded=True).filter(
        "battery_id = 'b0' AND cycle_index BETWEEN 4090 AND 4120")
    assert sorted((r.cycle, r.seq) for r in a.collect()) == sorted(
        (r.cycle, r.seq) for r in b.collect())
