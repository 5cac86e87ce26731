"""Cleaning, cycle bucketing, labels: hand-made edge rows (FIXTURES.md section 4)."""

import math

from pyspark.sql import functions as F

from cellhealth.operators import clean, cycles

RAW = "file_path string, time string, mode string, voltage_load string, " \
      "current_load string, temperature_battery string"
P = "hdfs://x/battery_data/regular/b1.csv"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_mode_filter_and_coercion(spark):
    rows = [(P, "1", "x", "4", "1", "20"), (P, "2", None, "4", "1", "20"),
            (P, "3", "-1", "4", "1", "20"), (P, "4", "-1.0", "4", "1", "20")]
    out = clean.clean_telemetry(_raw(spark, rows)).select("time").collect()
    assert sorted(r.time for r in out) == [3.0, 4.0]


def test_dropna_all_columns_and_subset(spark):
    df = spark.createDataFrame(
        [(P, 1.0, -1.0, 4.0, 1.0, 20.0, float("nan")),
         (P, 2.0, -1.0, 4.0, 1.0, 20.0, None),
         (P, 3.0, -1.0, 4.0, 1.0, 20.0, 7.0)],
        "file_path string, time double, mode double, voltage_load double, "
        "current_load double, temperature_battery double, extra double")
    assert clean.clean_telemetry(df).count() == 1
    assert clean.clean_telemetry(df, subset=["time", "voltage_load"]).count() == 3


def test_identity_from_path(spark):
    df = spark.createDataFrame([("hdfs://h/battery_data/second_life/battery07.csv",),
                                ("/no/layout/here.txt",)], "file_path string")
    rows = {r.file_path: r for r in clean.with_identity(df).collect()}
    good = rows["hdfs://h/battery_data/second_life/battery07.csv"]
    assert (good.battery_id, good.battery_type) == ("battery07", "second_life")
    bad = rows["/no/layout/here.txt"]
    assert (bad.battery_id, bad.battery_type) == ("", "")


def test_cycle_bucket_truncates_and_guards_overflow(spark):
    df = spark.createDataFrame([(-500.0,), (0.0,), (999.9,), (1000.0,), (1e15,)], "time double")
    got = [r.cycle for r in cycles.with_cycle(df).orderBy("time").collect()]
    assert got == [0, 0, 0, 1, None]


def _cycles(spark, rows):
    return spark.createDataFrame(
        rows, "battery_id string, battery_type string, cycle int, avg_voltage double, "
              "min_voltage double, avg_current double, max_temp double, duration double")


def test_rul_soh_forms_agree_and_zero_max_cycle(spark):
    rows = [("a", "regular", c, 4.0 - c / 100, 3.9, 1.0, 20.0 + c, 10.0) for c in range(6)]
    rows += [("z", "regular", 0, 4.0, 3.9, 1.0, 20.0, 1.0)]          # max_cycle 0
    rows += [("d", "regular", 1, 4.0, 3.9, 1.0, 20.0, 1.0),          # same id, two types
             ("d", "recommissioned", 3, 4.0, 3.9, 1.0, 20.0, 1.0)]
    c = _cycles(spark, rows)
    cols = ["battery_id", "battery_type", "cycle", "max_cycle", "RUL", "SoH"]
    a = sorted(cycles.with_rul_soh(c, block_width=2, bounded=False).select(*cols).collect())
    assert a == sorted(cycles.with_rul_soh(c, bounded=True).select(*cols).collect())
    b = sorted(cycles.with_rul_soh_join(c).select(*cols).collect())
    w = sorted(cycles.with_rul_soh_window(c).select(*cols).collect())
    assert a == b == w
    z = [r for r in a if r.battery_id == "z"][0]
    assert z.SoH is None and z.max_cycle == 0
    assert {r.max_cycle for r in a if r.battery_id == "d"} == {3}
    fin = cycles.final_dataset(c).collect()
    assert not [r for r in fin if r.battery_id == "z"]   # dropped, no division error
    assert sorted(r.cycle for r in fin if r.battery_id == "a") == [1, 2, 3, 4, 5]


def test_final_dataset_lag_matches_plain_window(spark):
    from pyspark.sql import Window
    rows = [(f"b{b}", "regular", cyc, 4.0 - cyc * 0.01 * (b + 1), 3.9, 1.0,
             20.0 + (cyc * 7 % 5), 5.0) for b in range(4) for cyc in range(0, 40, 1 + b)]
    c = _cycles(spark, rows)
    got = cycles.final_dataset(c, block_width=3, seg_len=4)
    plain = cycles.final_dataset(c, bounded=True)
    assert sorted(got.collect()) == sorted(plain.collect())
    w = Window.partitionBy("battery_id").orderBy("cycle", "battery_type")
    ref = (c.withColumn("prev_voltage", F.lag("avg_voltage").over(w))
             .withColumn("prev_temp", F.lag("max_temp").over(w))
             .dropna(subset=["prev_voltage"]))
    g = {(r.battery_id, r.cycle): (r.prev_voltage, r.prev_temp) for r in got.collect()}
    e = {(r.battery_id, r.cycle): (r.prev_voltage, r.prev_temp) for r in ref.collect()}
    assert g == e


def test_soh_rul_identities(spark):
    from tests.conftest import SF_SMALL
    from cellhealth.plans.catalog import Stages
    f = Stages(spark, SF_SMALL).final
    from cellhealth.operators import features
    t = features.with_targets(f).collect()
    assert t
    for r in t:
        assert r.RUL >= 0
        assert math.isclose(r.rul_ratio, r.SoH, abs_tol=1e-12)
        assert r.min_voltage <= r.avg_voltage + 1e-12
        assert r.cycle >= 1 and 0 <= r.duration < 1000


def test_telescoping_and_rul_zero_at_end(spark):
    from tests.conftest import SF_MID
    from cellhealth.plans.catalog import Stages
    ff = Stages(spark, SF_MID).features
    last = ff.groupBy("battery_id").agg(
        F.max_by(F.struct("cumul_voltage_drop", "avg_voltage", "RUL"), "cycle_index").alias("l"),
        F.min_by("prev_voltage", "cycle_index").alias("first_prev")).collect()
    assert last
    for r in last:
        assert math.isclose(r.l.cumul_voltage_drop, r.l.avg_voltage - r.first_prev, abs_tol=1e-9)
        assert r.l.RUL == 0
