"""Event-time cycles: late readings are rejected and counted, state leaves, closed cycles equal the batch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cellhealth.operators import clean, cycles
from cellhealth.plans import catalog
from cellhealth.streaming import event_cycles
from tests.conftest import SF_SMALL

SCHEMA = ("file_path string, time double, mode string, voltage_load double, current_load double, "
          "temperature_battery double, event_time timestamp")
T0 = dt.datetime(2024, 1, 1)


def reading(hour, volts=4.0, battery="b1", mode="-1", timed=True):
    return (f"x/battery_data/regular/{battery}.csv", hour * 100.0, mode, volts, 1.0, 20.0,
            T0 + dt.timedelta(hours=hour) if timed else None)


def land(spark, folder, rows, out, ck):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.createDataFrame([], SCHEMA).schema
    return event_cycles.run_event_cycles(
        spark, lambda: spark.readStream.schema(schema).parquet(folder), schema, out, ck,
        delay_seconds=7200, seconds=36_000, origin="2024-01-01 00:00:00")


def test_late_rows_go_apart_and_state_leaves(spark, tmp_out):
    src, out, ck = (os.path.join(tmp_out, x) for x in ("src", "out", "ck"))
    # Windows of 10 hours, 2 hours of delay.
    a = land(spark, src, [reading(1, 4.0), reading(5, 3.0), reading(9, 2.0, "b2"), reading(3, timed=False)], out, ck)
    assert max(n for n, _ in a) == 2 and spark.read.parquet(f"{out}/cycles").count() == 0
    # 11:30 is past 10:00 but within the delay: the first window is still open for hour 8.
    b = land(spark, src, [reading(11.5, 3.5), reading(8, 1.0)], out, ck)
    assert max(n for n, _ in b) == 3
    c = land(spark, src, [reading(25, 3.3), reading(26, 9.9, mode="1")], out, ck)
    got = {(r.battery_id, r.cycle): r for r in spark.read.parquet(f"{out}/cycles").collect()}
    assert set(got) == {("b1", 0), ("b2", 0), ("b1", 1)} and got["b1", 0].min_voltage == 1.0
    assert c[-1][0] == 1                                     # only the window of hour 25 is held
    d = land(spark, src, [reading(2, 0.5), reading(24, 3.2), reading(70, 3.0)], out, ck)
    late = spark.read.parquet(f"{out}/late").collect()
    assert sorted((r.reason, r.voltage_load) for r in late) == [("late", 0.5), ("no event time", 4.0)]
    assert [r.watermark for r in late if r.reason == "late"] == [T0 + dt.timedelta(hours=24)]
    assert d[-1][0] == 1 and all(dropped == 0 for run in (a, b, c, d) for _, dropped in run)
    rows = spark.read.parquet(f"{out}/cycles").collect()
    assert len(rows) == len({(r.battery_id, r.cycle) for r in rows}) == 4
    assert land(spark, src, [], out, ck) is not None        # a run without new rows changes nothing
    assert spark.read.parquet(f"{out}/cycles").count() == 4


def test_closed_cycles_equal_the_batch_over_rows_in_time(spark):
    out, runs = catalog.event_cycle_runs(spark, SF_SMALL)
    rows = spark.read.parquet(f"{out}/in_time").drop("batch")
    batch = cycles.aggregate_cycles(cycles.with_cycle(clean.light(clean.clean_telemetry(rows.drop("event_time")))))
    got = spark.read.parquet(f"{out}/cycles")
    closed = got.agg(F.max("cycle")).first()[0]
    want = batch.filter(F.col("cycle") <= closed)
    rounded = catalog._rounded
    assert sorted(rounded(got).collect()) == sorted(rounded(want.select(*got.columns)).collect())
    late, whole = spark.read.parquet(f"{out}/late").count(), spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert late > 0 and late + rows.count() == whole
    held = [max(n for n, _ in run) for run in runs if run]
    assert runs[-1][-1][0] < max(held) < batch.count()      # state falls, and never holds every cycle


def test_replayed_batch_decides_alike(spark, tmp_out):
    """A batch lost before its commit runs again with the same mark and rows."""
    src, out, ck = (os.path.join(tmp_out, x) for x in ("src", "out", "ck"))
    land(spark, src, [reading(30)], out, ck)
    land(spark, src, [reading(31), reading(2)], out, ck)
    before = sorted(map(tuple, spark.read.parquet(f"{out}/late").collect()))
    os.remove(os.path.join(ck, "split", "commits", "1"))
    crc = os.path.join(ck, "split", "commits", ".1.crc")
    if os.path.exists(crc):
        os.remove(crc)
    schema = spark.createDataFrame([], SCHEMA).schema
    event_cycles.finish(event_cycles.split_late(
        spark.readStream.schema(schema).parquet(src), out, ck, 7200, 36_000, "2024-01-01 00:00:00"))
    assert sorted(map(tuple, spark.read.parquet(f"{out}/late").collect())) == before and len(before) == 1


@pytest.mark.parametrize("hours,cycle", [(0, 0), (9.99, 0), (10, 1), (-0.5, -1)])
def test_windows_start_at_the_origin(spark, hours, cycle):
    df = spark.createDataFrame([reading(hours)], SCHEMA)
    w = event_cycles.window_of("event_time", 36_000, "2024-01-01 00:00:00")
    got = df.select(w.alias("w"), event_cycles.window_end("event_time", 36_000, "2024-01-01 00:00:00").alias("end"))
    row = got.select(event_cycles.cycle_of("w", 36_000, "2024-01-01 00:00:00").alias("c"), "end", "w.end").first()
    assert row[0] == cycle and row[1] == row[2]
