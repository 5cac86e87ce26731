"""Window features on the cycle stream, and versions that become bases."""

import os

from pyspark.sql import functions as F

from cellhealth.operators import clean, cycles, features
from cellhealth.plans import catalog
from cellhealth.streaming import cycle_stream, versions

SCHEMA = "file_path string, time string, mode string, voltage_load string, current_load string, temperature_battery string"


def readings(battery, hours):
    return [(f"battery_data/regular/{battery}.csv", str(1000.0 * h + 10 * k), "-1", str(4.0 - h / 100 + k / 50), "1.0",
             str(20 + h % 7)) for h in hours for k in range(2)]


def land(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(src)


def run(spark, src, out, ck, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    catalog._finish(cycle_stream.start_cycle_stream(spark, src, schema, out, ck, max_files_per_trigger=1,
                                                    path_col="file_path", **more))


def batch_frame(spark, src):
    raw = spark.read.schema(spark.createDataFrame([], SCHEMA).schema).option("header", True).csv(src)
    per = cycles.aggregate_cycles(cycles.with_cycle(clean.light(clean.clean_telemetry(raw))))
    return features.model_frame(cycles.final_dataset(per))


def rows_of(df, columns):
    return sorted(catalog._rounded(df.select(*columns)).collect())


def test_features_equal_the_batch_frame_after_every_batch(spark, tmp_out):
    src, out, ck = (os.path.join(tmp_out, n) for n in ("src", "out", "ck"))
    landings = [readings("a", range(1, 15)) + readings("b", range(1, 13)) + readings("c", [3]),
                readings("a", range(15, 30)), readings("b", [5, 20]) + readings("d", range(0, 25))]
    for k, rows in enumerate(landings):
        land(spark, src, rows)
        run(spark, src, out, ck, features=True, compact_every=2)
        want = batch_frame(spark, src)
        assert rows_of(cycle_stream.read_feature_stream(spark, out), want.columns) == rows_of(want, want.columns)
    got = {r.batch: (r.batteries, r.rows) for r in cycle_stream.touched(spark, out).collect()}
    per = {r.battery_id: r.n for r in want.groupBy("battery_id").agg(F.count("*").alias("n")).collect()}
    # The second batch touched battery a alone, the third b and d: no row of another battery.
    assert got[1] == (1, per["a"]) and got[2] == (2, per["b"] + per["d"]) and set(got) == {0, 1, 2}
    assert "c" not in per                                    # one cycle has no row before it


def test_versions_become_bases_and_reads_stay_small(spark, tmp_out):
    src, out, ck = (os.path.join(tmp_out, n) for n in ("src", "out", "ck"))
    for k in range(9):
        land(spark, src, readings("a", range(k, k + 3)) + readings(f"b{k}", [1, 2]))
        run(spark, src, out, ck, compact_every=2)
        folders = [f for f in os.listdir(os.path.join(out, "cycles")) if not f.startswith(".")]
        assert len(folders) <= 6                             # two bases and what came since the older one
    got = cycle_stream.read_cycle_stream(spark, out)
    raw = spark.read.schema(spark.createDataFrame([], SCHEMA).schema).option("header", True).csv(src)
    want = cycles.aggregate_cycles(cycles.with_cycle(clean.light(clean.clean_telemetry(raw))))
    first = rows_of(got, want.columns)
    assert first == rows_of(want, want.columns) and len(first) == 11 + 18
    # The last batch (8, which compacts) was killed before its commit: it runs again, across the base.
    for f in ("8", ".8.crc"):
        if os.path.exists(os.path.join(ck, "commits", f)):
            os.unlink(os.path.join(ck, "commits", f))
    run(spark, src, out, ck, compact_every=2)
    assert rows_of(cycle_stream.read_cycle_stream(spark, out), want.columns) == first


def test_an_incomplete_base_is_not_read(spark, tmp_out):
    root = os.path.join(tmp_out, "t")
    df = spark.createDataFrame([("k", 1)], "battery_id string, v int")
    versions.write_version(df, root, 0)
    versions.write_version(df.withColumn("v", F.lit(2)), root, 1)
    os.makedirs(os.path.join(root, "base=1"))                # a writer died: no _SUCCESS
    got = versions.latest_by_key("battery_id")(versions.rows_of(spark, root))
    assert [(r.battery_id, r.v) for r in got.collect()] == [("k", 2)]
    versions.compact(spark, root, 1, versions.latest_by_key("battery_id"))
    assert versions.rows_of(spark, root).collect()[0].v == 2
