"""No automatic switches, plans without needless work, the ETL's identities, splits and streams."""

import math
import os

import pytest
from pyspark.sql import functions as F

from cellhealth import schema as S
from cellhealth.functions.expressions import round6
from cellhealth.operators import cycles, features, metrics, models, scaling, scoring, sequences, split
from cellhealth.operators import segments as seg
from cellhealth.plans import catalog, etl
from cellhealth.sources import readers, sinks
from cellhealth.streaming import cycle_stream
from tests.conftest import SF_MID, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final(spark, n, battery="b", kind="regular"):
    rows = [(battery, kind, c, 4.0 - c / 500, 3.9, 1.0, 20.0 + c % 7, 900.0, n, n - c, 1 - c / n,
             4.0, -0.001 * (c % 5), 20.0, 0.1 * (c % 3), c / n) for c in range(1, n + 1)]
    return spark.createDataFrame(rows, ", ".join(
        f"{c} " + ("string" if c in ("battery_id", "battery_type") else
                   "int" if c in ("cycle", "max_cycle", "RUL") else "double") for c in S.FINAL_COLUMNS))


def test_segment_length_changes_no_bit(spark):
    """Windows see the same rows in the same order, whatever the segment length."""
    df = _final(spark, 300).coalesce(1)
    a = sorted(features.model_frame(df, seg_len=64).collect())
    b = sorted(features.model_frame(df, seg_len=4096).collect())
    assert a == b


def test_building_plans_starts_no_job(spark):
    df, tracker = _final(spark, 30), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans are lazy")
    try:
        fr = features.model_frame(cycles.final_dataset(df.select(
            *S.CYCLE_KEYS, "avg_voltage", "min_voltage", "avg_current", "max_temp", "duration")))
        seqs = sequences.build_sequences(fr, S.FEATURES_30)
        split.with_split(seqs, split.assign_splits(fr))
        cycles.with_rul_soh(df.select(*S.CYCLE_KEYS))
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not hasattr(seg, "group_bound")


def test_plans_without_sort_or_expand(spark):
    sc = spark.createDataFrame([("a", 1, 90.0, 5.0), ("a", 2, 60.0, 4.0), ("b", 1, 75.0, 9.0)],
                               "battery_id string, cycle_index int, soh_pct double, rul_cycles double")
    fleet = scoring.fleet_summary(sc)
    assert sorted((r.status, r.n_batteries, r.mean_rul_cycles) for r in fleet.collect()) == [
        ("Critical", 1, 4.0), ("Degraded", 1, 9.0)]
    assert "SortAggregate" not in _plan(fleet)
    prof = metrics.profile(_final(spark, 5))
    assert "Expand" not in _plan(prof)
    assert prof.first().asDict() == {"n_rows": 5, "n_batteries": 1, "n_types": 1, "types": "regular"}
    assert metrics.profile(_final(spark, 5).limit(0)).first().n_rows == 0


def test_scaler_numbers_are_read_once(spark):
    stats = scaling.fit_scaler(_final(spark, 9), ["duration", "SoH"])
    p = scaling.scaler_params(stats)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scaling", "numbers are literals")
    try:
        scaling.unscale(scaling.scale(_final(spark, 9), p, ["duration", "SoH"]), p, ["SoH"])
        assert list(tracker.getJobIdsForGroup("scaling")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("value", [0.1, 5.0])
def test_correlation_of_a_constant_is_null(spark, value):
    df = spark.createDataFrame([(value, float(i % 3)) for i in range(10)], "a double, b double")
    got = {(r.row_feature, r.col_feature): r.r for r in metrics.correlation(df, ["a", "b"]).collect()}
    assert got["a", "a"] is None and got["a", "b"] is None and got["b", "b"] == pytest.approx(1.0)


def test_round6_keeps_what_it_cannot_round(spark):
    df = spark.createDataFrame([(float("nan"),), (1e15,), (-1e300,), (float("inf"),), (None,),
                                (1.23456789,), (-0.0000004,)], "x double")
    got = [r[0] for r in df.select(round6("x")).collect()]
    assert math.isnan(got[0]) and got[1:5] == [1e15, -1e300, float("inf"), None]
    assert got[5] == 1.234568 and got[6] == 0.0


def test_one_id_in_two_splits_keeps_its_windows(spark):
    frame = features.model_frame(_final(spark, 6).unionByName(_final(spark, 6, "b", "second_life")))
    asg = spark.createDataFrame([("regular", "b", "train"), ("second_life", "b", "test")],
                                "battery_type string, battery_id string, split string")
    seqs = split.with_split(sequences.build_sequences(frame, ["cycle"], seq_len=2), asg)
    for r in seqs.collect():
        seen = [v[0] for v in r.seq]
        assert len(seen) == 2 and all(v <= r.cycle for v in seen)
    per = {r["split"]: r["count"] for r in seqs.groupBy("split").count().collect()}
    assert per == {"train": 10, "test": 10}


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_etl_keeps_readings_without_a_type_folder(spark, tmp_out, fmt):
    """An empty identity is a value: no light format may lose its rows."""
    root = os.path.join(tmp_out, "cells", "regular")
    os.makedirs(root)
    with open(os.path.join(root, "b1.csv"), "w") as fh:
        fh.write("time,mode,voltage_load,current_load,temperature_battery\n")
        for i in range(12):
            fh.write(f"{i * 500},-1,{4 - i / 100},1.0,{20 + i}\n")
    raw = readers.read_telemetry(spark, os.path.join(tmp_out, "cells", "*", "*.csv"))
    res = etl.run_etl(raw, os.path.join(tmp_out, "out", fmt), light_fmt=fmt)
    assert {(r.battery_id, r.battery_type) for r in readers.read_light(
        spark, res.light_path, fmt).collect()} == {("b1", "")}
    fin = readers.read_cycles(spark, res.final_csv_path).collect()
    assert len(fin) == 5 and sorted(fin) == sorted(readers.read_cycles(
        spark, res.final_json_path, "json").collect())
    own = etl.run_etl(raw, os.path.join(tmp_out, "own", fmt), light_fmt=fmt,
                      type_pattern=r"cells/([^/]+)/")
    assert {r.battery_type for r in own.final.collect()} == {"regular"}


def test_csv_tells_empty_from_null(spark, tmp_out):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", None)], "a string, b int")
    sinks.write_csv(df, os.path.join(tmp_out, "c"))
    got = readers.read_csv(spark, os.path.join(tmp_out, "c"), df.schema).collect()
    assert sorted(map(str, got)) == sorted(map(str, df.collect()))


def test_rul_scores_have_a_lower_bound(spark):
    class Below:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(-3.0))

    rd = spark.createDataFrame([("r", 4.0, 3.9, 1.0, 900.0, 0.0, 0.1, 1.0, 0.5)], (
        "request_id string, avg_voltage double, min_voltage double, avg_current double, duration double, "
        "voltage_drop double, temp_change double, cycle double, cycle_rank double"))
    stats = {f"{c}__{k}": v for c in [*S.FEATURES_27, "remaining_cycles"] for k, v in (("min", 0.0), ("max", 10.0))}
    got, _ = scoring.score_readings(rd, stats, Below(), Below())
    row = got.first()
    assert row.SOH == 0.0 and row.RUL == 0.0


def test_cycle_stream_replay_between_batches(spark, tmp_out):
    """A batch that ran but was not committed runs again and changes nothing."""
    src, out, ck = (os.path.join(tmp_out, n) for n in ("src", "out", "ck"))
    rows = [(f"battery_data/regular/b{i % 3}.csv", str(100 * i), "-1", "4.0", "1.0", str(20 + i))
            for i in range(60)]
    schema = "file_path string, time string, mode string, voltage_load string, current_load string, temperature_battery string"
    df = spark.createDataFrame(rows, schema)
    df.repartition(4).write.option("header", True).csv(src)

    def run():
        q = cycle_stream.start_cycle_stream(spark, src, df.schema, out, ck, max_files_per_trigger=1,
                                            path_col="file_path")
        q.awaitTermination()
        return sorted(cycle_stream.read_cycle_stream(spark, out).collect())

    first = run()
    commits = os.path.join(ck, "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.unlink(os.path.join(commits, f))      # killed after writing, before the commit
    assert run() == first
    exp = cycles.aggregate_cycles(cycles.with_cycle(catalog.clean.light(catalog.clean.clean_telemetry(df))))
    assert first == sorted(exp.select(*cycle_stream.read_cycle_stream(spark, out).columns).collect())


def test_early_stop_fires_below_the_ceiling(spark):
    st = catalog.Stages(spark, SF_MID)
    h = [r for r in catalog.q58_history_contract(spark, SF_MID).collect()]
    assert {r.model for r in h} == {"soh", "rul"} and all(r.ended_by_patience for r in h)
    assert models.TreeParams().max_iter >= 50 and st is not None


def test_scan_query_matches_light(spark):
    a = sorted(catalog.q52_scan_identity(spark, SF_SMALL).collect())
    b = sorted(catalog.q02_discharge_light(spark, SF_SMALL).collect())
    assert a == b


def test_entry_without_the_optional_subpackage():
    """The battery queries stay when the training-data modules are gone; other errors are not hidden."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for absent in ("corpus_pipeline", "cellhealth.llm", "xxhash", "ahocorasick"):
        gone = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
                "assert e.LLM == {} and e.LLM_SQL == {}; print(len(e.queries()))")
        out = subprocess.run([sys.executable, "-c", gone], cwd=root, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0 and int(out.stdout) == len(catalog.queries()), absent
    broken = "import sys; sys.modules['pyspark.sql'] = None; import __spark_entry__"
    assert subprocess.run([sys.executable, "-c", broken], cwd=root, capture_output=True, timeout=120).returncode
