"""Scans by column name, and sinks whose files are one sorted sequence."""

import glob
import os

import pytest
from pyspark.sql import types as T

from cellhealth.sources import readers, sinks

SCHEMA = T.StructType([T.StructField("time", T.DoubleType()), T.StructField("mode", T.IntegerType()),
                       T.StructField("note", T.StringType())])


def put(folder, name, text):
    os.makedirs(os.path.join(folder, os.path.dirname(name)), exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_columns_are_found_by_name_in_each_file(spark, tmp_out):
    put(tmp_out, "a/1.csv", "time,mode,note\n1.5,-1,x\n2.5,bad,\n")
    put(tmp_out, "a/2.csv", "note,extra,mode,time\ny,7,3,4.5\n")
    put(tmp_out, "b/3.csv", '﻿"time", mode\n9,1\n')
    put(tmp_out, "b/4.csv", "")
    got = readers.read_telemetry(spark, tmp_out, recursive=True, schema=SCHEMA)
    rows = sorted((r.time, r.mode, r.note, os.path.basename(r.file_path), r.rejected) for r in got.collect())
    assert rows == [(1.5, -1, "x", "1.csv", []), (2.5, None, None, "1.csv", ["mode: bad"]),
                    (4.5, 3, "y", "2.csv", []), (9.0, 1, None, "3.csv", ["no column note"])]
    only = readers.read_telemetry(spark, f"{tmp_out}/a/1.csv", schema=SCHEMA)
    assert only.count() == 2 and only.columns == ["time", "mode", "note", "file_path", "rejected"]


def test_headers_that_cannot_be_read(spark, tmp_out, monkeypatch):
    put(tmp_out, "one/1.csv", "time,time\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        readers.read_by_name(spark, f"{tmp_out}/one", SCHEMA)
    put(tmp_out, "two/1.csv", "a\n1\n")
    put(tmp_out, "two/2.csv", "b\n1\n")
    monkeypatch.setattr(readers, "MAX_HEADERS", 1)
    with pytest.raises(ValueError, match="different headers"):
        readers.read_by_name(spark, f"{tmp_out}/two", SCHEMA)
    put(tmp_out, "none/1.csv", "")
    assert readers.read_by_name(spark, f"{tmp_out}/none", SCHEMA).collect() == []


def test_sorted_sink_reads_as_one_sequence(spark, tmp_out):
    rows = [(f"b{i * 7 % 5}" if i % 3 else "hot", i * 13 % 997, "t") for i in range(2000)]
    df = spark.createDataFrame(rows, "battery_id string, cycle int, battery_type string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_sorted_csv(df, f"{tmp_out}/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(glob.glob(f"{tmp_out}/out/part-*.csv"))
    lines = [line.split(",") for f in files for line in open(f).read().splitlines()[1:]]
    got = [(b, int(c), t) for b, c, t in lines]
    assert len(files) > 1 and got == sorted(rows)
    hot = [f for f in files if "hot" in open(f).read()]
    assert len(hot) > 1                                      # a battery with a third of the rows is cut by cycle
