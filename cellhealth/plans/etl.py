"""The telemetry ETL job as one plan.

raw CSV -> identity, coercion, discharge filter, incomplete rows dropped ->
light dataset (sink 1) -> per-cycle aggregate -> labels and lag features ->
final dataset (CSV sink and JSON-lines sink).

The raw telemetry is scanned once: the cleaned readings are written to the
shared stage folder as Parquet, with their file path; the light sink parses
the identity in its own projection, the aggregate once per file and cycle.
The per-cycle and final tables are written once too and both final sinks read
that.  Stages that nothing reads any more are deleted.  Row counts at the three checkpoints of the
reference are observed during those writes instead of extra count jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cellhealth import schema as S
from cellhealth.functions.expressions import BATTERY_ID_PATTERN, BATTERY_TYPE_PATTERN
from cellhealth.operators import clean, cycles
from cellhealth.session import drop_stage, write_stage
from cellhealth.sources import readers, sinks


@dataclass
class EtlResult:
    light_path: str
    final_csv_path: str
    final_json_path: str
    final: DataFrame
    counts: dict = field(default_factory=dict)


def run_etl(raw: DataFrame, out_dir: str, subset: list[str] | None = None,
            light_fmt: str = "csv", parquet_copy: bool = False,
            id_pattern: str = BATTERY_ID_PATTERN,
            type_pattern: str = BATTERY_TYPE_PATTERN) -> EtlResult:
    """Run the ETL on raw telemetry rows (``file_path`` + raw columns).

    ``parquet_copy`` also writes ``final_parquet/`` partitioned by
    battery_type, so readers filtering on a type prune whole folders.
    ``id_pattern`` / ``type_pattern`` parse the identity from the file path.
    """
    patterns = {"id_pattern": id_pattern, "type_pattern": type_pattern}
    out = out_dir.rstrip("/")
    raw_o, n_loaded = sinks.observed(raw, "loaded")
    discharged, n_discharge = sinks.observed(
        clean.discharge_only(clean.coerce_numeric(raw_o)), "discharge")
    kept = [c for c in S.LIGHT_COLUMNS if c not in ("battery_id", "battery_type")]
    readings = write_stage(clean.drop_incomplete(discharged, subset)
                           .select("file_path", *kept), "readings")
    light = clean.light(clean.with_identity(readings, **patterns))
    light_path = f"{out}/light"
    if light_fmt == "csv":
        sinks.write_csv(light, light_path)
    else:
        light.write.mode("overwrite").format(light_fmt).save(light_path)

    agg, n_agg = sinks.observed(cycles.aggregate_cycles_by_file(readings, **patterns),
                                "aggregated")
    cyc = write_stage(agg, "cycles")
    drop_stage(readings)
    final = write_stage(cycles.final_dataset(cyc), "final")
    drop_stage(cyc)
    csv_path, json_path = f"{out}/final_csv", f"{out}/final_json"
    sinks.write_csv(final, csv_path)
    sinks.write_json(final, json_path)
    if parquet_copy:
        sinks.write_parquet(final, f"{out}/final_parquet", partition_by=["battery_type"])
    counts = {"loaded": n_loaded.get["rows"], "after_discharge_filter": n_discharge.get["rows"],
              "aggregated": n_agg.get["rows"]}
    return EtlResult(light_path, csv_path, json_path, final, counts)


def main(argv: list[str] | None = None) -> None:
    """``python -m cellhealth.plans.etl <csv glob> <out dir> [--infer] [--light-format F]``"""
    import argparse
    import json

    from pyspark.sql import SparkSession

    ap = argparse.ArgumentParser(description="telemetry CSV -> light + final datasets")
    ap.add_argument("source", help="CSV glob, e.g. hdfs:///battery_data/*/*.csv")
    ap.add_argument("out", help="output folder (light/, final_csv/, final_json/)")
    ap.add_argument("--infer", action="store_true", help="infer column types while reading")
    ap.add_argument("--light-format", default="csv", choices=["csv", "parquet", "json"])
    ap.add_argument("--parquet", action="store_true",
                    help="also write final_parquet/ partitioned by battery_type")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cellhealth-etl").getOrCreate()
    res = run_etl(readers.read_telemetry(spark, a.source, infer=a.infer), a.out,
                  light_fmt=a.light_format, parquet_copy=a.parquet)
    print(json.dumps(res.counts))


if __name__ == "__main__":
    main()
