"""ST1: incremental per-cycle aggregate over arriving telemetry files, and window features on it.

Stateless cleaning (E1-E7) followed by the stateful cycle aggregate (A1).
``time`` is a plain number, not an event time, so there is no watermark:
state holds one row per (battery, type, cycle) - the per-cycle table, not
the raw readings - in RocksDB, of which a checkpoint holds the changes.  (With an event time:
``event_cycles``, whose state leaves.)  A micro-batch writes only the keys it changed, as a
version (``versions``) that is overwritten if the batch runs again; every ``compact_every``
batches the versions become one base.  ``read_cycle_stream`` always equals the
batch ``aggregate_cycles`` over the files seen.

Lag, ranks, rolling statistics, smoothing and windows (W1-W7) are no streaming windows.  With
``features=True`` each micro-batch works them out anew for the batteries it changed, from
their stored cycles, and for no others: a new cycle moves the last cycle and the size of its
battery, and with them RUL, SoH and rank of all its rows, so a changed battery is replaced
whole.  Rows lie together by ``BUCKETS`` buckets of batteries, and a micro-batch reads those of
changed batteries.  ``read_feature_stream`` equals the batch frame after every
micro-batch; ``touched`` has the batteries and rows that each one worked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cellhealth import schema as S
from cellhealth.operators import clean, cycles
from cellhealth.operators import features as F_
from cellhealth.streaming import versions
from cellhealth.streaming.event_cycles import durable_state

#: Buckets that batteries are dealt over.
BUCKETS = 64
BY_KEY, BY_BATTERY = versions.latest_by_key(*S.CYCLE_KEYS), versions.latest_of_group("battery_id")


def cycle_aggregate_stream(stream: DataFrame) -> DataFrame:
    """The streaming plan: clean -> cycle bucket -> stateful aggregate."""
    return cycles.aggregate_cycles(cycles.with_cycle(clean.light(
        clean.clean_telemetry(stream))))


def bucket_of(battery: str = "battery_id") -> Column:
    return F.pmod(F.xxhash64(battery), F.lit(BUCKETS)).cast("int")


def read_cycle_stream(spark: SparkSession, out_dir: str) -> DataFrame:
    """The per-cycle table so far: the latest version of each changed key."""
    return BY_KEY(versions.rows_of(spark, f"{out_dir.rstrip('/')}/cycles")).drop("batch", "bucket")


def read_feature_stream(spark: SparkSession, out_dir: str) -> DataFrame:
    """The model frame so far: of each battery the rows that were worked out last."""
    return BY_BATTERY(versions.rows_of(spark, f"{out_dir.rstrip('/')}/features")).drop("batch", "bucket")


def touched(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch, batteries, rows): what each micro-batch worked out anew."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/touched")


def _publish_features(spark: SparkSession, out: str, epoch: int) -> None:
    """Features of the batteries that version ``epoch`` of the cycles changed, as version ``epoch``."""
    changed = spark.read.parquet(f"{out}/cycles/version={epoch}").select("battery_id", "bucket").distinct()
    buckets = [r.bucket for r in changed.select("bucket").distinct().collect()]  # at most BUCKETS numbers
    rows = versions.rows_of(spark, f"{out}/cycles", epoch).filter(F.col("bucket").isin(buckets))
    rows = BY_KEY(rows.join(changed.select("battery_id"), "battery_id", "left_semi")).drop("batch", "bucket")
    frame = F_.model_frame(cycles.final_dataset(rows.filter(F.col("cycle").isNotNull())))
    versions.write_version(frame.withColumn("bucket", bucket_of()), f"{out}/features", epoch, "bucket")
    done = spark.read.parquet(f"{out}/features/version={epoch}")
    done.agg(F.count_distinct("battery_id").alias("batteries"), F.count(F.lit(1)).alias("rows")).write.mode(
        "overwrite").parquet(f"{out}/touched/batch={epoch}")


def start_cycle_stream(spark: SparkSession, source_dir: str, schema: StructType,
                       out_dir: str, checkpoint: str, fmt: str = "csv",
                       max_files_per_trigger: int | None = None,
                       path_col: str | None = None, available_now: bool = True,
                       compact_every: int = 20, features: bool = False) -> StreamingQuery:
    """Start ST1 on files under ``source_dir``.

    ``path_col``: column holding the telemetry file path; None takes the
    source file itself (``_metadata.file_path``).
    """
    r = spark.readStream.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.format(fmt).load(source_dir)
    if path_col is None:
        src = src.withColumn("file_path", F.col("_metadata.file_path"))
    elif path_col != "file_path":
        src = src.withColumnRenamed(path_col, "file_path")
    agg = cycle_aggregate_stream(src)

    out = out_dir.rstrip("/")

    def publish(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        # The batch before is committed once this one runs.
        due = epoch > 0 and epoch % compact_every == 0
        if due:
            versions.compact(own, f"{out}/cycles", epoch - 1, BY_KEY, "bucket")
        versions.write_version(batch.withColumn("bucket", bucket_of()), f"{out}/cycles", epoch, "bucket")
        if features:
            if due:
                versions.compact(own, f"{out}/features", epoch - 1, BY_BATTERY, "bucket")
            _publish_features(own, out, epoch)

    w = (agg.writeStream.outputMode("update").foreachBatch(publish)
            .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    with durable_state(spark):
        return w.start()
