"""ST1 on event time: cycle records whose state leaves, late readings to a sink of their own.

Where readings carry the time they were taken, a cycle is a tumbling window of that time and a
watermark tells when it is over.  Spark drops late rows without a trace, so two queries share
the work, each run after the other (``run_event_cycles``; a scheduled job repeats it):

1. ``split_late`` holds every micro-batch against the mark that earlier ones left (the largest
   event time seen, less the allowed delay): a reading whose window had ended by then goes to
   ``late/`` with the reason and the mark, one without an event time too, all others to
   ``in_time/``.  A batch owns one folder per output, named by its id, and takes the mark of the
   batch before it, so a replayed batch decides alike and writes the same rows.
2. ``aggregate_in_time`` is the stateful aggregate with ``withWatermark`` and ``window``: closed
   cycles are appended once, by Spark's own exactly-once file sink, and leave the state, which so
   holds open cycles only.  Its watermark trails that of the first query, so it drops nothing
   (``dropped_rows`` of its progress says so).

The closed cycles equal ``cycles.aggregate_cycles`` over the readings in time.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellhealth import schema as S
from cellhealth.operators import clean, cycles

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def durable_state(spark: SparkSession):
    """Queries started within keep their state in RocksDB and checkpoint only what changed.

    State then lies on executors' disks instead of their heaps; a started query keeps the
    settings it was started with, so the session gets its own back.
    """
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _start(origin: str) -> int:
    return int(datetime.fromisoformat(origin + "+00:00").timestamp())


def window_of(event_time: str, seconds: int, origin: str) -> Column:
    """The tumbling window of an event time; ``origin`` is where one of them starts."""
    return F.window(event_time, f"{seconds} seconds", f"{seconds} seconds",
                    f"{_start(origin) % seconds} seconds")


def window_end(event_time: str, seconds: int, origin: str) -> Column:
    """The end of that window, worked out by hand: ``F.window`` drops rows without a time."""
    t0, width = _start(origin) * 1_000_000, seconds * 1_000_000
    at = F.unix_micros(event_time)
    return F.timestamp_micros(at - F.pmod(at - F.lit(t0), F.lit(width)) + F.lit(width))


def cycle_of(window: str, seconds: int, origin: str) -> Column:
    """Which window since the origin it is, from 0."""
    return ((F.unix_seconds(F.col(window).getField("start")) - F.lit(_start(origin)))
            / F.lit(seconds)).cast("int")


def split_late(stream: DataFrame, out_dir: str, checkpoint: str, delay_seconds: int,
               seconds: int, origin: str, event_time: str = "event_time") -> StreamingQuery:
    """Query 1: each micro-batch's rows to ``in_time/`` or, with the reason, to ``late/``."""
    out = out_dir.rstrip("/")

    def publish(batch: DataFrame, epoch: int) -> None:
        spark, mark = batch.sparkSession, None
        if epoch > 0:
            mark = spark.read.parquet(f"{out}/marks/batch={epoch - 1}").first()["mark"]
        batch = batch.persist()
        try:
            seen = batch.agg(F.max(event_time).alias("mark")).select(
                F.greatest("mark", F.lit(mark).cast("timestamp")).alias("mark"))
            seen.write.mode("overwrite").parquet(f"{out}/marks/batch={epoch}")
            limit = F.lit(mark).cast("timestamp") - F.expr(f"interval {int(delay_seconds)} seconds")
            end = window_end(event_time, seconds, origin)
            reason = (F.when(F.col(event_time).isNull(), F.lit("no event time"))
                       .when(end <= limit, F.lit("late")))
            told = batch.withColumn("reason", reason).withColumn("watermark", limit)
            told.filter("reason is null").drop("reason", "watermark").write.mode(
                "overwrite").parquet(f"{out}/in_time/batch={epoch}")
            told.filter("reason is not null").write.mode("overwrite").parquet(
                f"{out}/late/batch={epoch}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(publish)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/split")
            .trigger(availableNow=True).start())


def closed_cycles(readings: DataFrame, delay_seconds: int, seconds: int, origin: str,
                  event_time: str = "event_time") -> DataFrame:
    """The streaming plan of query 2: clean -> watermark -> window -> the cycle aggregate."""
    rows = clean.with_identity(clean.clean_readings(readings))
    rows = rows.withWatermark(event_time, f"{int(delay_seconds)} seconds")
    per = (rows.groupBy("battery_id", "battery_type", window_of(event_time, seconds, origin).alias("_w"))
               .agg(*cycles.cycle_measures()))
    return per.select("battery_id", "battery_type", cycle_of("_w", seconds, origin).alias("cycle"),
                      *S.CYCLE_MEASURES)


def aggregate_in_time(spark: SparkSession, schema: T.StructType, out_dir: str, checkpoint: str,
                      delay_seconds: int, seconds: int, origin: str,
                      event_time: str = "event_time") -> StreamingQuery:
    """Query 2: closed cycles of ``in_time/`` appended to ``cycles/``."""
    out = out_dir.rstrip("/")
    src = spark.readStream.schema(schema).parquet(f"{out}/in_time")
    plan = closed_cycles(src.select(*schema.names), delay_seconds, seconds, origin, event_time)
    with durable_state(spark):
        return (plan.writeStream.outputMode("append").format("parquet")
                .option("path", f"{out}/cycles")
                .option("checkpointLocation", f"{checkpoint.rstrip('/')}/aggregate")
                .trigger(availableNow=True).start())


def state_rows(query: StreamingQuery) -> list[tuple[int, int]]:
    """(rows in state, rows dropped by the watermark) after each of a query's micro-batches."""
    return [(s["numRowsTotal"], s["numRowsDroppedByWatermark"])
            for p in query.recentProgress for s in p["stateOperators"]]


def run_event_cycles(spark: SparkSession, source: Callable[[], DataFrame], schema: T.StructType,
                     out_dir: str, checkpoint: str, delay_seconds: int, seconds: int, origin: str,
                     event_time: str = "event_time") -> list[tuple[int, int]]:
    """One run over what has arrived since the last: both queries, one after the other.

    ``source`` makes the readings' stream.  Returns ``state_rows`` of the second query; raises
    what either query raises, and an error should Spark have dropped a row given as in time.
    """
    q = split_late(source(), out_dir, checkpoint, delay_seconds, seconds, origin, event_time)
    finish(q)
    q = aggregate_in_time(spark, schema, out_dir, checkpoint, delay_seconds, seconds, origin,
                          event_time)
    finish(q)
    states = state_rows(q)
    if any(dropped for _, dropped in states):
        raise RuntimeError(f"rows in time were dropped by the watermark: {states}")
    return states


def finish(q: StreamingQuery) -> None:
    """Wait for an availableNow query to end; its failure is raised here."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
