"""ST2: continuous scoring of readings; rejected readings to a second sink.

Stateless: every micro-batch goes through ``scoring.score_readings``.  Each
batch owns one folder per output, named by its id and overwritten if the batch
runs again, so a restart from the checkpoint neither loses nor repeats rows.
The scaler's numbers are resolved before the stream starts, and a batch is
held while its two outputs are written, so its files are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellhealth import schema as S
from cellhealth.operators import scaling, scoring


def start_score_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                       scorer_stats: DataFrame, soh_model, rul_model,
                       max_files_per_trigger: int | None = None,
                       available_now: bool = True) -> StreamingQuery:
    r = spark.readStream.schema(S.READING_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.json(source_dir)
    out = out_dir.rstrip("/")
    params = scaling.scaler_params(scorer_stats)

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            scored, rejected = scoring.score_readings(batch, params, soh_model, rul_model)
            scored.write.mode("overwrite").parquet(f"{out}/scored/batch={epoch}")
            rejected.write.mode("overwrite").parquet(f"{out}/rejected/batch={epoch}")
        finally:
            batch.unpersist()

    w = src.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
