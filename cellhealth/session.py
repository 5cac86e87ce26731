"""Session helpers: local builder for tests/bench and the shared stage folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cellhealth", min_partition_size: str | None = None
                  ) -> SparkSession:
    """Local session for tests and the bench (a cluster session comes from the caller)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g"))
    if min_partition_size:
        # Small inputs: keep several tasks per stage for CPU-bound windows
        # instead of coalescing everything below 1 MB into one task.
        b = b.config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                     min_partition_size)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    Read from the session (``spark.checkpoint.dir`` / ``setCheckpointDir``).
    Only a one-process local session (``local[n]``, as in tests) without one gets
    a fresh temporary folder; any other must name a shared folder itself.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cellhealth-ckpt-"))
    return sc.getCheckpointDir()


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written stage table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cellhealth-stages/{uuid.uuid4().hex}/{name}"


@contextmanager
def held_conf(spark: SparkSession, name: str, value: str):
    """Within this block a session setting has another value."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_stage(df, name: str, fmt: str = "parquet"):
    """Write ``df`` once to the shared folder and read it back (cuts lineage).

    Survives executor loss: the files live on shared storage, not in block
    managers of executors that may disappear.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    out = spark.read.format(fmt).load(path)
    out._stage_path = path
    return out


def drop_stage(df) -> None:
    """Delete a table of ``write_stage`` that no later job reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
