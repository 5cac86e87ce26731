"""Writers (S3-S5, S7-S11, S13).

Every sink is a DataFrame writer; nothing passes through the driver.  Only
the one-row metrics record is coalesced to one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellhealth.sources.readers import CSV_NULL

#: Tasks a core that folders are dealt over.
FOLDER_TASKS = 4


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; a null is ``\\N``, so an empty string stays one."""
    df.write.mode(mode).option("header", True).option("nullValue", CSV_NULL).csv(path)


def write_sorted_csv(df: DataFrame, path: str, keys: Sequence[str] = ("battery_id", "cycle", "battery_type"),
                     mode: str = "overwrite") -> None:
    """O1 at a sink: files that in name order read as one sequence sorted by ``keys``.

    Rows are dealt by ranges of the keys and sorted within each: no single task sorts all
    rows, and a battery that holds many of them is cut by cycle.
    """
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
       .write.mode(mode).option("header", True).option("nullValue", CSV_NULL).csv(path))


def write_csv_tree(df: DataFrame, path: str, folders: list[str], mode: str = "overwrite") -> None:
    """CSV with header in one folder per value of ``folders`` (``name=value``).

    Rows of a folder are written by one task, as a stream: there are as many files as folders, not
    as many as folders times tasks.  A folder costs the same whatever it holds, so the number of tasks
    follows the cores, a few each, and not the bytes.
    """
    tasks = FOLDER_TASKS * df.sparkSession.sparkContext.defaultParallelism
    (df.repartition(tasks, *folders).write.mode(mode).option("header", True).option("nullValue", CSV_NULL)
       .partitionBy(*folders).csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (document-store export)."""
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet between stages; ``partition_by`` enables partition pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_record(df: DataFrame, path: str) -> None:
    """A one-row summary record as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_scaler(stats: DataFrame, path: str) -> None:
    """Fitted scaler statistics."""
    stats.coalesce(1).write.mode("overwrite").parquet(path)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count collected while the DataFrame is computed by a later
    action (no extra job).  Read with ``obs.get["rows"]`` after that action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
