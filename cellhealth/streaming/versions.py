"""Tables that a stream writes in versions: one folder per micro-batch, and bases that replace them.

A micro-batch writes the rows it changed to ``version=<batch>`` (overwritten if it runs again).
Readers take the newest complete base and the versions after it, so what they read does not
grow with the number of batches.  ``compact`` writes ``base=<batch>``, the table as of that batch,
from the base before and the versions since - all of them committed when a later batch asks for
it, so a replay finds or writes the same - and deletes what the base before the last already
holds: a reader that has just listed the folder still finds its files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Resolve = Callable[[DataFrame], DataFrame]


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    """The batches of complete folders ``<kind>=<batch>`` under ``root``, rising."""
    fs, p = _folder(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    own = sorted(int(n.partition("=")[2]) for n in names if n.startswith(kind + "="))
    return [n for n in own if fs.exists(_folder(spark, f"{root}/{kind}={n}/_SUCCESS")[1])]


def _write(df: DataFrame, path: str, cluster: str | None) -> None:
    """``cluster``: rows of one value lie together, so that a filter on it skips most row groups."""
    if cluster:
        df = df.repartition(cluster).sortWithinPartitions(cluster)
    df.write.mode("overwrite").parquet(path)


def write_version(df: DataFrame, root: str, batch: int, cluster: str | None = None) -> None:
    """The rows that a micro-batch changed, with its id."""
    _write(df.withColumn("batch", F.lit(batch).cast("long")), f"{root}/version={batch}", cluster)


def rows_of(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """All rows of the newest base and of the versions after it (up to a batch), unresolved."""
    bases = [b for b in _numbers(spark, root, "base") if upto is None or b <= upto]
    base = bases[-1] if bases else None
    paths = [] if base is None else [f"{root}/base={base}"]
    paths += [f"{root}/version={v}" for v in _numbers(spark, root, "version")
              if (base is None or v > base) and (upto is None or v <= upto)]
    if not paths:
        raise FileNotFoundError(f"no version under {root}")
    out = spark.read.parquet(paths[0])
    for p in paths[1:]:
        out = out.unionByName(spark.read.parquet(p))
    return out


def latest_by_key(*keys: str) -> Resolve:
    """Of each key the row of the latest batch."""
    def resolve(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys and c != "batch"]
        return rows.groupBy(*keys).agg(F.max("batch").alias("batch"), *[F.max_by(c, "batch").alias(c) for c in rest])
    return resolve


def latest_of_group(group: str) -> Resolve:
    """Of each group all rows of the latest batch that wrote it."""
    def resolve(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(group).agg(F.max("batch").alias("batch"))
        return rows.join(last, [group, "batch"], "left_semi")
    return resolve


def compact(spark: SparkSession, root: str, upto: int, resolve: Resolve, cluster: str | None = None) -> None:
    """Write the base of batch ``upto`` unless it is there; delete what the base before holds."""
    bases = _numbers(spark, root, "base")
    if upto not in bases and any(v <= upto for v in _numbers(spark, root, "version")):
        _write(resolve(rows_of(spark, root, upto)), f"{root}/base={upto}", cluster)
        bases.append(upto)
    if len(bases) > 1:
        before = sorted(bases)[-2]
        old = [("base", b) for b in bases if b < before]
        old += [("version", v) for v in _numbers(spark, root, "version") if v <= before]
        for kind, n in old:
            fs, p = _folder(spark, f"{root}/{kind}={n}")
            fs.delete(p, True)
