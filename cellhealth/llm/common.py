"""Helpers that the operators of this subpackage share.

Stage tables cut lineage: a written table in the folder that the session names in
``spark.checkpoint.dir`` outlives any executor.  ``drop_stage`` deletes one that its
writer has finished with.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhealth.session import stage_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = 8 << 20
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(df: DataFrame, *names: str) -> None:
    """A clear error for a missing or doubled column; small Arrow batches for its session.

    Texts pass through Python, and a task holds a few batches at a time: unless the session
    sets its own bound, a batch has BATCH_BYTES at most (one row at least).
    """
    for name in names:
        if df.columns.count(name) != 1:
            raise ValueError(f"exactly one column {name!r} is needed; found {df.columns}")
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":  # Spark's default
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def numbered_columns(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ...: no name of its own can clash with a helper column."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def raw_text(column: str = "text") -> Column:
    """The whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def write_stage(df: DataFrame, name: str, codec: str = "zstd", batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The files of its shuffles go as soon as the table is written: nothing reads them again.
    ``batch_rows``: rows of an Arrow batch on the way, where rows are large.
    """
    spark, path = df.sparkSession, stage_path(df.sparkSession, f"llm-{name}")
    wanted = {CLEANUP: "true"} | ({BATCH: str(batch_rows)} if batch_rows else {})
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_stage = path
    return out


def reread(df: DataFrame) -> DataFrame:
    """Another frame over a table of ``write_stage``, so that both sides of a join differ."""
    out = df.sparkSession.read.schema(df.schema).parquet(df._llm_stage)
    out._llm_stage = df._llm_stage
    return out


def drop_stage(*frames: DataFrame) -> None:
    """Delete tables of ``write_stage`` that no later job reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._llm_stage)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def blocks(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[tuple[dict, list[bytes]]]:
    """Arrow batches cut or joined to blocks of about ``max_bytes`` of text (one row at least).

    Yields the other columns as Arrow arrays and the texts as bytes.
    """
    held: list[pa.RecordBatch] = []
    size = 0

    def block() -> tuple[dict, list[bytes]]:
        rest = {c: pa.concat_arrays([h.column(c) for h in held]) for c in held[0].schema.names if c != text}
        return rest, [x for h in held for x in h.column(text).to_pylist()]

    for batch in batches:
        start = 0
        for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            if size and size + n > max_bytes:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield block()
                held, size, start = [], 0, i
            size += max(1, n)
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield block()


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, row_id: str,
                hot: int = 1000) -> DataFrame:
    """``rows`` left joined to ``groups`` (one row a key) so that no task gets a whole hot key.

    A key is hot when more than 1/``hot`` of all rows carry it, so there are at most
    ``hot`` such groups whatever the input: these are broadcast.  The other keys meet in a
    shuffle join, to which the rows that have found their group come under keys of their
    own.  ``groups`` must be a written table; ``size`` counts its rows.  Both may share no
    other column name.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    others = [c for c in groups.columns if c != key]
    big = groups.filter(F.col(size) * hot > total)
    small = groups.filter(F.col(size) * hot <= total)
    big = F.broadcast(big.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_b_{c}") for c in others]))
    out = rows.join(big, F.col(key).eqNullSafe(F.col("_k")), "left")
    found = F.col(f"_b_{size}").isNotNull()
    # A row that has its group already joins on (null key, own salt): spread and without a match.
    out = out.withColumn("_salt", F.when(found, F.xxhash64(row_id).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long")))
    small = small.select(F.col(key).alias("_j"), F.lit(0).cast("long").alias("_z"),
                         *[F.col(c).alias(f"_s_{c}") for c in others])
    out = out.join(small, (F.col(key) == F.col("_j")) & (F.col("_salt") == F.col("_z")), "left")
    return out.select(*[F.col(c) for c in rows.columns],
                      *[F.coalesce(f"_b_{c}", f"_s_{c}").alias(c) for c in others])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of undirected ``links``; component: its smallest node.

    Smallest-label propagation with pointer jumping over Spark joins.  Each round is
    written to the shared folder, so a lost executor costs a task and not the lineage.
    Only the number of changed labels comes to the driver.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = write_stage(both.union(both.select("v", "u")).filter("u <> v").distinct(), "links")
    labels = write_stage(both.groupBy(F.col("u").alias("node"))
                         .agg(F.least(F.col("node"), F.min("v")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both.v == labels.node).groupBy("u")
                .agg(F.min("component").alias("near")))
        step = (labels.join(near, labels.node == near.u, "left")
                .select("node", F.col("component").alias("old"),
                        F.least("component", F.coalesce("near", "component")).alias("mid")))
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("top"))
        step = (step.join(up, step.mid == up.up, "left")
                .select("node", "old", F.least("mid", F.coalesce("top", "mid")).alias("component")))
        step = write_stage(step, "labels")
        changed = step.filter("component <> old").limit(1).count()
        drop_stage(labels)
        labels = step.select("node", "component")
        labels._llm_stage = step._llm_stage
        if not changed:
            drop_stage(both)
            return labels
