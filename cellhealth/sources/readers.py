"""Readers (S1, S2, S6, S11 load).

Raw telemetry lives in ``battery_data/<type>/<battery_id>.csv`` files with a
header.  Columns are read as strings (names from the header, no inference
pass) and coerced by ``clean.coerce_numeric``; the file path comes from the
hidden ``_metadata`` column, so the battery identity is known per row.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellhealth import schema as S

#: Different headers of one dataset's files.
MAX_HEADERS = 64


def read_telemetry(spark: SparkSession, path: str, infer: bool = False,
                   recursive: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """S1 + S2: CSV glob with header; adds ``file_path``.

    ``infer=True`` reproduces header + type inference (an extra full pass);
    the default keeps every column a string so any text is tolerated.  Both take the names
    of one file's header for all files.  ``schema``: columns are found by *name* in each file
    (``read_by_name``).
    """
    if schema is not None:
        return read_by_name(spark, path, schema, recursive)
    r = spark.read.option("header", True).option("inferSchema", bool(infer))
    if recursive:
        r = r.option("recursiveFileLookup", True)
    with few_listing_tasks(spark):
        df = r.csv(path)
    return with_file_path(df)


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Folders are listed by a few tasks a core with many folders each (Spark's own way is one task
    a folder, whose start costs more than the listing)."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def headers(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(file_path, header): the first line of every file, in one pass over the lines (no parsing).

    Quoted line breaks in a header are not supported.  An empty file has no row.
    """
    r = spark.read.option("recursiveFileLookup", recursive)
    lines = r.text(path).select(F.col("_metadata.file_path").alias("file_path"),
                                F.col("_metadata.file_block_start").alias("_at"), "value")
    # The block that starts a file holds its header as its first line.
    first = lines.filter(F.col("_at") == 0).withColumn("_line", F.monotonically_increasing_id())
    return first.groupBy("file_path").agg(F.min_by("value", "_line").alias("header")).select(
        "file_path", F.regexp_replace("header", "^\ufeff", "").alias("header"))


def read_by_name(spark: SparkSession, path: str, schema: T.StructType,
                 recursive: bool = False) -> DataFrame:
    """S1 with a given schema: every file's columns by the names of its own header.

    Files are grouped by header; a group is scanned in its own column order and brought to
    ``schema`` by name, so files of different layouts give the same columns.  Further columns
    are left out.  ``rejected`` (an array of strings, empty for a good row) names what a row
    lacks: a text that is no value of its column's type (null there), or a column that the
    file does not have.  Headers are few: at most ``MAX_HEADERS`` different ones, else an error.
    """
    told = headers(spark, path, recursive)
    found = sorted(r.header for r in told.select("header").distinct().limit(MAX_HEADERS + 1).collect())
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers under {path}: not one dataset")
    out = None
    for header in found:
        names = spark.range(1).select(F.from_csv(
            F.lit(header), ", ".join(f"c{i} string" for i in range(header.count(",") + 1))).alias("h")).first().h
        names = [n.strip() for n in names if n is not None]
        own = T.StructType([T.StructField(n or f"_c{i}", T.StringType()) for i, n in enumerate(names)])
        if len(set(own.names)) < len(own.names):
            raise ValueError(f"a name occurs twice in the header {header!r} of files under {path}")
        # One layout: the path as it is; else its files, whose names the driver lists anyway.
        files = path if len(found) == 1 else [
            r.file_path for r in told.filter(F.col("header") == header).select("file_path").collect()]
        rows = with_file_path(spark.read.schema(own).option("header", True)
                              .option("recursiveFileLookup", recursive).csv(files))
        wrong, cols = [], []
        for f in schema.fields:
            if f.name not in own.names:
                wrong.append(F.lit(f"no column {f.name}"))
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            value = F.col(f"`{f.name}`").try_cast(f.dataType)
            wrong.append(F.when(F.col(f"`{f.name}`").isNotNull() & value.isNull(),
                                F.concat(F.lit(f"{f.name}: "), F.col(f"`{f.name}`"))))
            cols.append(value.alias(f.name))
        rows = rows.select(*cols, "file_path", F.array_compact(F.array(*wrong)).cast("array<string>").alias("rejected"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        empty = T.StructType([*schema.fields, T.StructField("file_path", T.StringType()),
                              T.StructField("rejected", T.ArrayType(T.StringType()))])
        return spark.createDataFrame([], empty)
    return out


def with_file_path(df: DataFrame) -> DataFrame:
    """The source file of every row (``_metadata.file_path``)."""
    return df.withColumn("file_path", F.col("_metadata.file_path"))


# Fixed value: how the package's own CSV files write a null, so that "" stays "".
CSV_NULL = "\\N"


def read_light(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read the light dataset back with its fixed schema."""
    r = spark.read.schema(S.LIGHT_SCHEMA)
    return _csv(r, path) if fmt == "csv" else r.format(fmt).load(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Any of the package's CSV outputs with a given schema."""
    return _csv(spark.read.schema(schema), path)


def _csv(reader, path: str) -> DataFrame:
    """CSV as ``sinks.write_csv`` writes it: an empty string and a null differ."""
    return reader.option("header", True).option("nullValue", CSV_NULL).csv(path)


def read_cycles(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The per-cycle dataset (CSV with header, JSON lines or Parquet)."""
    r = spark.read.schema(S.CYCLE_SCHEMA)
    if fmt == "csv":
        return _csv(r, path)
    return r.format(fmt).load(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    """Fitted scaler statistics (one row)."""
    return spark.read.parquet(path)
