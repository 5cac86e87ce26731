"""A training corpus made from ``documents`` in five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellhealth.llm import exact_dedup, packing, quality, simhash, substring_dedup
from cellhealth.llm.common import table, write_stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, width=3, distance=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.drop_repeats(docs, length=200)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, capacity=2048)


STAGES = [("quality_classifier", quality_filter), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("suffix_array_dedup", repeated_passages), ("best_fit_packing", windows)]

#: No SQL: a trained classifier, components and packing; the tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's rows written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return docs
