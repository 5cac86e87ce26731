"""The queries of this subpackage and, where SQL can express one, its DuckDB statement.

Each query hands its whole intended table to one operator with production parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellhealth.llm import (ann, bpe, decontamination, exact_dedup, html_text, lm_scoring, packing, quality, simhash,
                            spelling, substring_dedup, token_counts, whitening)
from cellhealth.llm.common import LOWER, UPPER, table


def public_tokenizer(name: str) -> str:
    """The place of a public vocabulary file; only the queries name it, operators take a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.hmm_scores(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), width=3, distance=2)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span=10)


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=8)


QUERIES = {f.__name__: f for f in (op1_hmm_scoring, op2_best_fit_packing, op3_suffix_array_dedup, op4_quality_classifier,
                                   op5_html_main_text, op6_exact_dedup, op7_bpe_codec,
                                   op8_simhash_near_dedup, op9_nearest_neighbours, op10_token_counts,
                                   op11_benchmark_decontamination, op12_spelling_groups, op13_embedding_whitening)}

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

SQL = {
    "op6_exact_dedup": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
    "op11_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item, w, least(len(w), 10) AS m
      FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
spans AS (SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS g
          FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM i)),
cuts AS (SELECT rid, m, s, array_to_string(w[s:s + m - 1], ' ') AS g
         FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM spans))),
hits AS (SELECT rid, s, m, item FROM cuts JOIN spans USING (m, g)),
places AS (SELECT rid, count(DISTINCT p) AS n_hit
           FROM (SELECT rid, unnest(range(s, s + m)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)""",
}
