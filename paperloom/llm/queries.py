"""The registered query of each operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import arc_convert, piece_codec, quality_lm, robust_rules, secret_scan, simhash_dedup, source_mix, topk_search, toxicity_fm, uniform_shards
from paperloom.llm.shared import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality_lm.classify(docs, table(spark, sf_dir, "labels"), carry=["doc_id", "lang"])
    return judged.select("doc_id", "lang", "lm_symbols", "lm_perplexity", "lm_threshold", F.col("lm_kept").alias("kept"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_robust_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = robust_rules.classify(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op4_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = arc_convert.convert(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def piece_model_path() -> str:
    """The model file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"), piece_model_path())


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents")).drop("copies")


def op9_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform_shards.shard(table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_classifier, op2_simhash_dedup, op3_robust_rules, op4_arc_convert, op5_toxicity_fm, op6_secret_scan, op7_piece_codec, op8_source_mix, op9_uniform_shards, op10_topk_search)
}
ORACLE_SQL: dict[str, str] = {
    "op4_arc_convert": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), m AS (
            SELECT *, CASE WHEN n >= 1000 AND page_id IS NOT NULL THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM p
        )
        SELECT page_id, n AS payload_bytes, payload_digest,
               CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN last > page_id THEN last END AS refers_to
        FROM m
    """,
    "op10_topk_search": """
        WITH v AS (
            SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, q.n AS n, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.n <> c.n
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 5
    """,
}
