"""The corpus pipeline: filter, deduplicate, redact, mix and encode ``documents``.

Every stage works on all rows of the one before and keeps its columns, whatever
further ones there are and however they are named; an empty table gives no rows.
Null, shared and repeated ids are allowed everywhere: stages tell rows apart by
their texts or by their place, never by id alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import piece_codec, quality_lm, queries, secret_scan, simhash_dedup, source_mix
from paperloom.llm.shared import table
from paperloom.scratch import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Null and empty texts are judged like others (a single end of text), repeated
    rows alike; very long texts are read in runs. Without trusted documents all stay.
    """
    judged = quality_lm.classify(docs, table(spark, sf_dir, "labels"))
    return judged.where("lm_kept").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    The least doc_id stays, nulls last; of rows with the same, the first in place.
    Null and wordless texts are one group.
    """
    return simhash_dedup.one_of_each(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark.

    Null texts stay null; ``n_chars`` follows the new text.
    """
    return secret_scan.redact(docs, secret_scan.fit(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    Row by row; a null source is a source, and texts without words come with whole copies only.
    """
    return source_mix.materialize(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids, decoded text and source spans of every row; null texts count as empty."""
    return piece_codec.digests(docs, queries.piece_model_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secret_stage),
    ("source_mix", mix_stage),
    ("piece_codec", encode_stage),
]

#: The classifier and the network are trained models: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
