"""Ingestion plans: parser elements or Markdown of all papers to gated, validated questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators import rules, segment
from paperloom.operators.identity import block_content, fingerprints, raw_assets
from paperloom.plans.layout import layout
from paperloom.sources.providers import StructureProvider, structured

KEY = ["paper_id", "block_index"]


def _questions(blocks: DataFrame, entries: DataFrame, provider: StructureProvider | None) -> DataFrame:
    """Structured, completed, typed, repaired, validated and gated questions of blocks."""
    own = F.transform("_c", lambda c: F.struct(c["label"].alias("label"), c["content_latex"].alias("content_latex")))
    options = segment.choices(blocks, tuple(KEY)).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("sort_order", "label", "content_latex"))).alias("_c"))
    options = options.select(*KEY, own.alias("parsed_choices"))
    rows = structured(blocks, provider).join(options, KEY, "left").withColumnRenamed("warnings", "model_warnings")
    kind = "array<struct<label:string,content_latex:string>>"
    rows = rows.withColumn("parsed_choices", F.coalesce("parsed_choices", F.array().cast(kind)))
    rows = rows.withColumn("choices", F.when(F.size("choices") > 0, F.col("choices")).otherwise(F.col("parsed_choices")))
    rows = segment.filled(rows, entries)
    rows = rows.withColumn("question_type", rules.inferred_type(F.col("section_title")))
    rows = rules.repair(rows)
    rows = rules.validate(rows, F.col("n_assets"))
    shown = F.when(F.col("n_assets") > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("gated", rules.with_fallback(rules.gate(shown), F.col("model_warnings")))
    rows = rows.withColumn("needs_review", F.col("needs_review") | (F.size("model_warnings") > 0))
    return rows.withColumns({"gate": F.col("gated.gate"), "gate_codes": F.col("gated.codes"), "question_id": F.format_string("%s_q_%04d", F.col("paper_id").cast("string"), F.col("block_index").cast("int"))}).drop("gated", "parsed_choices")


def from_markdown(docs: DataFrame, provider: StructureProvider | None = None) -> DataFrame:
    """Questions of ``docs(paper_id, markdown)``."""
    blocks = segment.question_blocks(docs).withColumn("n_assets", F.lit(0))
    return _questions(blocks, segment.answer_entries(docs), provider)


def from_elements(elements: DataFrame, markdown: DataFrame, provider: StructureProvider | None = None) -> dict[str, DataFrame]:
    """Questions, blocks, warnings, assets, links and identities of layout elements.

    ``markdown(paper_id, markdown)`` only gives the answers.
    """
    made = layout(elements)
    text = block_content(made.blocks, elements)
    blocks = made.blocks.join(text.select(*KEY, "raw_markdown"), KEY, "left").withColumns({"raw_markdown": F.coalesce("raw_markdown", F.lit("")), "n_assets": F.size("assets"), "block_index": F.col("block_index") + 1})
    assets, links = raw_assets(made.blocks, elements)
    plain = blocks.select("paper_id", "block_index", "question_number", "section_title", "raw_markdown", "n_assets")
    return {"blocks": made.blocks, "warnings": made.warnings, "questions": _questions(plain, segment.answer_entries(markdown), provider), "assets": assets, "links": links, "identities": fingerprints(made.blocks, elements)}
