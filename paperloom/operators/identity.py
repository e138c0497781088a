"""Identities of question blocks and of assets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import cues
from paperloom.functions.text import formulas, hash_or_empty, short_hash, source_position, squash, strip, text_or_empty


def rounded_box(digits: int):
    """Pandas function that prints a box rounded as Python prints its tuple; keys hash this text."""

    @F.pandas_udf("string")
    def show(boxes: pd.Series) -> pd.Series:
        return boxes.map(lambda b: str(tuple(round(float(v), digits) for v in b)))

    return show


def fingerprints(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """Identity rows of layout blocks: position key and the text, formula and asset fingerprints.

    ``blocks`` are those of the layout program, ``elements`` the raw ones; of
    elements that share an id the last counts.
    """
    last = elements.groupBy("paper_id", "id").agg(F.max_by(F.struct("type", "text", "page", "bbox"), "ord").alias("e"))
    key = ["paper_id", "block_index"]
    own = blocks.select(*key, F.posexplode("element_ids").alias("n", "id")).join(last, ["paper_id", "id"])
    own = own.where(F.col("e.type").isin("text", "formula")).withColumn("t", text_or_empty(F.col("e.text")))
    parts = own.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", strip(F.col("t")).alias("t")))), lambda x: x["t"]), " ").alias("all"),
        F.array_sort(F.flatten(F.collect_list(F.filter(F.transform(formulas(F.col("t")), squash), lambda f: F.length(f) > 0)))).alias("formulas"),
    )
    seen = blocks.select(*key, F.explode("assets").alias("a")).select(*key, F.col("a.asset_id").alias("id")).join(last, ["paper_id", "id"])
    sign = F.concat(F.col("e.type"), F.lit(":p"), F.col("e.page"), F.lit(":"), rounded_box(2)(F.col("e.bbox")))
    signs = seen.select(*key, sign.alias("s")).groupBy(*key).agg(F.array_sort(F.collect_list("s")).alias("signs"))
    joined = blocks.join(parts, key, "left").join(signs, key, "left")
    listed = lambda c: hash_or_empty(F.coalesce(F.array_join(F.col(c), " | "), F.lit("")))
    return joined.select(
        *key, F.col("question_block_id").alias("block_id"), source_position(F.col("paper_id"), F.col("section_path"), F.col("question_number")).alias("source_position_key"),
        hash_or_empty(squash(F.coalesce("all", F.lit("")))).alias("text_fingerprint"), listed("formulas").alias("latex_fingerprint"), listed("signs").alias("asset_signature"),
    )


def raw_asset_id(paper: Column, page: Column, box_text: Column, kind: Column, element: Column) -> Column:
    return F.concat(F.lit("ra_"), short_hash(F.concat(paper, F.lit(":p"), page, F.lit(":"), box_text, F.lit(":"), kind, F.lit(":"), element)))


def content_hash(page: Column, box_text: Column, kind: Column) -> Column:
    return short_hash(F.concat(F.lit("p"), page, F.lit(":"), box_text, F.lit(":"), kind))


def raw_assets(blocks: DataFrame, elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assets that blocks took, and the links from blocks to them."""
    last = elements.groupBy("paper_id", "id").agg(F.max_by(F.struct("type", "page", "bbox"), "ord").alias("e"))
    taken = blocks.select("paper_id", "block_index", "question_block_id", F.explode("assets").alias("a"))
    joined = taken.withColumn("id", F.col("a.asset_id")).join(last, ["paper_id", "id"]).withColumn("box", rounded_box(4)(F.col("e.bbox")))
    key = raw_asset_id(F.col("paper_id"), F.col("e.page"), F.col("box"), F.col("e.type"), F.col("id"))
    joined = joined.withColumn("ra", key)
    wide, high = F.get("e.bbox", 2) - F.get("e.bbox", 0), F.get("e.bbox", 3) - F.get("e.bbox", 1)
    assets = joined.select(
        F.col("ra").alias("id"), "paper_id", F.col("e.page").alias("page"), F.col("e.bbox").alias("bbox"), F.col("e.type").alias("asset_type"), F.col("id").alias("source_element_id"),
        content_hash(F.col("e.page"), F.col("box"), F.col("e.type")).alias("content_hash"), wide.alias("width"), high.alias("height"), F.lit("identified").alias("status"),
    )
    links = joined.select(
        F.concat(F.lit("qal_"), "ra", F.lit("_"), "question_block_id").alias("id"), F.col("question_block_id").alias("question_id"), F.col("ra").alias("raw_asset_id"),
        F.lit("figure").alias("role"), F.col("a.score").alias("confidence"), F.col("a.needs_review").alias("needs_review"),
    )
    return assets, links


def block_content(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """``(paper_id, block_index, raw_markdown, x1, y1, x2, y2)`` of layout blocks: texts by blank lines, and their box."""
    last = elements.groupBy("paper_id", "id").agg(F.max_by(F.struct("text", "bbox"), "ord").alias("e"))
    own = blocks.select("paper_id", "block_index", F.posexplode("element_ids").alias("n", "id")).join(last, ["paper_id", "id"])
    own = own.withColumns({"t": strip(text_or_empty(F.col("e.text"))), **{s: F.get("e.bbox", i) for i, s in enumerate(("x1", "y1", "x2", "y2"))}})
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.length("t") > 0, F.struct("n", "t")))), lambda x: x["t"]), "\n\n")
    return own.groupBy("paper_id", "block_index").agg(text.alias("raw_markdown"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


def mentions_picture(x: Column) -> Column:
    return cues.matches(text_or_empty(x), cues.VISUAL_CUE)
