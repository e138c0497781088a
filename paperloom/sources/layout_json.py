"""Scans of parser output: layout elements in three shapes of JSON, files, Markdown, PDF bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.geometry import scaled_box
from paperloom.functions.text import is_blank, pdf_pages

# Parser types and the element types they become; others are text.
TYPES = {
    "text": "text", "list": "text", "header": "header", "footer": "footer", "page_number": "footer", "equation": "formula", "interline_equation": "formula",
    "inline_equation": "formula", "image": "image", "table": "table", "chart": "figure",
}
#: Which of a folder's JSON files counts, the first kind that there is.
PRECEDENCE = ("_content_list.json", "_middle.json", ".json")


def files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``(path, text)`` of whole files below ``path``."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path, wholetext=True)
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def chosen_files(found: DataFrame) -> DataFrame:
    """One JSON file of each folder: by precedence, then by name."""
    rank = F.when(F.endswith("path", F.lit(PRECEDENCE[0])), 0).when(F.endswith("path", F.lit(PRECEDENCE[1])), 1).otherwise(2)
    best = found.groupBy(folder(F.col("path")).alias("folder")).agg(F.min_by(F.struct("path", "text"), F.struct(rank.alias("r"), F.col("path").alias("p"))).alias("f"))
    return best.select("folder", "f.path", "f.text")


def paper_folders(spark: SparkSession, path: str) -> DataFrame:
    """``(paper_id, folder)`` of folders that hold both output.json and output.md."""
    named = lambda name: files(spark, path, name).select(folder(F.col("path")).alias("folder"))
    both = named("output.json").join(named("output.md"), "folder", "left_semi")
    return both.select(F.regexp_extract("folder", r"([^/]+/[^/]+)$", 1).alias("paper_id"), "folder")


_FLAT = "array<struct<id:string,page:int,type:string,bbox:array<double>,text:string,confidence:double>>"
_ITEM = "struct<type:string,page_idx:int,bbox:array<double>,text:string,list_items:array<string>,content:variant,table_body:variant,table_caption:variant,img_caption:variant,confidence:double>"


def _said(v: Column) -> Column:
    """Text of a value that may be a string or a list of strings; a list is joined by lines."""
    listed = F.array_join(F.filter(F.try_variant_get(v, "$", "array<string>"), lambda x: ~is_blank(x)), "\n")
    return F.coalesce(F.when(F.schema_of_variant(v).startswith("ARRAY"), listed), F.try_variant_get(v, "$", "string"))


def _item_text(x: Column) -> Column:
    """The first of an item's texts that is not blank; a list's items win even if empty."""
    options = [x["text"], _said(x["content"]), _said(x["table_body"]), _said(x["table_caption"]), _said(x["img_caption"])]
    chain = F.when((x["type"] == "list") & x["list_items"].isNotNull(), F.array_join(x["list_items"], "\n"))
    for o in options:
        chain = chain.when(~is_blank(o), o)
    return chain.otherwise("")


def shape(text: Column) -> Column:
    """Shape of a JSON text: elements, content_list, paged_content_list; null for others. An empty list has elements."""
    items = F.from_json(text, "array<variant>")
    some = F.slice(items, 1, 5)
    has = lambda x, *keys: F.forall(F.array(*[F.try_variant_get(x, f"$.{k}", "variant").isNotNull() for k in keys]), lambda b: b)
    flat = F.forall(some, lambda x: has(x, "page", "type", "bbox"))
    listed = F.forall(some, lambda x: has(x, "page_idx", "bbox"))
    paged = F.forall(some, lambda x: F.startswith(F.schema_of_variant(x), F.lit("ARRAY")))
    return F.when(F.size(items) == 0, "elements").when(flat, "elements").when(listed, "content_list").when(paged, "paged_content_list")


def elements(json_files: DataFrame, key: str = "paper_id", text: str = "text") -> DataFrame:
    """``(key, ord, id, page, type, bbox, text, confidence)`` of every file, whatever its shape.

    Items of content lists get ids from their places in the file, pages from
    one on, boxes in shares; items without a sound box are dropped. A file of no
    known shape is an error.
    """
    rows = json_files.withColumn("shape", shape(F.col(text)))
    rows = rows.withColumn("shape", F.coalesce("shape", F.raise_error(F.concat(F.lit("no layout elements in "), F.col(key).cast("string")))))
    flat = rows.where("shape = 'elements'").select(key, F.posexplode(F.from_json(text, _FLAT)).alias("ord", "e")).select(key, "ord", "e.*")
    single = rows.where("shape = 'content_list'").select(key, F.from_json(text, f"array<{_ITEM}>").alias("items"))
    paged = rows.where("shape = 'paged_content_list'").select(key, F.from_json(text, f"array<array<{_ITEM}>>").alias("pages"))
    whole = F.flatten(F.transform("pages", lambda p, i: F.transform(p, lambda x: F.struct(x.alias("x"), i.alias("outer")))))
    items = single.select(key, F.posexplode(F.transform("items", lambda x: F.struct(x.alias("x"), F.lit(0).alias("outer")))).alias("ord", "w"))
    items = items.unionByName(paged.select(key, F.posexplode(whole).alias("ord", "w")))
    x = F.col("w.x")
    page = F.coalesce(x["page_idx"], F.col("w.outer"))
    kinds = F.create_map(*[F.lit(v) for kv in TYPES.items() for v in kv])
    listed = items.select(
        key, "ord", F.format_string("m%06d", F.col("ord") + 1).alias("id"), F.when(page >= 0, page + 1).otherwise(1).alias("page"),
        F.coalesce(F.try_element_at(kinds, x["type"]), F.lit("text")).alias("type"), scaled_box(x["bbox"]).alias("bbox"), _item_text(x).alias("text"),
        F.when(F.coalesce(x["confidence"], F.lit(0.0)) == 0, 1.0).otherwise(x["confidence"]).alias("confidence"),
    )
    return flat.unionByName(listed.where("bbox is not null"))


def markdown(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """``(path, markdown)``; an empty file is an error."""
    found = files(spark, path, glob)
    sound = F.assert_true(~is_blank(F.col("text")), F.concat(F.lit("empty Markdown in "), F.col("path"))).isNull()
    return found.where(sound).select("path", F.col("text").alias("markdown"))


def pdf_page_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, pages)`` of PDF files, by the page objects that their bytes name."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(path)
    return found.select("path", pdf_pages(F.col("content")).alias("pages"))
