"""Extension points: parsers, structure models and stores, with deterministic defaults.

A provider works on batches inside tasks and returns an error column instead of
failing the job; retries are the provider's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.rules import NO_ANSWER, PLACEHOLDER
from paperloom.schemas import PAYLOAD


class StructureProvider(Protocol):
    """Turns a block's Markdown into a payload."""

    def structure(self, markdown: str) -> dict[str, Any]: ...


class Parser(Protocol):
    """Turns a PDF's bytes into layout elements."""

    def parse(self, content: bytes) -> list[dict[str, Any]]: ...


class ObjectStore(Protocol):
    """Keeps bytes under a key and says where."""

    def put(self, key: str, content: bytes, content_type: str) -> str: ...


@dataclass(frozen=True)
class Retrying:
    """A structure provider that is asked again after an error, and then gives a reviewable payload."""

    inner: StructureProvider
    attempts: int = 2

    def structure(self, markdown: str) -> dict[str, Any]:
        errors: list[str] = []
        for _ in range(self.attempts):
            try:
                payload = dict(self.inner.structure(markdown))
            except Exception as error:  # any failure of a provider concerns its block alone
                errors.append(str(error))
                continue
            if errors:
                note = f"deepseek_retry: recovered on attempt {len(errors) + 1} after {errors[-1][:160]}"
                payload["warnings"] = [*(payload.get("warnings") or []), note]
            return payload
        return fallback(markdown, errors[-1] if errors else "unknown provider failure")


def fallback(markdown: str, error: str) -> dict[str, Any]:
    stem = markdown.strip() or "（DeepSeek结构化失败，原始题块为空）"
    return {"question_type": "short_answer", "stem_latex": stem, "choices": [], "answer_latex": NO_ANSWER, "analysis_latex": PLACEHOLDER, "knowledge_points": [], "difficulty": None, "warnings": [f"deepseek_fallback: {error[:200]}"]}


def default_payload(markdown: Column) -> Column:
    """The deterministic provider as an expression: the block itself is the stem of a short answer."""
    none = F.array().cast("array<string>")
    sure = F.struct(F.lit(1.0).alias("structure"), F.lit(1.0).alias("latex"), F.lit(0.0).alias("answer"), F.lit(0.0).alias("knowledge"))
    empty = F.array().cast("array<struct<label:string,content_latex:string>>")
    return F.struct(
        F.lit("short_answer").alias("question_type"), markdown.alias("stem_latex"), empty.alias("choices"), F.lit("").alias("answer_latex"), F.lit("").alias("analysis_latex"), none.alias("knowledge_points"),
        F.lit(None).cast("int").alias("difficulty"), sure.alias("confidence"), F.array(F.lit("fake_client_output")).alias("warnings"),
    )


def structured(blocks: DataFrame, provider: StructureProvider | None = None) -> DataFrame:
    """``blocks(..., raw_markdown)`` with the payload's columns; without a provider the default's."""
    if provider is None:
        return blocks.withColumn("_p", default_payload(F.col("raw_markdown"))).select(*blocks.columns, "_p.*")
    asked = Retrying(provider)
    fields = ["question_type", "stem_latex", "choices", "answer_latex", "analysis_latex", "knowledge_points", "difficulty", "confidence", "warnings"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [asked.structure(m or "") for m in frame["raw_markdown"]]
            yield frame.assign(**{f: pd.Series([p.get(f) for p in made], index=frame.index, dtype=object) for f in fields})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema) + ", " + PAYLOAD
    return blocks.mapInPandas(run, schema)


def parsed(files: DataFrame, parser: Callable[[bytes], list[dict[str, Any]]]) -> DataFrame:
    """``files(path, content)`` as ``(path, ord, id, page, type, bbox, text, confidence, error)``; a file that
    fails is one row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "ord", "id", "page", "type", "bbox", "text", "confidence", "error"]
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows += [(path, i, e["id"], e["page"], e["type"], e["bbox"], e.get("text"), e.get("confidence"), None) for i, e in enumerate(parser(bytes(content)))]
                except Exception as error:  # one bad file is one bad row
                    rows.append((path, None, None, None, None, None, None, None, str(error)))
            yield pd.DataFrame(rows, columns=names).astype({"ord": "Int64", "page": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, ord int, id string, page int, type string, bbox array<double>, text string, confidence double, error string")


def asset_key(paper: Column, question: Column, file_name: Column) -> Column:
    return F.concat_ws("/", F.lit("papers"), paper, question, file_name)


def asset_url(paper: Column, asset: Column) -> Column:
    return F.concat(F.lit("local://assets/"), paper, F.lit("/"), asset, F.lit(".png"))


def to_store(assets: DataFrame, stored: DataFrame) -> DataFrame:
    """Assets whose content is not stored yet under their id, with the key and address that they get."""
    fresh = assets.join(stored.select("id", "content_hash"), ["id", "content_hash"], "left_anti")
    return fresh.withColumns({"storage_url": asset_url(F.col("paper_id"), F.col("id")), "object_key": F.concat_ws("/", F.lit("assets"), "paper_id", F.concat("id", F.lit(".png")))})


def to_crop(assets: DataFrame) -> DataFrame:
    """Assets without a crop; failed ones are tried again."""
    return assets.where(F.coalesce("crop_path", F.lit("")) == "")


def to_hash(assets: DataFrame) -> DataFrame:
    """Assets with a crop and without a perceptual hash."""
    return assets.where((F.coalesce("crop_path", F.lit("")) != "") & (F.coalesce("perceptual_hash", F.lit("")) == ""))
