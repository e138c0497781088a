"""What the corpus operators have in common: tables, words and bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.scratch import stored

#: ASCII white space; words are the runs between.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The ASCII-space separated words of ``text`` (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, even inside higher-order functions."""
    return F.transform(F.array(value), body)[0]


def hash_share(key: Column, expected: int, total: int, seed: int) -> Column:
    """True for a repeatable share of the keys: all of them up to ``expected``, else about that many."""
    if total <= expected:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < F.lit(int((1 << 30) * expected / total))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_place(docs: DataFrame, file: str, row: str, label: str) -> DataFrame:
    """``docs`` with each row's file (a hash) and place in it, alike at every read; frames that aren't plain
    reads of files are written first."""
    add = lambda d: d.withColumns({file: F.xxhash64(F.col("_metadata.file_path")), row: F.col("_metadata.row_index")})
    try:
        return add(docs)
    except AnalysisException:
        return add(stored(docs, label))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, ``rows`` at a time: what a worker makes of whole texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
