"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.graph import components, meet
from paperloom.llm.shared import slices, unused, with_place
from paperloom.scratch import stored

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Shingles whose bits are counted at once; bounds the memory that a very long text takes.
_BLOCK = 1 << 16


def simhash(text: bytes | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text; 0 for null and for texts without words."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles: Iterable[bytes] = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    n = max(1, len(words) - shingle_words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        block = hashes[at : at + _BLOCK].astype("<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = SEED, more: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` of every row, ``fp`` being the fingerprint as a signed long, and its long columns ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            found = np.array([simhash(x, shingle_words, seed) for x in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64)), *(batch.column(c) for c in more)], ["doc_id", "fp", *more])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more)
    return kept.mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in more))


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` between the nodes of ``nodes(fp, node)`` that make the same components as all
    pairs at ``max_distance`` bits or fewer. ``fp`` is unique.

    Every fingerprint emits all variants within half the distance. Two
    fingerprints meet on a variant exactly when they are near enough, and all
    that meet on one variant are near each other, so that linking neighbours
    in each bucket loses nothing; a bucket holds no more fingerprints than the
    ball has masks (65 at distance 2), however many copies a text has.
    """
    if max_distance % 2:
        raise ValueError("max_distance must be even: balls of half the distance have to meet")
    masks = F.array(*[F.lit(m).cast("long") for m in ball_masks(max_distance // 2)])
    spread = nodes.select("fp", "node", F.explode(masks).alias("mask"))
    spread = spread.select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp", "node")
    bucket = Window.partitionBy("variant").orderBy("fp")
    met = spread.select("fp", "node", F.lag("fp").over(bucket).alias("fp0"), F.lag("node").over(bucket).alias("node0"))
    near = met.where(F.col("fp0").isNotNull() & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp0"))) <= max_distance))
    return near.select(F.least("node", "node0").alias("a"), F.greatest("node", "node0").alias("b")).distinct()


def _classes(found: DataFrame, max_distance: int) -> DataFrame:
    """``(fp, n, least, component)`` of each fingerprint of ``found(doc_id, fp)``: its rows, its least doc_id, and its component's number.

    Fingerprints are numbered by themselves, so that texts that share a doc_id are not linked by it.
    """
    per_fp = found.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    nodes = stored(per_fp.withColumn("node", F.col("fp")), "simhash-nodes")
    label = components(links(nodes, max_distance))
    return nodes.join(label, "node", "left").select("fp", "n", "least", F.coalesce("label", "node").alias("component"))


def near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``.

    Null and wordless texts have fingerprint zero and are linked like others.
    Repeated rows are returned as often as they come. Rows with a null doc_id
    link others but lend no id: a component of such rows alone has a null
    component_id. Other columns are ignored; an empty table gives no rows.
    """
    found = stored(fingerprints(docs), "simhash")
    classes = stored(_classes(found, max_distance), "simhash-classes")
    sizes = classes.agg(F.count("*"), F.sum("n")).first()
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("fps"))
    told = meet(classes, named, "component", "fps", sizes[0]).select("fp", "n", "component_id")
    hex16 = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return meet(found, told, "fp", "n", sizes[1] or 0).select("doc_id", hex16.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component of ``docs``: that of the least doc_id (nulls last), then the first in place.

    Null and wordless texts are one component or part of one. Rows are told
    apart by their file and their place in it, so that null, shared and repeated
    ids and clashing column names do not matter. The columns of ``docs`` stay as
    they are; an empty table gives no rows. Texts are read for their fingerprints
    and once more for the rows that stay, and move once at most.
    """
    file, row = unused(docs.columns, "sd_file"), unused(docs.columns, "sd_row")
    placed = with_place(docs, file, row, "simhash-input")
    slim = placed.select(F.col("doc_id"), F.col("text"), F.col(file).alias("sd_file"), F.col(row).alias("sd_row"))
    found = stored(fingerprints(slim, more=("sd_file", "sd_row")), "simhash")
    classes = stored(_classes(found, max_distance), "simhash-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("sd_file").alias("file"), F.col("sd_row").alias("row"))
    known = meet(found, classes.select("fp", "n", "component"), "fp", "n", total)
    stay = known.groupBy("component").agg(F.min(order).alias("least")).select(F.col("least.file").alias(file), F.col("least.row").alias(row))
    # The rows that stay grow with the input: they are never broadcast.
    return placed.join(stored(stay, "simhash-stay").hint("merge"), [file, row], "left_semi").select(*docs.columns)
