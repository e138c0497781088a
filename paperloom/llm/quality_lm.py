"""Quality classifier: an interpolated modified Kneser-Ney model of character n-grams.

The model is trained on trusted text. Its counts stay distributed tables, keyed
and sharded by n-gram, and documents are scored by joining the distinct n-grams
of a block of documents with those tables. Each language's threshold is a
quantile of the perplexities of trusted documents that were not counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import slices, unused, with_place
from paperloom.scratch import stored

ORDER = 4
#: Bits of a symbol: code points below 16384 stand for themselves, others share 16383 classes.
SYMBOL_BITS = 15
_PLAIN = 1 << 14
#: Symbol 0 pads the start of a text, symbol 1 ends it (U+0001 counts as an end).
_END = 1
_SEED = 11
#: Share of trusted documents that the thresholds keep.
KEEP_QUANTILE = 0.99
#: One trusted text in so many is left out of the counts and sets the thresholds.
HELD_OUT = 5
#: Weight, in documents, of all languages' spread beside a language's own in its threshold.
SHARED_WEIGHT = 200
ADDED = ("lm_symbols", "lm_perplexity", "lm_threshold", "lm_kept")
#: Rows of a file whose distinct n-grams are looked up together, where none is longer than BLOCK_CHARS characters;
#: texts up to four times that are taken a quarter as many at a time, and so on, so that a block holds BLOCK_ROWS times
#: BLOCK_CHARS characters at most, or one text.
BLOCK_ROWS, BLOCK_CHARS = 2048, 65_536
#: Characters whose n-grams are in memory at once.
RUN_CHARS = 1_000_000
#: Distinct n-grams that a task holds before it hands them on.
HELD_KEYS = 1_000_000
#: The most frequent n-grams, whose answers go to all workers instead of being joined for every block.
HEAD = 1 << 17


@dataclass
class Model:
    """For each order, tables ``(key, share)`` and ``(ctx, rest)``; and sorted keys and log probabilities of the HEAD
    most frequent n-grams of the highest order."""

    orders: dict[int, tuple[DataFrame, DataFrame]]
    head: tuple[np.ndarray, np.ndarray]


def symbols(text: str) -> np.ndarray:
    """The text's code points as symbols."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(points < _PLAIN, np.maximum(points, _END), _PLAIN + points % (_PLAIN - 1))


def ngrams(text: str) -> Iterator[np.ndarray]:
    """One key for each symbol of the text and for its end: its n-gram of the highest order, 60 bits; a run at a time."""
    before = np.zeros(ORDER - 1, np.int64)
    for at in range(0, len(text) + 1, RUN_CHARS):
        part = symbols(text[at : at + RUN_CHARS])
        if at + RUN_CHARS > len(text):
            part = np.append(part, _END)
        s = np.concatenate([before, part])
        before = s[len(s) - ORDER + 1 :]
        keys = s[: len(part)].copy()
        for i in range(1, ORDER):
            keys <<= SYMBOL_BITS
            keys |= s[i : i + len(part)]
        yield keys


def _runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' n-grams in runs of about RUN_CHARS at most: keys, and the text that each belongs to."""
    keys, owner, size = [], [], 0
    for at, text in enumerate(texts):
        for part in ngrams(text or ""):
            if size and size + len(part) > RUN_CHARS:
                yield np.concatenate(keys), np.concatenate(owner)
                keys, owner, size = [], [], 0
            keys.append(part)
            owner.append(np.full(len(part), at))
            size += len(part)
    if keys:
        yield np.concatenate(keys), np.concatenate(owner)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams with counts, merged while they fit."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = lambda: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "c"])
    for batch in slices(batches, 1024):
        for run, _ in _runs(batch.column("text").to_pylist()):
            k, c = np.unique(run, return_counts=True)
            merged, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, c])).astype(np.int64)
            keys = merged
            if len(keys) > HELD_KEYS:
                yield out()
                keys, counts = keys[:0], counts[:0]
    if len(keys):
        yield out()


def _low(order: int) -> int:
    return (1 << (SYMBOL_BITS * order)) - 1


def train(trusted: DataFrame) -> Model:
    """The model of ``trusted(text)``.

    ``share`` is an n-gram's discounted count over its context's total, ``rest``
    the weight that the context leaves to the order below. Below the highest
    order, counts are numbers of distinct preceding symbols. The three discounts
    of each order come from its counts of counts.
    """
    counts = stored(trusted.select("text").mapInArrow(_count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")), "ngrams")
    orders, most = {}, counts.orderBy(F.desc("c"), "key").limit(HEAD).select("key")
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            counts = counts.groupBy((F.col("key").bitwiseAND(F.lit(_low(order)))).alias("key")).agg(F.count("*").alias("c"))
            counts = stored(counts, "ngrams")
        n = counts.agg(*[F.coalesce(F.count_if(F.col("c") == i), F.lit(0)).alias(f"n{i}") for i in range(1, 5)]).first()
        y = n.n1 / (n.n1 + 2 * n.n2) if n.n1 and n.n2 else 0.5
        cut = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) if n[i - 1] and n[i] else 0.5 for i in (1, 2, 3)]
        off = F.when(F.col("c") == 1, cut[0]).when(F.col("c") == 2, cut[1]).otherwise(cut[2])
        keyed = counts.select("key", F.shiftright("key", SYMBOL_BITS).alias("ctx"), "c", off.alias("d"))
        context = keyed.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("d"))
        context = context.select("ctx", "total", (F.col("d") / F.col("total")).alias("rest"))
        share = keyed.join(context.select("ctx", "total"), "ctx").select("key", ((F.col("c") - F.col("d")) / F.col("total")).alias("share"))
        orders[order] = stored(share, f"share{order}"), stored(context.select("ctx", "rest"), f"rest{order}")
    model = Model(orders, (np.zeros(0, np.int64), np.zeros(0)))
    head = log_probabilities(most, model).orderBy("key").toArrow()  # HEAD rows at most
    model.head = head.column("key").to_numpy(), head.column("logp").to_numpy()
    return model


def log_probabilities(keys: DataFrame, model: Model) -> DataFrame:
    """``(key, logp)`` for distinct n-grams ``keys(key)``, by one pair of joins for each order."""
    scored = keys.withColumn("p", F.lit(1.0 / (1 << SYMBOL_BITS)))
    for order in range(1, ORDER + 1):
        share, rest = model.orders[order]
        scored = scored.withColumn("k", F.col("key").bitwiseAND(F.lit(_low(order)))).withColumn("h", F.shiftright("k", SYMBOL_BITS))
        scored = scored.join(share.toDF("k", "share"), "k", "left").join(rest.toDF("h", "rest"), "h", "left")
        scored = scored.select("key", (F.coalesce("share", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * F.col("p")).alias("p"))
    return scored.select("key", F.log("p").alias("logp"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each block in a batch as compressed Arrow data."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    for batch in slices(batches, BLOCK_ROWS):
        for block, piece in _by_block(batch):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, piece.schema, options=options) as writer:
                writer.write_batch(piece)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each block in a batch, without the block's column, which is the last."""
    blocks = batch.column(batch.num_columns - 1).to_numpy()
    rest = batch.select(list(range(batch.num_columns - 1)))
    order = np.argsort(blocks, kind="stable")
    edges = [0, *(np.flatnonzero(np.diff(blocks[order])) + 1).tolist(), len(blocks)]
    for first, last in zip(edges, edges[1:], strict=False):
        if last > first:
            whole = order[last - 1] - order[first] == last - 1 - first
            piece = rest.slice(int(order[first]), last - first) if whole else rest.take(pa.array(order[first:last]))
            yield int(blocks[order[first]]), piece


def _wanted(batches: Iterator[pa.RecordBatch], head: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each block that aren't in ``head``, once or, where a task can't hold them, in parts."""
    held: dict[int, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        found = [pa.array(np.repeat(np.array(list(held), np.int64), [len(k) for k in held.values()])), pa.array(np.concatenate(list(held.values())))]
        held.clear()
        return pa.RecordBatch.from_arrays(found, ["block", "key"])

    for batch in slices(batches, 1024):
        for block, rows in _by_block(batch):
            for run, _ in _runs(rows.column(0).to_pylist()):
                run = np.unique(run)
                run = run[~_inside(run, head)]
                held[block] = np.union1d(held[block], run) if block in held else run
            if sum(map(len, held.values())) > HELD_KEYS:
                yield out()
    if held:
        yield out()


def _inside(asked: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each of ``asked`` is among the sorted ``keys``."""
    return keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked if len(keys) else np.zeros(len(asked), bool)


def _block(file: Column, row: Column, text: Column) -> Column:
    """The block of a row: its file, the class of its length, and its range of rows there."""
    size = F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)) / BLOCK_CHARS
    level = F.greatest(F.ceil(F.log2(size) / 2), F.lit(0)).cast("int")
    rows = F.greatest(F.lit(BLOCK_ROWS) / F.pow(F.lit(4.0), level), F.lit(1.0))
    return F.xxhash64(file, level, F.floor(row / rows))


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``lm_symbols`` and ``lm_perplexity``.

    Texts travel once, compressed, to meet the answers for their block; only the
    n-grams that aren't among the most frequent are joined with the model's
    tables. A null or empty text has one symbol, its end. All rows stay.
    """
    head = docs.sparkSession.sparkContext.broadcast(model.head)
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ADDED]
    file, row = unused(docs.columns, "lm_file"), unused(docs.columns, "lm_row")
    placed = with_place(docs, file, row, "lm_input")
    block = _block(F.col(file), F.col(row), F.col("text"))
    wanted = stored(placed.select("text", block.alias("lm_block")).mapInArrow(lambda b: _wanted(b, head.value[0]), "block long, key long"), "lm-wanted")
    known = stored(log_probabilities(wanted.select("key").distinct(), model), "lm-known")
    answers = wanted.join(known.hint("merge"), "key").select("block", "key", "logp")  # known grows: never broadcast
    schema = docs.select(*carry).schema.add("lm_symbols", "long").add("lm_perplexity", "double")

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, first = np.unique(np.concatenate([head.value[0], right.column("key").to_numpy()]), return_index=True)
        logp = np.concatenate([head.value[1], right.column("logp").to_numpy()])[first]
        out = []
        for blob in left.column("rows"):
            rows = pa.ipc.open_stream(blob.as_py()).read_all()
            n, total = np.zeros(len(rows), np.int64), np.zeros(len(rows))
            for asked, owner in _runs(rows.column(0).to_pylist()):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                if not np.array_equal(keys[at], asked):
                    raise ValueError("the documents changed between two reads")
                n += np.bincount(owner, minlength=len(rows))
                total += np.bincount(owner, logp[at], len(rows))
            out.append(rows.select(list(range(1, rows.num_columns))).append_column("lm_symbols", pa.array(n)).append_column("lm_perplexity", pa.array(np.exp(-total / n))))
        return pa.concat_tables(out)

    # The text comes first and the block last, whatever the names between.
    texts = unused(docs.columns, "lm_text")
    packed = placed.select(F.col("text").alias(texts), *[F.col(c) for c in carry], block.alias(unused([*docs.columns, texts], "lm_block")))
    packed = packed.mapInArrow(_packed, "block long, rows binary")
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``(doc_id)`` of all rows labelled good, each once."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def held_out(text: Column) -> Column:
    """True for the texts that set thresholds instead of being counted; copies of a text go together."""
    return F.pmod(F.xxhash64(F.lit(_SEED), text), F.lit(HELD_OUT)) == 0


def thresholds(trusted: DataFrame, quantile: float = KEEP_QUANTILE) -> tuple[DataFrame, float | None]:
    """``(lm_lang, lm_own)`` of each language of ``trusted(lang, lm_perplexity)``, and the quantile over all.

    A language's threshold is its median perplexity times a spread, the
    ``quantile`` of its documents' ratios to the median. Its own spread counts as
    many documents as it has, that over all languages counts SHARED_WEIGHT, so
    that a language with few of them leans on the others and no size is a switch.
    """
    at = lambda c, q: F.percentile_approx(c, F.lit(q), F.lit(10_000))
    logs = stored(trusted.select("lang", F.log("lm_perplexity").alias("log")), "lm-trusted-scores")
    own = stored(logs.groupBy(F.col("lang").alias("lm_lang")).agg(F.count("*").alias("n"), at("log", 0.5).alias("median"), at("log", quantile).alias("top")), "lm-languages")
    spread = logs.join(own, logs["lang"].eqNullSafe(own["lm_lang"])).agg(at(F.col("log") - F.col("median"), quantile).alias("s"), at("log", quantile).alias("q")).first()
    if spread.q is None:
        return own.select("lm_lang", F.lit(None).cast("double").alias("lm_own")), None
    shared = (F.col("n") * (F.col("top") - F.col("median")) + SHARED_WEIGHT * F.lit(float(spread.s))) / (F.col("n") + SHARED_WEIGHT)
    return own.select("lm_lang", F.exp(F.col("median") + shared).alias("lm_own")), math.exp(spread.q)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = KEEP_QUANTILE, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``, which hold doc_id and lang) with ``lm_symbols``, ``lm_perplexity``,
    ``lm_threshold`` and ``lm_kept``.

    The model counts the trusted texts but one in HELD_OUT; these set the
    thresholds, which depend on all of them. A document is kept if its
    perplexity is no more than its language's threshold (null is a language);
    one without trusted documents uses the quantile over all. Without trusted
    held-out documents every row is kept and the threshold is null. Null and
    empty texts are judged like others; repeated rows are judged alike; columns
    of ``docs`` that have these names are replaced, and others stay, whatever
    their names; an empty table gives no rows.
    """
    ids = stored(trusted_ids(labels), "lm-trusted")
    good = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")  # trusted ids grow: never broadcast
    model = train(good.where(~held_out(F.coalesce("text", F.lit("")))))
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ADDED]
    told = unused(docs.columns, "lm_held")
    marked = docs.withColumn(told, held_out(F.coalesce("text", F.lit(""))))
    scored = stored(score(marked, model, [*carry, told]), "lm-scored")
    own, overall = thresholds(scored.where(F.col(told)).select("doc_id", "lang", "lm_perplexity").join(ids, "doc_id", "left_semi"), quantile)
    lang, mine = unused(scored.columns, "lm_lang"), unused(scored.columns, "lm_own")
    own = own.toDF(lang, mine)
    judged = scored.join(own, F.col("lang").eqNullSafe(F.col(lang)), "left").withColumn("lm_threshold", F.coalesce(mine, F.lit(overall).cast("double")))
    judged = judged.withColumn("lm_kept", F.coalesce(F.col("lm_perplexity") <= F.col("lm_threshold"), F.lit(True)))
    return judged.select(*carry, *ADDED)
