"""Exact top-k search by inner product, by a three-phase uniform threshold over slices of the vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.scratch import stored

K = 5
#: Every list holds the scores over one slice of the components.
SLICES = 2
SCALE = 256
#: Vectors of a block of candidates and of queries; a task multiplies one of each.
CANDIDATE_BLOCK, QUERY_BLOCK = 8_192, 512
#: Candidates whose scores are in memory at once.
CHUNK = 2_048
#: Ways that the blocks of one length are dealt to before they are paired.
SALTS = 32
#: Blocks of queries whose best entries a task holds before it hands them on.
HELD_BLOCKS = 256
_LEAST = -(1 << 63)


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, row, v)`` with integer components, ``row`` telling rows apart; vectors that are null or hold a
    null or a non-finite component, or have no id, take no part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = wide.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~F.coalesce(F.exists("e", bad), F.lit(False)))
    return sound.select("vec_id", F.monotonically_increasing_id().alias("row"), F.transform("e", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors of one length: ids, rows and components as bytes, in the narrowest type that holds them."""
    pending: dict[int, list] = {}

    def block(n: int) -> pa.RecordBatch:
        ids, own, parts = zip(*pending.pop(n), strict=True)
        matrix = np.concatenate(parts)
        top = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)) - 1)
        kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
        cells = [pa.array([x], pa.binary()) for x in (np.concatenate(ids).astype("<i8").tobytes(), np.concatenate(own).astype("<i8").tobytes(), matrix.astype(kind).tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([kind]), *cells], ["dims", "kind", "ids", "own", "m"])

    for whole in batches:
        for at in range(0, whole.num_rows, min(rows, 1024)):
            batch = whole.slice(at, min(rows, 1024))
            lists = batch.column("v")
            edges = lists.offsets.to_numpy()
            lengths, flat, start = np.diff(edges), lists.flatten().to_numpy(), edges - edges[0]
            ids, own = batch.column("vec_id").to_numpy(), batch.column("row").to_numpy()
            for n in np.unique(lengths).tolist():
                some = np.flatnonzero(lengths == n)
                matrix = flat[start[some][:, None] + np.arange(n)].astype(np.int64).reshape(len(some), n)
                pending.setdefault(n, []).append((ids[some], own[some], matrix))
                if sum(len(x[0]) for x in pending[n]) + min(rows, 1024) > rows:
                    yield block(n)
    for n in list(pending):
        yield block(n)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """``(block, dims, kind, ids, own, m)``: the vectors in packed blocks of ``rows`` at most."""
    packed = vectors.mapInArrow(lambda b: _pack(b, rows), "dims int, kind string, ids binary, own binary, m binary")
    return packed.select(F.monotonically_increasing_id().alias("block"), "dims", "kind", "ids", "own", "m")


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; by floating point where no sum can leave the exact integers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if top < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def _parts(dims: int, slices: int) -> list[tuple[int, int]]:
    edge = [dims * s // slices for s in range(slices + 1)]
    return list(zip(edge, edge[1:], strict=False))


class _Best:
    """The ``k`` best entries so far of each query of a block: query row, candidate's id and row, score."""

    def __init__(self, k: int):
        self.k, self.entries = k, np.zeros((4, 0), np.int64)

    def add(self, *columns: np.ndarray) -> None:
        found = np.concatenate([self.entries, np.array(columns, np.int64)], axis=1)
        order = np.lexsort((found[2], found[1], -found[3], found[0]))  # by query; the greatest score, then the least id
        found = found[:, order]
        first = np.flatnonzero(np.diff(found[0], prepend=-1 if not found.size else found[0][0] - 1))
        place = np.arange(found.shape[1]) - np.repeat(first, np.diff(np.append(first, found.shape[1])))
        self.entries = found[:, place < self.k]


def _entries(k: int, slices: int, cut: bool):
    """For each pair of blocks, the entries that this phase collects; a task merges those of a query and keeps ``k``.

    Lists are the scores over one slice. Without a cutoff each list gives its
    ``k`` best; with one, all that reach an equal share of it in some list. Their
    full scores are resolved here, and only those that reach the cutoff leave.
    """

    def pair(row: dict, best: _Best) -> None:
        dims = row["dims"]
        read = lambda x: np.frombuffer(row[x], "<i8")
        own_q, ids, own = read("q_own"), read("ids"), read("own")
        q, all_c = (np.frombuffer(row[m], row[t]).reshape(len(n), dims) for m, t, n in (("q_m", "q_kind", own_q), ("m", "kind", own)))
        for at in range(0, len(own), CHUNK):
            c, c_ids, c_own = all_c[at : at + CHUNK], ids[at : at + CHUNK], own[at : at + CHUNK]
            parts = [_product(q[:, a:b], c[:, a:b]) for a, b in _parts(dims, slices)]
            other = own_q[:, None] != c_own[None, :]
            if cut:
                share, score, most = read("q_share")[:, None], read("q_cut"), read("q_id")
                wanted = other & np.logical_or.reduce([p >= share for p in parts])
            else:
                wanted = np.zeros_like(other)
                for p in parts:
                    ranked = np.where(other, p, np.iinfo(np.int64).min)
                    n = min(k, len(c_own))
                    top = np.argpartition(-ranked.astype(np.float64), n - 1, axis=1)[:, :n]
                    np.put_along_axis(wanted, top, True, axis=1)
                wanted &= other
            i, j = np.nonzero(wanted)
            full = sum((p[i, j] for p in parts), np.zeros(len(i), np.int64))
            if cut:  # the k-th best entry known, in order of score and then of the smaller id
                reach = (full > score[i]) | ((full == score[i]) & (c_ids[j] <= most[i]))
                i, j, full = i[reach], j[reach], full[reach]
            if len(i):
                best.add(own_q[i], c_ids[j], c_own[j], full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Best] = {}

        def out() -> pa.RecordBatch:
            found = np.concatenate([b.entries for b in held.values()], axis=1) if held else np.zeros((4, 0), np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query", "vec_id", "row", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                pair(row, held.setdefault(row["q_block"], _Best(k)))
                if len(held) > HELD_BLOCKS:
                    yield out()
        yield out()

    return run


_ENTRY = "query long, vec_id long, row long, score long"


def _pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every block of queries with every block of candidates of the same length, one row each, spread evenly.

    Numbers of blocks are paired first, dealt by salt; the vectors follow by number.
    """
    asked = queries.select(F.col("block").alias("q_block"), "dims", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    numbers = asked.join(candidates.select("block", "dims", F.pmod("block", F.lit(SALTS)).cast("int").alias("salt")), ["dims", "salt"]).select("q_block", "block")
    sent = numbers.join(queries.drop("dims").withColumnRenamed("block", "q_block"), "q_block")
    return sent.join(candidates, "block")


def _best(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, k: int = K, every: int = 50, slices: int = SLICES, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` candidates with the greatest integer inner products
    for each row of ``vectors(vec_id, embedding)`` whose id is divisible by ``every``.

    Phase one gathers, for each query, the ``k`` best of each block's lists and
    takes the ``k``-th best full score among them as the query's safe cutoff.
    Phase two sends the cutoff to all blocks, which collect every entry that
    reaches its share of it: a candidate that reaches the cutoff reaches the
    share in some slice. Phase three resolves their full scores where they are;
    those below the cutoff stay there, and the others are ranked.

    Ties go to the smaller vec_id. Every row but the query's own is a candidate:
    rows that share an id are queries and candidates one by one, and may be each
    other's. Vectors of another length than the query's are no candidates. Other
    columns are ignored; an empty table gives no rows.
    """
    ints = stored(quantized(vectors, scale), "topk-vectors")
    asked = ints.where(F.col("vec_id") % every == 0)
    candidates = stored(blocks(ints, CANDIDATE_BLOCK), "topk-blocks")
    ask = blocks(asked, QUERY_BLOCK).select("block", "dims", F.col("kind").alias("q_kind"), F.col("own").alias("q_own"), F.col("m").alias("q_m"))
    ask = stored(ask, "topk-queries")
    local = _pairs(ask, candidates).mapInArrow(_entries(k, slices, False), _ENTRY)
    known = stored(_best(local, k).where(F.col("rank") == k).select("query", "vec_id", "score"), "topk-cutoffs")
    told = _with_cutoffs(ask, known, slices)
    entries = _pairs(told, candidates).mapInArrow(_entries(k, slices, True), _ENTRY)
    names = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    best = _best(entries, k).join(names, "query")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score"))


def _with_cutoffs(ask: DataFrame, known: DataFrame, slices: int) -> DataFrame:
    """Blocks of queries with each query's cutoff (score and id) and its share for a slice; a query with fewer
    than ``k`` candidates takes everything."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own in zip(batch.column("block").to_pylist(), batch.column("q_own").to_pylist(), strict=True):
                rows = np.frombuffer(own, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), block)), pa.array(np.arange(len(rows))), pa.array(rows)], ["block", "at", "query"])

    placed = ask.select("block", "q_own").mapInArrow(rows_of, "block long, at long, query long").join(known, "query", "left")
    row = F.struct("at", F.coalesce("score", F.lit(_LEAST)).alias("score"), F.coalesce("vec_id", F.lit(-_LEAST - 1)).alias("id"))
    gathered = placed.groupBy("block").agg(F.array_sort(F.collect_list(row)).alias("rows"))  # QUERY_BLOCK rows at most

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = {"q_cut": [], "q_id": [], "q_share": []}
            for rows in batch.column("rows").to_pylist():
                score = np.array([r["score"] for r in rows], np.int64)
                # Rounded down, so that no entry is lost to rounding.
                for name, values in (("q_cut", score), ("q_id", np.array([r["id"] for r in rows], np.int64)), ("q_share", score // slices)):
                    cells[name].append(values.astype("<i8").tobytes())
            cells["q_share"] = [np.where(np.frombuffer(c, "<i8") == _LEAST, _LEAST, np.frombuffer(s, "<i8")).tobytes() for c, s in zip(cells["q_cut"], cells["q_share"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("block"), *[pa.array(v, pa.binary()) for v in cells.values()]], ["block", *cells])

    return ask.join(gathered.mapInArrow(packed, "block long, q_cut binary, q_id binary, q_share binary"), "block")
