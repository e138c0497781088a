"""Toxicity: a factorization machine over hashed terms, learning pairs such as an insult with a group."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import hash_share

BUCKETS = 1 << 18
#: Labelled rows that the machine is fitted on, at most (about; a hash picks them where there are more).
TRAIN_ROWS = 20_000
#: A term counts if this many training rows hold it and its share of toxic ones is off by so many standard
#: deviations; at most so many terms do, the most telling ones.
LEAST_ROWS, LEAST_TELLING, TERMS = 4, 2.0, 4096
#: Terms that tell only in a pair are looked for among the FREQUENT most frequent ones: the pair has to be off by
#: LEAST_PAIR standard deviations, and by half more than either term alone. Their factors start this wide.
FREQUENT, LEAST_PAIR, PAIR_TERMS, PAIR_START = 2048, 6.0, 512, 0.6
FACTORS = 8
EPOCHS = 16
#: Beginnings of words that are terms too, so that inflected and compound words share what is learned.
PREFIXES = (4, 5, 6, 7, 8)
_PUNCTUATION = str.maketrans({c: " " for c in ".,;:!?()[]{}<>*#$%&|_~\"`\n\t\r\x0b\x0c"})
#: Words whose terms one worker keeps.
_KEPT_WORDS = 300_000


def words(text: str | None) -> set[str]:
    """The distinct words of a text in lower case, without punctuation."""
    return set((text or "").lower().translate(_PUNCTUATION).split())


def word_terms(word: str) -> list[int]:
    """Hashed terms of a word: itself and its beginnings."""
    parts = [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts]


def terms(text: str | None) -> Counter:
    """The hashed terms of a text, each with the number of distinct words that have it."""
    return Counter(t for w in words(text) for t in word_terms(w))


def _value(count: np.ndarray) -> np.ndarray:
    """What a term counts for in a document that has so many words of it."""
    return np.log2(1.0 + count)


@dataclass
class FactorizationMachine:
    """Logistic factorization machine over terms' values; ``slot`` maps a bucket to its term or -1."""

    slot: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def logits(self, who: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of ``n`` documents before squashing, given the document, term and value of each entry in order
        of documents; also each entry's weighted factors and each document's sums of them."""
        vx = self.factor[at] * x[:, None]
        sums = np.zeros((n, FACTORS))
        if len(who):
            first = np.flatnonzero(np.diff(who, prepend=-1))
            sums[who[first]] = np.add.reduceat(vx, first, axis=0)
        z = self.bias + np.bincount(who, self.weight[at] * x - 0.5 * (vx * vx).sum(axis=1), n) + 0.5 * (sums * sums).sum(axis=1)
        return z, vx, sums

    def scores(self, texts: list[str | None], kept: dict[str, tuple[int, ...]]) -> np.ndarray:
        """Probability of label 1 for each text; ``kept`` remembers words from call to call."""
        if len(kept) > _KEPT_WORDS:
            kept.clear()
        who, found = [], []
        for text in texts:
            before = len(found)
            for word in words(text):
                known = kept.get(word)
                if known is None:
                    known = kept[word] = tuple(s for s in self.slot[word_terms(word)].tolist() if s >= 0)
                if known:
                    found.extend(known)
            who.append(len(found) - before)
        key = np.repeat(np.arange(len(texts)), who) * len(self.weight) + np.array(found, np.int64)
        key, count = np.unique(key, return_counts=True)
        z, _, _ = self.logits(key // len(self.weight), key % len(self.weight), _value(count), len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _telling(n: np.ndarray, ones: np.ndarray, share: float) -> np.ndarray:
    """How many standard deviations the label's count among the rows of a term is off; 0 for rare ones."""
    expected = n * share
    return np.where(n >= LEAST_ROWS, np.abs(ones - expected) / np.sqrt(expected * (1 - share) + 1), 0)


def _tell_in_pairs(flat: np.ndarray, lengths: np.ndarray, y: np.ndarray, n: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Frequent terms that tell more beside another one than either does alone, whatever they tell alone."""
    often = np.argsort(-n, kind="stable")[:FREQUENT]
    often = often[n[often] >= LEAST_ROWS]
    place = np.full(BUCKETS, -1, np.int32)
    place[often] = np.arange(len(often), dtype=np.int32)
    both, ones = np.zeros((2, len(often), len(often)), np.float32)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for at in range(0, len(y), 1024):
        some = place[flat[ends[at] : ends[min(at + 1024, len(y))]]]
        who = np.repeat(np.arange(len(lengths[at : at + 1024])), lengths[at : at + 1024])[some >= 0]
        held = np.zeros((len(lengths[at : at + 1024]), len(often)), np.float32)
        held[who, some[some >= 0]] = 1
        both += held.T @ held
        toxic = held[y[at : at + 1024] > 0]
        ones += toxic.T @ toxic
    z = _telling(both, ones, y.mean())
    z[z <= 1.5 * np.maximum(alone[often][:, None], alone[often][None, :])] = 0
    np.fill_diagonal(z, 0)
    best = z.max(axis=1, initial=0)
    order = np.argsort(-best, kind="stable")[:PAIR_TERMS]
    return often[order[best[order] > LEAST_PAIR]]


def fit(flat: np.ndarray, counts: np.ndarray, lengths: np.ndarray, labels: np.ndarray, seed: int = 5) -> FactorizationMachine:
    """Fit by AdaGrad on the logistic loss, the rarer label weighing more.

    ``flat`` holds the rows' buckets one after another, ``counts`` their words,
    ``lengths`` their numbers. Without rows of both labels the score is constant.
    """
    y = np.asarray(labels, np.float64)
    slot = np.full(BUCKETS, -1, np.int32)
    share = (y.sum() + 0.5) / (len(y) + 1)
    machine = FactorizationMachine(slot, math.log(share / (1 - share)), np.zeros(1), np.zeros((1, FACTORS)))
    if not len(y) or y.min() == y.max():
        return machine
    n = np.bincount(flat, minlength=BUCKETS)
    alone = _telling(n, np.bincount(flat[np.repeat(y > 0, lengths)], minlength=BUCKETS), y.mean())
    best = np.argsort(-alone, kind="stable")[:TERMS]
    in_pairs = _tell_in_pairs(flat, lengths, y, n, alone)
    best = np.union1d(best[alone[best] > LEAST_TELLING], in_pairs)
    slot[best] = np.arange(len(best), dtype=np.int32)
    known = slot[flat]
    owner = np.repeat(np.arange(len(y), dtype=np.int32), lengths)[known >= 0]
    x, known = _value(counts[known >= 0]), known[known >= 0]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(y)))])
    weigh = np.where(y > 0, math.sqrt((len(y) - y.sum()) / y.sum()), 1.0)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(best) + 1), rng.normal(0, 0.02, (len(best) + 1, FACTORS))
    v[slot[in_pairs]] *= PAIR_START / 0.02
    machine.weight, machine.factor = w, v
    gw, gv, gb = np.full(w.shape, 1e-2), np.full(v.shape, 1e-2), 1e-2
    l2 = 1e-4
    for epoch in range(EPOCHS):
        rate = 0.15 / (1 + epoch / 4)
        order = rng.permutation(len(y))
        for at in range(0, len(order), 128):
            some = order[at : at + 128]
            entries = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in some])
            who = np.repeat(np.arange(len(some)), ends[some + 1] - ends[some])
            idx, xi = known[entries], x[entries]
            z, vx, sums = machine.logits(who, idx, xi, len(some))
            g = weigh[some] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            uniq, inv = np.unique(idx, return_inverse=True)
            gx = g[who] * xi
            dw = np.bincount(inv, gx, len(uniq)) + l2 * w[uniq]
            dv = l2 * v[uniq]
            np.add.at(dv, inv, gx[:, None] * (sums[who] - vx))
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            gb += g.sum() ** 2
            w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            v[uniq] -= 0.3 * rate * dv / np.sqrt(gv[uniq])
            machine.bias -= rate * float(g.sum()) / math.sqrt(gb)
    return machine


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed terms (one after another, with their words and numbers) and labels of the labelled rows outside the held-out fold, about ``bound`` at most.

    A doc_id that carries both labels counts as toxic. Rows are in the order of their ids.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(~held_out(F.col("doc_id")))
    marked = marked.where(hash_share(F.col("doc_id"), bound, marked.count(), 5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.int32()), pa.list_(pa.int16())
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [sorted(terms(x).items()) for x in batch.column("text").to_pylist()]
                own = [pa.array([[min(t[k], 32_767) if k else t[k] for t in row] for row in found], kinds[k]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *own], ["doc_id", "toxic", "terms", "counts"])

    # About ``bound`` ids: rows that share one count once, by the least of their texts.
    chosen = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = chosen.mapInArrow(run, "doc_id long, toxic int, terms array<int>, counts array<short>").toArrow()
    order = pa.array(np.argsort(rows.column("doc_id").to_numpy(), kind="stable"))
    found, counts = (rows.column(c).combine_chunks().take(order) for c in ("terms", "counts"))
    return found.flatten().to_numpy(), counts.flatten().to_numpy(), np.diff(found.offsets.to_numpy()), rows.column("toxic").to_numpy()[order]


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """``(doc_id, score)`` of every row; null and empty texts get the score of no terms."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[int, ...]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = shared.value.scores(batch.column("text").to_pylist(), kept)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs(doc_id, text)``.

    Only ``labels(doc_id, toxic)`` of the learning fold are used. Rows with a
    null doc_id are scored and not held out; repeated rows are scored alike;
    without labels every score is one half. Other columns are ignored; an empty
    table gives no rows. Texts are scored whole, whatever their length.
    """
    scored = score(docs, fit(*training_rows(docs, labels)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
