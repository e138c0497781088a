import math

import numpy as np
import pytest

from paperloom.llm import topk_search as T

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), j) for m, (j, c) in enumerate(ok) if m != n and len(c) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "'mine' AS score", "1 AS block", "2 AS rank", "3 AS query", "'x' AS row")
    return sorted(tuple(r) for r in T.search(frame, **options).collect())


def test_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(T, "CANDIDATE_BLOCK", 32)
    monkeypatch.setattr(T, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    assert run(spark, rows, every=10) == plain(rows, every=10)
    assert run(spark, rows, every=10, slices=3, k=7) == plain(rows, 7, 10)


def test_ties_negatives_and_repeats(spark):
    rows = [(i, [float(i % 3), 1.0, -2.0]) for i in range(60)] + [(i, [-5.0, -5.0, -5.0]) for i in range(60, 70)] + [(3, [0.0, 1.0, -2.0]), (0, [9.0, 9.0, 9.0])]
    assert run(spark, rows) == plain(rows)
    low = [(0, [1.0, 1.0])] + [(i, [-float(i), -1.0]) for i in range(1, 20)]
    assert run(spark, low) == plain(low)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [None, 1.0]), (1, [math.nan, 1.0]), (2, [math.inf, 1.0]), (None, [1.0, 1.0]), (3, [0.5, 0.5]), (4, [1.0, 2.0, 3.0]), (150, []), (7, []), (200, [1e6, -1e6])]
    assert run(spark, rows) == plain(rows)


def test_few_rows(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []
    rows = [(0, [1.0]), (50, [2.0]), (3, [3.0])]
    assert run(spark, rows) == plain(rows)


def test_many_equal_vectors_and_shared_ids(spark, monkeypatch):
    """A third of the rows are one vector, one id is on many rows: no list grows with them and none is lost."""
    monkeypatch.setattr(T, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(T, "CHUNK", 16)
    monkeypatch.setattr(T, "HELD_BLOCKS", 1)
    monkeypatch.setattr(T, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(3)
    rows = [(i, [0.5, 0.25, -1.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(240)] + [(20, [3.0, float(i % 2), 0.0]) for i in range(30)]
    assert run(spark, rows, every=10) == plain(rows, every=10)


def test_only_entries_that_reach_the_cutoff_leave(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([(i, rng.normal(size=16).tolist()) for i in range(3000)], "vec_id long, embedding array<double>")
    ints = T.quantized(frame)
    ask = T.blocks(ints.where("vec_id % 50 = 0"), T.QUERY_BLOCK).select("block", "dims", F.col("kind").alias("q_kind"), F.col("own").alias("q_own"), F.col("m").alias("q_m"))
    local = T._pairs(ask, T.blocks(ints, T.CANDIDATE_BLOCK)).mapInArrow(T._entries(5, 2, False), T._ENTRY)
    assert local.count() <= 60 * 5 * 4 * 2


def test_products_beyond_floating_point():
    q = np.array([[2**40 + 1, 3]], np.int64)
    c = np.array([[2**20 + 1, 5]], np.int64)
    assert T._product(q, c)[0, 0] == (2**40 + 1) * (2**20 + 1) + 15


@pytest.mark.parametrize("dims,slices", [(64, 2), (3, 2), (1, 2), (0, 2)])
def test_slices_cover_all_components(dims, slices):
    assert [i for a, b in T._parts(dims, slices) for i in range(a, b)] == list(range(dims))
