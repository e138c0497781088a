import zlib
from collections import Counter

import pytest

from paperloom.llm import uniform_shards as U
from tests.llm.cases import docs, no_docs, odd_docs, prose


def test_matrix_has_the_given_sums():
    parts, shards = [5, 0, 17, 40, 1], [16, 16, 16, 15]
    for seed in range(30):
        m = U.communication_matrix(parts, shards, seed)
        assert [sum(r) for r in m] == parts and [sum(c) for c in zip(*m)] == shards and min(min(r) for r in m) >= 0


def test_draws_are_hypergeometric():
    import random
    from math import comb

    rng = random.Random(1)
    n = 20_000
    got = Counter(U._hypergeometric(rng, 7, 9, 6) for _ in range(n))
    for k in range(7):
        p = comb(7, k) * comb(9, 6 - k) / comb(16, 6)
        assert abs(got[k] / n - p) < 4 * (p * (1 - p) / n) ** 0.5 + 1e-3


@pytest.mark.parametrize("n", [1, 15, 16, 700])
def test_exact_sizes_and_gapless_slots(spark, monkeypatch, n):
    monkeypatch.setattr(U, "RANK_ROWS", 11)
    rows = [(i, prose(i % 3, 8), "en", "a", 0) for i in range(n)]
    got = U.shard(docs(spark, rows, clash=("shard", "_bin", "k1", "rid"))).collect()
    sizes = Counter(r.shard for r in got)
    assert sorted(r.doc_id for r in got) == list(range(n))
    assert max(sizes.values()) - (min(sizes.values()) if len(sizes) == 16 else 0) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    again = U.shard(docs(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_shuffle_is_even(spark):
    got = U.shard(docs(spark, [(i, "x", "en", "a", 0) for i in range(4000)])).collect()
    low = Counter(r.shard for r in got if r.doc_id < 2000)
    assert all(abs(low[s] - 125) < 45 for s in range(16))
    assert abs(sum(r.slot for r in got if r.doc_id < 2000) / 2000 - 124.5) < 6


def test_columns_of_odd_rows(spark):
    got = U.shard(docs(spark)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd_docs())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert U.shard(no_docs(spark)).collect() == []


def test_rows_equal_in_all_respects(spark):
    got = U.shard(docs(spark, [(1, "same", "en", "a", 4)] * 100)).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 100 and max(sizes.values()) - min(sizes.values()) <= 1
