"""Blocks found by the tree are those of all pairs, and few pairs are looked at."""

import numpy as np
import pandas as pd

from paperloom.plans import best_blocks
from paperloom.plans.layout import owned


def made(seed, n, grid):
    rng = np.random.default_rng(seed)
    page, column = rng.integers(1, 6, n), rng.integers(0, 2, n)
    t1 = rng.integers(0, grid, n) / grid
    b = pd.DataFrame({"first_page": page, "last_page": page + (rng.random(n) < 0.02), "bc": column, "t1": t1, "t2": t1 + rng.integers(1, 9, n) / 100, "cue": (rng.random(n) < 0.3).astype(float)})
    b = b.sort_values(["first_page", "bc", "t1"]).reset_index(drop=True).assign(index=np.arange(n))
    m = 300
    x1, y1 = rng.integers(0, 10, m) / 20, rng.integers(0, grid, m) / grid
    shares = [None if r < 0.1 else np.array([r, 1 - r][: 1 + (r < 0.7)]) for r in rng.random(m)]
    q = pd.DataFrame({"page": rng.integers(1, 8, m), "x1": x1, "x2": x1 + rng.choice([0.2, 0.6], m), "y1": y1, "y2": y1 + rng.integers(1, 5, m) / 50, "col": rng.integers(0, 2, m)})
    q.loc[:4, "y1"], b.loc[b.index[::97], "t1"] = np.nan, np.nan
    return b, q.assign(shares=shares)


def brute(score, levels, n, floor):
    block = levels[0]
    every = np.array([score(np.full(len(block.index), i), block, np.arange(len(block.index))) for i in range(n)])
    order = [np.lexsort((block.index, -s)) for s in every]
    return [[block.index[j] if s[j] > floor else -1 for j in o[:2]] for o, s in zip(order, every, strict=True)]


def test_the_tree_finds_what_all_pairs_give():
    for seed, n, grid in ((1, 2000, 50), (2, 3000, 10**9), (3, 1, 50), (4, 40, 3)):
        b, q = made(seed, n, grid)
        levels = best_blocks.tree(b)
        for of, floor, two in ((best_blocks.asset_score, -1.0, True), (best_blocks.meeting_score, 0.0, False)):
            got, want = best_blocks.search(len(q), levels, of(q), floor, two), brute(of(q), levels, len(q), floor)
            for g, w in zip(got, want, strict=True):
                assert g[0] == w[0] and (not two or len(w) < 2 or g[1] == w[1])


def test_queries_are_split_when_many_pairs_stay(monkeypatch):
    b, q = made(5, 1500, 20)
    levels = best_blocks.tree(b)
    whole = best_blocks.search(len(q), levels, best_blocks.asset_score(q), -1.0, True)
    monkeypatch.setattr(best_blocks, "PAIRS", 64)
    assert (best_blocks.search(len(q), levels, best_blocks.asset_score(q), -1.0, True) == whole).all()


def test_few_pairs_are_looked_at():
    seen = []
    for n in (5_000, 40_000):
        b, q = made(6, n, 10**9)
        score, count = best_blocks.asset_score(q), [0]

        def counted(at, level, node, score=score, count=count):
            count[0] += len(at)
            return score(at, level, node)

        best_blocks.search(len(q), best_blocks.tree(b), counted, -1.0, True)
        seen.append(count[0] / len(q))
    assert seen[1] < 2_000 and seen[1] < 3 * seen[0]


def test_elements_are_not_paired_with_every_anchor(spark):
    bounds = spark.createDataFrame([], "paper_id string, index int, ro int, bound int, cross boolean, pages array<int>, page int, col int, eff int")
    rows = spark.createDataFrame([], "paper_id string, ro int, id string, page int, col int, x1 double, y1 double, x2 double, y2 double, text string, type string, header boolean, kind string, noise boolean")
    plan = owned(bounds, rows)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) <= 1 and all("ro#" in line and "paper_id#" in line for line in joins)
