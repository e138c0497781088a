"""Greedy clusters without a component's edges in one task."""

from paperloom.operators import dedup
from tests.test_near_hashes import KIND, all_edges, hashes


def greedy(rows, most):
    at, groups, paper = {}, [], {r[0]: r[1] for r in rows}
    for kind, x, y, _, _, d in sorted(all_edges(rows, most), key=lambda e: (e[0], e[5], e[1], e[2])):
        if x in at and y in at:
            continue
        g = at.get(x) or at.get(y)
        if g is None:
            g = (kind, set(), [])
            groups.append(g)
        g[1].update((x, y))
        at[x] = at[y] = g
        g[2].append(d)
    return sorted((k, tuple(sorted(m)), min(d), max(d), round(sum(d) / len(d), 9)) for k, m, d in groups if len({paper[x] for x in m}) >= 2)


def test_clusters_are_those_of_one_pass_with_copies_and_one_component(spark, monkeypatch):
    monkeypatch.setattr(dedup, "TILE", 16)
    rows = hashes(150, 16, 4)
    made = dedup.visual_groups(spark.createDataFrame(rows, KIND), 30)
    got = sorted((r.asset_type, tuple(r.members), r.min_distance, r.max_distance, round(r.avg_distance, 9)) for r in made.collect())
    assert got == greedy(rows, 30) and any(g[3] > 0 for g in got)
    assert "InPandas" not in made._jdf.queryExecution().executedPlan().toString()
