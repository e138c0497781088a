from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import source_mix as M
from tests.llm.cases import docs, no_docs, odd_docs, prose


def plain_targets(by_source, weights=M.WEIGHTS, share=M.SHARE, most=M.MOST_COPIES):
    """Rounds of dealing: whoever is full stops, the rest is dealt anew."""
    ordered = sorted(by_source, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    size = dict(ordered)
    left, open_, found = share * sum(size.values()), list(size), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > most * size[s]]
        if not full:
            return found | {s: weight[s] * unit for s in open_}
        for s in full:
            found[s] = float(most * size[s])
            left -= found[s]
        open_ = [s for s in open_ if s not in full]
    return found


def plain_odds(sizes, rest):
    """Inclusion probabilities in proportion to size, certain ones set aside one after the other."""
    certain = set()
    while True:
        left = rest - sum(sizes[i] for i in certain)
        squares = sum(s * s for i, s in enumerate(sizes) if i not in certain)
        odds = [1.0 if i in certain else left * s / squares if squares else 0.0 for i, s in enumerate(sizes)]
        above = [i for i, p in enumerate(odds) if p > 1 + 1e-12]
        if not above:
            return odds
        certain.add(max(above, key=lambda i: sizes[i]))


def plain_mix(rows):
    """Copies of each of ``rows(key, source, size, u)``."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    goal = plain_targets([(s, sum(r[2] for r in of)) for s, of in by.items()])
    out = {}
    for s, of in by.items():
        total = sum(r[2] for r in of)
        whole = min(int(goal[s] / total + 1e-12), 2) if total else 0
        rest, used = goal[s] - whole * total, 0
        odds = plain_odds([r[2] for r in of], rest)
        ratio = lambda r, p: 0.0 if p >= 1 else (r[3] / (1 - r[3])) / (p / (1 - p)) if p > 0 else float("inf")
        for _, r in sorted((ratio(r, p), r) for r, p in zip(of, odds)):
            out[r[0]] = whole
            if r[2] and whole < 2 and used + r[2] / 2 <= rest:
                out[r[0]] += 1
            used += r[2]
    return out, goal


@pytest.mark.parametrize("sizes", [[("b", 100), ("a", 1000), (None, 10), ("c", 1000)], [("a", 0)], [("x", 5), ("y", 0), (None, 7)], [(f"s{i:02d}", (i * 37) % 101 * 9) for i in range(40)]])
def test_targets_fill_up_by_weight(spark, sizes):
    got = {r.source: r.target for r in M.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9) for s in want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(n for _, n in sizes))


def mixed_rows(n=600):
    return [(i, prose(i, 5 + (i * i) % 150), "en", "abcd"[min(i % 6, 3)], 0) for i in range(n)] + [(n, prose(n, 5_000), "en", "a", 0), (n + 1, prose(n, 30), "en", None, 0), (n + 2, "", "en", "b", 0)]


def with_numbers(frame):
    names = M._names([])
    slim = M._rows(frame, names)
    return [(r.doc_id, r[names["source"]], r[names["size"]], r[names["u"]]) for r in slim.select("doc_id", names["source"], names["size"], names["u"]).collect()]


def test_selection_is_that_of_brute_force(spark):
    frame = docs(spark, mixed_rows(), clash=("size", "bin", "u", "target", "tie", "rank", "mix_u", "MIX_plan"))
    got = M.mix(frame).collect()
    again = M.mix(frame.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    copies, goal = plain_mix(with_numbers(frame))
    assert {r.doc_id: r.copies for r in got} == copies
    assert 0 < len({c for c in copies.values()}) <= 3
    source = {r[0]: r[3] for r in mixed_rows()}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"] and r.target == pytest.approx(goal[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6 for s in goal)


def test_inclusion_follows_the_odds(spark, monkeypatch):
    """Over many seeds each document is taken once more about as often as its length asks for."""
    rows = [(i, prose(1, (4, 8, 16, 32)[i % 4]), "en", "a" if i < 80 else "b", 0) for i in range(100)]
    seen, rounds = defaultdict(int), 30
    for seed in range(rounds):
        monkeypatch.setattr(M, "_SEED", seed)
        for r in M.mix(docs(spark, rows)).collect():
            seen[r.doc_id] += r.copies
    copies, goal = plain_mix(with_numbers(docs(spark, rows)))
    sizes = [len(rows[i][1].split()) for i in range(80)]
    whole = int(goal["a"] / sum(sizes))
    odds = plain_odds(sizes, goal["a"] - whole * sum(sizes))
    for length in (4, 8, 16, 32):
        of = [i for i in range(80) if sizes[i] == length]
        want, got = odds[of[0]], sum(seen[i] for i in of) / len(of) / rounds - whole
        assert abs(got - want) < 4 * (want * (1 - want) / len(of) / rounds) ** 0.5 + 0.03, (length, want, got)
    assert len({round(p, 6) for p in odds}) == 4


def test_odd_rows_and_materialized(spark):
    clash = ("copies", "_n", "_id", "n", "mix_copies", "plan", "Mix_Tie")
    frame = docs(spark, clash=clash)
    got = M.mix(frame).collect()
    assert len(got) == len(odd_docs()) and all(r.taken == 0 for r in got if r["size"] == 0)
    copied = M.materialize(frame)
    assert copied.columns == frame.columns and copied.count() == sum(r.copies for r in got)
    assert M.mix(no_docs(spark)).collect() == [] and M.materialize(no_docs(spark)).collect() == []


def test_rows_without_ids_are_copied_one_by_one(spark):
    rows = [(None, prose(i, 50), "en", "a", 0) for i in range(20)] + [(7, prose(i, 50), "en", "a", 0) for i in range(20)] + [(8, prose(99, 50), "en", "a", 0)] * 20
    frame = docs(spark, rows)
    mixed, copied = M.mix(frame), M.materialize(frame)
    words = F.size(F.split("text", " "))
    assert copied.agg(F.sum(words)).first()[0] == mixed.agg(F.sum("taken")).first()[0] == 4500
    assert copied.groupBy("doc_id", "text").count().where("count > 40").count() == 0
