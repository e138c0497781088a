"""Edges and clusters of hashes against all pairs, over several tiles."""

import random

from paperloom.operators import dedup

KIND = "id string, paper_id string, asset_type string, perceptual_hash string"


def hashes(n, digits, seed):
    rng = random.Random(seed)
    bases = [rng.getrandbits(4 * digits) for _ in range(6)]
    rows = []
    for i in range(n):
        value = rng.choice(bases)
        for _ in range(rng.choice((0, 0, 3, 12))):
            value ^= 1 << rng.randrange(4 * digits)
        rows.append((f"a{i:04d}", f"p{rng.randrange(3)}", rng.choice(("image", "table", None)), format(value, f"0{digits}x")))
    return rows


def all_edges(rows, most):
    far = lambda x, y: bin(int(x[3], 16) ^ int(y[3], 16)).count("1")
    pairs = [(x, y) for i, x in enumerate(rows) for y in rows[i + 1 :] if x[2] and x[2] == y[2] and x[1] != y[1]]
    return sorted((x[2], x[0], y[0], x[1], y[1], far(x, y)) for x, y in pairs if far(x, y) <= most)


def test_edges_over_many_tiles_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(dedup, "TILE", 16)
    for digits, most in ((16, 20), (16, 3), (24, 20), (8, 5)):
        rows = hashes(120, digits, digits + most)
        got = sorted(tuple(r) for r in dedup.hamming_edges(spark.createDataFrame(rows, KIND), most, digits).collect())
        assert got == all_edges(rows, most) and len(got) > 20


def test_a_type_is_not_one_key_of_the_join(spark):
    plan = dedup.hamming_edges(spark.createDataFrame(hashes(9, 16, 1), KIND), 20)._jdf.queryExecution().executedPlan().toString()
    met = [line for line in plan.splitlines() if "Join" in line and "bit_count" in line]
    assert len(met) == 1 and "lo#" in met[0] and "hi#" in met[0] and "substring" not in met[0]
