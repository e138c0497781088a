import random
import re

import pytest
import xxhash

from paperloom.llm import simhash_dedup as S
from paperloom.operators import graph
from tests.llm.cases import docs, no_docs, odd_docs, prose


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(fps):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if j < i and bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [r[1] for r in odd_docs()] + ["A b C", "É É É x"])
def test_fingerprint(text):
    assert S.simhash(None if text is None else text.encode()) == plain_fingerprint(text)


def test_long_text_is_counted_in_blocks(monkeypatch):
    text = prose(7, 500)
    whole = S.simhash(text.encode())
    monkeypatch.setattr(S, "_BLOCK", 7)
    assert S.simhash(text.encode()) == whole


def near_rows():
    rng = random.Random(3)
    rows = []
    for base in range(12):
        words = prose(base, 300).split()
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
    return rows


def test_components_are_those_of_all_pairs(spark):
    rows = near_rows() + [(100, None, "en", "a", 0), (101, "", "en", "a", 0), (102, "  ", "en", "a", 0)]
    want = plain_components({r[0]: plain_fingerprint(r[1]) for r in rows})
    got = S.near_duplicates(docs(spark, rows, clash=("fp", "node", "fingerprint", "component_id"))).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(want)
    assert all(r.fingerprint == format(plain_fingerprint(dict((x[0], x[1]) for x in rows)[r.doc_id]), "016x") for r in got)


def test_links_lose_no_component(spark):
    rng = random.Random(5)
    fps = {}
    for seed in (rng.getrandbits(64) for _ in range(20)):
        x = seed
        for _ in range(6):
            fps[len(fps)] = x
            x ^= 1 << rng.randrange(64)
            x ^= (1 << rng.randrange(64)) * rng.randint(0, 1)
    unique = {f: n for n, f in sorted(fps.items(), reverse=True)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(f), n) for f, n in unique.items()], "fp long, node long")
    label = {r.node: r.label for r in graph.components(S.links(nodes)).collect()}
    want = plain_components({n: f for f, n in unique.items()})
    assert {n: label.get(n, n) for n in want} == want
    with pytest.raises(ValueError):
        S.links(nodes, 3)


def test_odd_rows(spark):
    got = S.near_duplicates(docs(spark)).collect()
    assert len(got) == len(odd_docs())
    at = {r.doc_id: r.component_id for r in got}
    assert at[1] == at[2] == at[3] == 1 and at[4] == at[5] == at[6] == 4 and at[None] is None
    assert S.near_duplicates(no_docs(spark)).collect() == []


def test_one_of_each(spark):
    kept = S.one_of_each(docs(spark, clash=("_n", "fp", "sd_file", "SD_ROW", "_id", "_stay", "lm_block")))
    got = kept.collect()
    assert kept.columns == [*docs(spark).columns, "_n", "fp", "sd_file", "SD_ROW", "_id", "_stay", "lm_block"]
    ids = sorted((r.doc_id for r in got), key=lambda x: (x is None, x))
    want = plain_components({r[0]: plain_fingerprint(r[1]) for r in odd_docs() if r[0] is not None})
    assert ids == sorted(set(want.values())) + [None]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200), (201, 202), (202, 201)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}, 202: 201}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_without_or_with_a_shared_id_stay(spark):
    a, b, c, d = (prose(i, 80) for i in range(20, 24))
    rows = [(None, a, "en", "a", 0), (None, b, "en", "a", 0), (None, b, "en", "b", 0), (1, c, "en", "a", 0), (1, d, "en", "a", 0), (None, c, "en", "a", 0)]
    got = [(r.doc_id, r.text) for r in S.one_of_each(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (1, c), (1, d)], key=str)


def test_one_row_of_each_component_whatever_the_ids(spark):
    """Against brute force: the number of rows is that of the components of the rows' fingerprints."""
    rng = random.Random(12)
    rows = [(rng.choice((None, None, 5, i)), t, "en", "a", 0) for i, t in enumerate([r[1] for r in near_rows()] + [prose(i, 60) for i in range(300, 312)] * 2 + [None, "", None])]
    label = plain_components({n: plain_fingerprint(r[1]) for n, r in enumerate(rows)})
    got = S.one_of_each(docs(spark, rows).repartition(5)).collect()
    assert len(got) == len(set(label.values()))
    of_text = {r[1]: label[n] for n, r in enumerate(rows)}
    assert sorted(of_text[r.text] for r in got) == sorted(set(label.values()))
    for r in got:
        ids = [x[0] for n, x in enumerate(rows) if label[n] == of_text[r.text] and x[0] is not None]
        assert r.doc_id == (min(ids) if ids else None)
    assert S.one_of_each(no_docs(spark)).collect() == []


def test_hubs_are_met_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(graph, "LEAST_HUB", 3)
    edges = [(0, i) for i in range(1, 200)] + [(i, i + 1000) for i in range(1, 200)] + [(5000 + i, 5001 + i) for i in range(9)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: 0 for i in range(1, 200) for n in (i, i + 1000)}, **{5001 + i: 5000 for i in range(9)}}
