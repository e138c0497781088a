import math
from collections import Counter, defaultdict

import pytest

from paperloom.llm import quality_lm as Q
from tests.llm.cases import docs, no_docs, prose

LABELS = "doc_id long, quality int, toxic int"


def brute(trusted, text):
    """Perplexity by the textbook recursion over plain dictionaries."""
    pad = lambda t: [0] * (Q.ORDER - 1) + [max(ord(c), 1) for c in t] + [1]
    counts = {Q.ORDER: Counter()}
    for t in trusted:
        s = pad(t)
        counts[Q.ORDER].update(tuple(s[i : i + Q.ORDER]) for i in range(len(s) - Q.ORDER + 1))
    for k in range(Q.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, total, off = {}, {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        cut[k] = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) if n[i - 1] and n[i] else 0.5 for i in (1, 2, 3)]
        total[k], off[k] = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[k][g[:-1]] += v
            off[k][g[:-1]] += cut[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1.0 / (1 << Q.SYMBOL_BITS)
        k, h = len(g), g[:-1]
        below = p(g[1:])
        if not total[k][h]:
            return below
        c = counts[k].get(g, 0)
        own = (c - cut[k][min(c, 3) - 1]) / total[k][h] if c else 0.0
        return own + off[k][h] / total[k][h] * below

    s = pad(text)
    logs = [math.log(p(tuple(s[i : i + Q.ORDER]))) for i in range(len(s) - Q.ORDER + 1)]
    return math.exp(-sum(logs) / len(logs))


def test_perplexity_is_the_textbook_one(spark):
    trusted = [prose(i, 60) for i in range(6)]
    asked = [prose(99, 40), "### $$$", "", None, trusted[0]]
    model = Q.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    found = Q.score(docs(spark, [(i, t, "en", "a", 0) for i, t in enumerate(asked)]), model)
    got = {r.doc_id: r.lm_perplexity for r in found.collect()}
    for i, t in enumerate(asked):
        assert got[i] == pytest.approx(brute(trusted, t or ""), rel=1e-9)


def test_probabilities_of_a_context_sum_to_one(spark):
    model = Q.train(spark.createDataFrame([(prose(i, 40),) for i in range(3)], "text string"))
    context = next(Q.ngrams("the"))[3] & ~((1 << Q.SYMBOL_BITS) - 1)
    keys = spark.range(1 << Q.SYMBOL_BITS).selectExpr(f"id + {int(context)}L AS key")
    total = Q.log_probabilities(keys, model).selectExpr("sum(exp(logp)) AS s").first().s
    assert total == pytest.approx(1.0, abs=1e-6)


def test_odd_rows_stay_and_junk_goes(spark):
    rows = [(i, prose(i, 100), "en", "a", 0) for i in range(300)] + [(900, "#### $$$$ %%%% &&&&" * 20, "en", "a", 0), (901, None, None, None, None), (902, "", "en", None, 0), (903, prose(3, 20_000), "fr", "b", 0), (5, prose(5, 100), "en", "a", 0)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(250)] + [(None, 1, 0), (3, 1, 1)], LABELS)
    judged = Q.classify(docs(spark, rows, clash=("lm_kept", "key", "block", "c", "rows", "lm_block", "lm_own", "lm_lang", "LM_Held", "lm_file", "lm_row", "lm_text")), labels)
    assert judged.columns[-4:] == list(Q.ADDED)
    got = judged.collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.lm_kept}
    assert 900 not in kept and 903 in kept and len(kept & set(range(300))) >= 297


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert all(r.lm_kept and r.lm_threshold is None for r in Q.classify(docs(spark), none).collect())
    assert Q.classify(no_docs(spark), none).collect() == []


def test_all_trusted_rows_count(spark):
    labels = spark.range(200_500).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert Q.trusted_ids(labels).count() == 200_500


def test_runs_and_blocks_do_not_matter(monkeypatch):
    import numpy as np
    import pyarrow as pa

    texts = [prose(i, 40) for i in range(12)] + ["", None, "x", "é" * 50]
    whole = [np.concatenate(list(Q.ngrams(t or ""))) for t in texts]
    monkeypatch.setattr(Q, "RUN_CHARS", 7)
    monkeypatch.setattr(Q, "HELD_KEYS", 60)
    assert all(np.array_equal(np.concatenate(list(Q.ngrams(t or ""))), w) for t, w in zip(texts, whole))
    runs = list(Q._runs(texts))
    assert max(len(k) for k, _ in runs) <= 7
    keys, owner = (np.concatenate(x) for x in zip(*runs))
    assert all(np.array_equal(keys[owner == i], w) for i, w in enumerate(whole))
    blocks = [i % 3 for i in range(len(texts))]
    head = np.unique(np.concatenate(whole))[::3]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(blocks, pa.int64())], ["text", "b"])
    got = [(b, k) for out in Q._wanted(iter([batch]), head) for b, k in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
    assert set(got) == {(b, int(k)) for b, w in zip(blocks, whole) for k in w if k not in head}


def test_blocks_are_bounded_by_characters(spark):
    from pyspark.sql import functions as F

    lengths = [10, 8_000, 65_536, 65_537, 200_000, 300_000, 40_000_000, 100_000_000]
    rows = spark.range(2048 * 3).crossJoin(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "i long, n long")).selectExpr("id * 8 + i AS id", "n")
    # The length is given instead of a text of that length.
    monkey = F.length
    try:
        F.length = lambda c: c
        found = rows.select("n", Q._block(F.lit(1), F.col("id"), F.col("n")).alias("b"))
    finally:
        F.length = monkey
    per = found.groupBy("b").agg(F.sum("n").alias("chars"), F.count("*").alias("rows"), F.min("n").alias("n")).collect()
    assert all(r.chars <= Q.BLOCK_ROWS * Q.BLOCK_CHARS or r.rows == 1 for r in per)


def test_thresholds_are_those_of_brute_force(spark):
    import random

    rng = random.Random(2)
    rows = [(lang, math.exp(rng.gauss(m, 0.1))) for lang, m, n in (("en", 1.5, 600), ("de", 1.7, 40), (None, 2.0, 3)) for _ in range(n)]
    own, overall = Q.thresholds(spark.createDataFrame(rows, "lang string, lm_perplexity double"), 0.9)
    # percentile_approx takes the least value that this share of all values does not exceed.
    at = lambda xs, q: sorted(xs)[max(math.ceil(q * len(xs)) - 1, 0)]
    logs = {k: [math.log(p) for x, p in rows if x == k] for k in ("en", "de", None)}
    median = {k: at(v, 0.5) for k, v in logs.items()}
    spread = at([x - median[k] for k, v in logs.items() for x in v], 0.9)
    for r in own.collect():
        n, v = len(logs[r.lm_lang]), logs[r.lm_lang]
        want = median[r.lm_lang] + (n * (at(v, 0.9) - median[r.lm_lang]) + Q.SHARED_WEIGHT * spread) / (n + Q.SHARED_WEIGHT)
        assert math.log(r.lm_own) == pytest.approx(want, abs=1e-9)
    assert math.log(overall) == pytest.approx(at([x for v in logs.values() for x in v], 0.9), abs=1e-9)


def test_low_quality_goes_and_good_stays(spark):
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    got = Q.classify(spark.read.parquet(f"{at}/documents.parquet"), labels, carry=["doc_id", "lang"]).join(labels, "doc_id").collect()
    good, bad = [r.lm_kept for r in got if r.quality == 1], [r.lm_kept for r in got if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_the_head_does_not_matter(spark, monkeypatch):
    trusted = spark.createDataFrame([(prose(i, 60),) for i in range(6)], "text string")
    asked = docs(spark, [(i, prose(90 + i, 40), "en", "a", 0) for i in range(5)] + [(9, None, "en", "a", 0)])
    found = []
    for size in (1, 40, Q.HEAD):
        monkeypatch.setattr(Q, "HEAD", size)
        model = Q.train(trusted)
        assert len(model.head[0]) <= size
        found.append({r.doc_id: r.lm_perplexity for r in Q.score(asked, model).collect()})
    assert found[0] == pytest.approx(found[1], rel=1e-12) and found[0] == pytest.approx(found[2], rel=1e-12)
