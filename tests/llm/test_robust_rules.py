import re
from collections import Counter

import numpy as np
import pytest

from paperloom.llm import robust_rules as R
from tests.llm.cases import docs, no_docs, odd_docs, prose

LINES = "a b c\n a b c\na b c\n\n \nx # $y |\nA b c a b c"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    rows = odd_docs() + [(50, LINES, "en", "a", 0), (51, "x y z " * 200, "en", "a", 0), (52, "x x x x", "en", "a", 0), (53, "\x0b a\x0cb\x85c d ", "en", "a", 0), (54, prose(8, 400) + " " + prose(8, 30), "en", "a", 0)]
    got = R.statistics(docs(spark, rows, clash=("w", "l", "n_words"))).collect()
    found = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    assert found == sorted(str((r[0], *plain(r[1]))) for r in rows)


def many(n=400):
    rows = [(i, prose(i, 60 + i % 90), "en", "ab"[i % 2], 0) for i in range(n)]
    junk = [(1000 + i, " ".join(w + "###" for w in prose(i, 80).split()), "en", "a", 0) for i in range(20)]
    loud = [(2000 + i, prose(i, 80).upper(), "en", "b", 0) for i in range(20)]
    return rows, junk + loud


def test_outliers_go_and_the_rest_stays(spark):
    good, bad = many()
    short = [(3000, "too short", "en", "a", 0), (3001, None, None, None, None), (3002, "the same words " * 60, "en", "a", 0)]
    got = {r.doc_id: r for r in R.classify(docs(spark, good + bad + short, clash=("g", "d2", "kept"))).collect()}
    assert sum(got[r[0]].kept for r in good) >= 398
    assert not any(got[r[0]].kept for r in bad)
    assert all(got[i].base_failed and not got[i].kept for i in (3000, 3001, 3002))
    assert got[0].group == "=en/=a" and got[3001].group == "all"


def test_distance_is_mahalanobis(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(5, 5))
    x = rng.normal(size=(500, 5)) @ mix
    rows = spark.createDataFrame([("a", *map(float, r)) for r in x], ["g", *R.FEATURES])
    found = R._whitened(R._moments(rows, 5), 5)
    got = [r.d for r in rows.join(found, "g").select(R._distance(5).alias("d")).collect()]
    cov = R.CONSISTENCY * np.cov(x.T, bias=True) + np.diag(np.square(R.FLOORS))
    c = x - x.mean(axis=0)
    want = np.einsum("ij,jk,ik->i", c, np.linalg.inv(cov), c)
    assert sorted(got) == pytest.approx(sorted(want))


def test_estimates_resist_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.3, (800, 5)), rng.normal(9, 0.3, (200, 5))])
    rows = spark.createDataFrame([("a", *map(float, r)) for r in x], ["g", *R.FEATURES])
    found = R.estimates(rows).first()
    assert all(abs(found[f"m_{i}"]) < 0.1 for i in range(5))


def test_empty_table(spark):
    assert R.classify(no_docs(spark)).collect() == []


def test_plan_is_native(spark):
    plan = R.statistics(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
