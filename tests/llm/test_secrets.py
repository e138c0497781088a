import hashlib
import re

import numpy as np
import pytest

from paperloom.llm import secret_scan as S
from tests.llm.cases import docs, no_docs, odd_docs, prose

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
TEXTS = [
    f'token = "{HEX}"', "password: short", "PassWord='abcdef' passwd:12345", f"x AKIA{'A1' * 8} AKIA123 y", "secret:=abcdefgh", "api_key=abc=def== apikey :  'q1w2e3r4'",
    "ſecret=abcdefgh toKen=abcdefgh", "tokentoken=abcdef;token=token=abcdefg", f"{HEX[:23]} {HEX[:24]}G {HEX}{HEX}", "é\U0001f600 secret = \"zzzzzz\"", "a" * 30, "deadbeef" * 3 + "\n" + "f" * 24,
    "password\n=abcdef", None, "", "AKIA" + "Z" * 16 + " token=AKIA" + "Z" * 16,
]


def plain_spans(text):
    """The rules as they are stated."""
    found = []
    word = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (pattern, group, least) in enumerate(((word, 2, 6), ("AKIA[A-Z0-9]+", 0, 20), ("[0-9a-f]+", 0, 24))):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(found)


@pytest.mark.parametrize("text", TEXTS + [prose(1, 300) + TEXTS[0]])
def test_base_rules(text):
    assert S.base_spans(text or "") == plain_spans(text or "")


@pytest.fixture(scope="module")
def net():
    return S.train(*S.made_up_findings())


def test_network_tells_keys_from_plain_runs(net):
    x, y = S.made_up_findings(seed=99)
    found = net.probability(x) >= net.threshold
    assert found[y == 1].mean() >= 0.9 and found[y == 0].mean() <= 0.1


def test_output_is_linear_in_the_weights():
    x, y = S.made_up_findings(seed=1, n=40)
    net = S.train(x, y, epochs=1)
    z, pooled, _ = net.forward(x[:8])
    net.weight = net.weight + 1e-6 * np.eye(len(net.weight))[5]
    assert net.forward(x[:8])[0] - z == pytest.approx(1e-6 * pooled[:, 5], rel=1e-3, abs=1e-12)


def test_network_only_adds(net):
    for text in TEXTS:
        kinds = S.scan_text(text, net)
        names = [r[0] for r in S.RULES]
        assert [(a, names.index(k), b) for a, b, k in kinds if k != S.MODEL_KIND] == plain_spans(text or "")
        assert kinds == sorted(kinds, key=lambda s: (s[0], [*names, S.MODEL_KIND].index(s[2])))


def test_report(spark):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(TEXTS)] + [(100 + i, *r[1:]) for i, r in enumerate(odd_docs())]
    got = {r.doc_id: r for r in S.report(docs(spark, rows, clash=("findings", "spans", "x", "y"))).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        base = plain_spans(t or "")
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert [s for s in r.spans.split(",") if s and not s.startswith("model:")] == [s for s in shown.split(",") if s]


def test_redact(spark, net):
    rows = [(1, f"é {TEXTS[0]} end", "en", "a", 0), (2, None, None, None, None), (3, "clean", "en", "a", 5), (4, TEXTS[-1], "en", "a", 0)]
    frame = docs(spark, rows, clash=("findings",))
    got = {r.doc_id: r for r in S.redact(frame, net).collect()}
    assert got[1].text == 'é [secret]" end' and got[1].n_chars == len(got[1].text) and got[2].text is None
    assert got[3].text == "clean" and "AKIA" not in got[4].text and S.redact(frame, net).columns == frame.columns


def test_empty(spark):
    assert S.report(no_docs(spark)).collect() == []


def test_key_at_the_end_of_a_long_run(net):
    key = "sk_live_" + "Zq8Xw3Rt7Yp2Lk9Vb4Nm6Hd1"
    text = f"see //files.example.org/static/archive/exports/nightly/{key} for more"
    assert [text[a:b].endswith(key) for a, b, k in S.scan_text(text, net) if k == S.MODEL_KIND] == [True]
    for n in (16, 48, 49, 64, 65, 300):
        spans = S.pieces(5, 5 + n)
        assert {i for a, b in spans for i in range(a, b)} == set(range(5, 5 + n)) and all(b - a <= S.INSIDE for a, b in spans)


@pytest.mark.parametrize("kinds", [("repository token", "map key"), ("live key", "chat token", "base32"), ("web token", "capital hex")])
def test_kinds_of_keys_that_were_held_out(kinds):
    net = S.train(*S.made_up_findings(leave_out=kinds))
    for k in kinds:
        x, _ = S.made_up({k: S.KEYS[k]}, 1, 200, 77)
        assert (net.probability(x) >= net.threshold).mean() >= (0.8 if k == "capital hex" else 0.9), k


def test_rules_words_are_hidden_from_the_network():
    text = f'one two token = "{HEX}" three'
    (x, y), *_ = S._labelled(text)
    assert y == 1 and x == S.window(f"one two {HEX}\" three", 8, 8 + len(HEX)).tobytes()


def test_planted_keys_that_no_rule_finds(spark):
    """Recall on planted keys, and precision on the addresses, paths and words of ordinary documents."""
    import random

    rng = random.Random(4)
    rows, planted, plain = [], {}, 0
    for i in range(300):
        before, after = prose(i, 30), prose(i + 1000, 30)
        kind = sorted(S.KEYS)[i % len(S.KEYS)]
        body = S.KEYS[kind](rng) if i % 3 == 0 else S.PLAIN[sorted(S.PLAIN)[i % len(S.PLAIN)]](rng)
        rows.append((i, f"{before} {body} {after}", "en", "a", 0))
        if i % 3 == 0 and not S.base_spans(rows[-1][1]):
            planted[i] = (len(before) + 1, len(before) + 1 + len(body))
    rows += [(900, f'token = "{HEX}" and write to me.34@mail7.example.com or https://a.example.org/b/c2024/index7.html', "en", "a", 0)]
    got = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("model:")] for r in S.report(docs(spark, rows)).collect()}
    caught = sum(f"model:{a}:{b}" in got[i] for i, (a, b) in planted.items())
    assert len(planted) > 40 and caught >= 0.9 * len(planted)
    assert sum(bool(got[i]) for i in range(300) if i % 3) <= 2 and not got[900]
