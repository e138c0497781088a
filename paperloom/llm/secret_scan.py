"""Secret scans: fixed rules, and a character convolutional network over every further candidate."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import hash_share
from paperloom.scratch import stored

#: Fixed rules: kind, pattern, the group whose length counts, its least length; in the order of the kinds.
RULES = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
#: A rule is tried only on texts that hold one of these (in lower case where the rule ignores case).
_HINTS = (("passw", "secret", "token", "apikey", "api_key"), ("AKIA",))
MODEL_KIND = "model"
#: What the network judges: runs of key characters with a digit, or with a small letter before a capital one.
#: Other runs are words, or words joined by signs, in one case.
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]")
#: Characters taken from before, from the start of, and from after a candidate.
BEFORE, INSIDE, AFTER = 24, 48, 8
#: Characters from one piece of a longer candidate to the next.
STRIDE = 16
_WIDE, _FILTERS, _CLASSES = 5, 24, 98
#: Documents and candidates that the network is trained on, at most (documents about).
TRAIN_DOCS, TRAIN_CANDIDATES = 20_000, 1_500
#: Made-up findings of each label that are added.
MADE_UP = 4_000
RECALL = 0.995


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rule, end) of what the fixed rules find, in order."""
    found = []
    low = text.lower() if any(h in text for h in ("=", ":")) else ""
    if low and any(h in low for h in _HINTS[0]):
        found += [(m.start(), 0, m.end()) for m in RULES[0][1].finditer(text) if len(m[2]) >= RULES[0][3]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in RULES[1][1].finditer(text) if m.end() - m.start() >= RULES[1][3]]
    found += [(m.start(), 2, m.end()) for m in RULES[2][1].finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be secrets, whether a rule finds them or not."""
    return [m.span() for m in _RUN.finditer(text) if _MIXED.search(m[0])]


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping spans of at most INSIDE characters that cover a candidate."""
    firsts = [*range(start, end - INSIDE, STRIDE), max(start, end - INSIDE)]
    return [(a, min(a + INSIDE, end)) for a in firsts]


def window(text: str, start: int, end: int, left: int | None = None) -> np.ndarray:
    """Character classes of a candidate and its surroundings; 0 where there is no character.

    What precedes the candidate is read before ``left``, where that is given:
    a rule's own words stay out.
    """
    left = start if left is None else min(left, start)
    parts = ((text[max(0, left - BEFORE) : left], BEFORE, True), (text[start : min(end, start + INSIDE)], INSIDE, False), (text[end : end + AFTER], AFTER, False))
    out = np.zeros(BEFORE + INSIDE + AFTER, np.int16)
    at = 0
    for part, size, right in parts:
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        codes = np.where((codes >= 32) & (codes < 127), codes - 30, np.where(codes == 10, 97, 1))
        first = at + size - len(codes) if right else at
        out[first : first + len(codes)] = codes
        at += size
    return out


_PARTS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, BEFORE + INSIDE + AFTER))


@dataclass
class CharNetwork:
    """One convolution over character classes, the greatest and mean answer in each part, then a logistic unit."""

    kernel: np.ndarray
    shift: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        padded = np.pad(x, ((0, 0), (_WIDE // 2, _WIDE // 2)))
        n = x.shape[1]
        conv = sum(self.kernel[j][padded[:, j : j + n]] for j in range(_WIDE)) + self.shift
        np.maximum(conv, 0, out=conv)
        tops = [conv[:, a:b].argmax(axis=1) + a for a, b in _PARTS]
        rows = np.arange(len(x))[:, None]
        cols = np.arange(_FILTERS)[None, :]
        pooled = np.concatenate([conv[rows, t, cols] for t in tops] + [conv[:, a:b].mean(axis=1) for a, b in _PARTS], axis=1)
        return pooled @ self.weight + self.bias, pooled, np.stack(tops)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability that each window shows a secret."""
        out = [self.forward(x[at : at + 512])[0] for at in range(0, len(x), 512)]
        z = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 6, epochs: int = 12, recall: float = RECALL) -> CharNetwork:
    """Train on windows ``x`` with labels ``y``; a third of them calibrates the probabilities by a logistic
    fit and sets the highest threshold that still finds ``recall`` of the secrets there."""
    rng = np.random.default_rng(seed)
    net = CharNetwork(rng.normal(0, 0.15, (_WIDE, _CLASSES, _FILTERS)), np.zeros(_FILTERS), rng.normal(0, 0.15, 6 * _FILTERS), 0.0)
    if not len(y) or y.min() == y.max():
        return net
    order = rng.permutation(len(y))
    held, learn = order[: len(y) // 3], order[len(y) // 3 :]
    rate, memory = 0.05, [np.full_like(p, 1e-3) for p in (net.kernel, net.shift, net.weight)]
    for _ in range(epochs):
        learn = rng.permutation(learn)
        for at in range(0, len(learn), 64):
            some = learn[at : at + 64]
            xb = x[some].copy()
            hide = rng.random(len(some)) < 0.5  # half the time the surroundings give nothing away
            xb[hide, :BEFORE] = 0
            z, pooled, tops = net.forward(xb)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            dw = pooled.T @ g
            dp = g[:, None] * net.weight
            dk, ds = np.zeros_like(net.kernel), np.zeros_like(net.shift)
            padded = np.pad(xb, ((0, 0), (_WIDE // 2, _WIDE // 2)))
            cols = np.arange(_FILTERS)[None, :]
            for k in range(3):
                live = dp[:, k * _FILTERS : (k + 1) * _FILTERS] * (pooled[:, k * _FILTERS : (k + 1) * _FILTERS] > 0)
                ds += live.sum(axis=0)
                for j in range(_WIDE):
                    np.add.at(dk[j], (padded[np.arange(len(some))[:, None], tops[k] + j], cols), live)
            net.bias -= rate * float(g.sum())
            for p, d, m in zip((net.kernel, net.shift, net.weight), (dk, ds, dw), memory, strict=True):
                m += d * d
                p -= rate * d / np.sqrt(m)
    z = np.concatenate([net.forward(x[held[at : at + 512]])[0] for at in range(0, len(held), 512)])
    t = y[held].astype(float)
    if 0 < t.sum() < len(t):
        for _ in range(200):
            g = 1 / (1 + np.exp(-np.clip(net.slope * z + net.offset, -30, 30))) - t
            net.slope -= 0.5 * float((g * z).mean())
            net.offset -= 0.5 * float(g.mean())
        p = np.sort(net.probability(x[held])[t == 1])
        net.threshold = float(min(p[int((1 - recall) * len(p))], 0.999))
    return net


_LOW, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_MIX = _LOW + _LOW.upper() + _DIGITS


def _some(rng: random.Random, chars: str, least: int, most: int = 0) -> str:
    return "".join(rng.choice(chars) for _ in range(rng.randint(least, max(least, most))))


def _word(rng: random.Random) -> str:
    """A pronounceable word."""
    return "".join(rng.choice("bcdfghlmnprstvw") + rng.choice("aeiou") + rng.choice(("", "", "n", "r", "s")) for _ in range(rng.randint(1, 4)))


#: Shapes of keys that are made up for training.
KEYS = {
    "hex": lambda r: _some(r, _DIGITS + "abcdef", 16, 64),
    "capital hex": lambda r: _some(r, _DIGITS + "ABCDEF", 16, 64),
    "cloud access": lambda r: r.choice(("AKIA", "ASIA")) + _some(r, _LOW.upper() + _DIGITS, 16),
    "mixed": lambda r: _some(r, _MIX, 16, 44),
    "live key": lambda r: r.choice(("sk_live_", "pk_test_", "rk_live_")) + _some(r, _MIX, 24, 32),
    "repository token": lambda r: r.choice(("ghp_", "gho_", "glpat-", "npm_")) + _some(r, _MIX, 20, 40),
    "chat token": lambda r: r.choice(("xoxb-", "xoxp-")) + "-".join(_some(r, _DIGITS, 10, 12) for _ in range(2)) + "-" + _some(r, _MIX, 24),
    "base64": lambda r: _some(r, _MIX + "+/", 24, 60) + r.choice(("", "=", "==")),
    "web token": lambda r: "eyJ" + ".".join(_some(r, _MIX + "_-", 18, 60) for _ in range(3)),
    "map key": lambda r: "AIza" + _some(r, _MIX + "_-", 35),
    "base32": lambda r: _some(r, _LOW.upper() + "234567", 16, 32),
    "small letters and digits": lambda r: _some(r, _LOW + _DIGITS, 20, 40),
}
#: Shapes of long runs that are none.
PLAIN = {
    "host": lambda r: ".".join(_word(r) for _ in range(r.randint(1, 3))) + f"{r.randint(1, 99)}." + r.choice(("example.org", "example.com", "net")),
    "path": lambda r: "/".join(_word(r) for _ in range(r.randint(2, 5))) + r.choice((f"/{r.randint(1, 2030)}", f"/v{r.randint(1, 9)}/{_word(r)}", f"{r.randint(1, 99)}.html")),
    "slug": lambda r: "-".join(_word(r) for _ in range(r.randint(2, 5))) + f"-{r.randint(1, 2030)}",
    "date": lambda r: f"{r.randint(1900, 2099)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}" + r.choice(("T", "_", "-")) + f"{r.randint(0, 23):02d}.{r.randint(0, 59):02d}.{r.randint(0, 59):02d}" + r.choice(("", "Z")),
    "file": lambda r: "_".join(_word(r) for _ in range(r.randint(2, 4))) + f"{r.randint(1, 99)}." + r.choice(("txt", "png", "tar.gz", "jpeg")),
    "number": lambda r: _some(r, _DIGITS, 12, 20),
    "grouped number": lambda r: "-".join(_some(r, _DIGITS, 3, 5) for _ in range(r.randint(3, 5))),
    "decimal": lambda r: f"{r.randint(0, 99999)}.{_some(r, _DIGITS, 8, 16)}",
    "address": lambda r: ".".join(str(r.randint(100, 255)) for _ in range(4)),
    "camel case": lambda r: _word(r) + "".join(_word(r).capitalize() for _ in range(r.randint(2, 4))) + r.choice(("", str(r.randint(1, 9)))),
    "constant": lambda r: "_".join(_word(r).upper() for _ in range(r.randint(2, 4))) + f"_{r.randint(1, 99)}",
    "joined words": lambda r: "".join(_word(r) for _ in range(r.randint(3, 5))) + str(r.randint(1, 2030)),
    "split word": lambda r: _word(r) + r.choice((".", "-")) + _word(r).capitalize() + _word(r) + r.choice(("", ".")),
    "article": lambda r: r.choice(("ABC", "SN", "REF", "No")) + "-" + _some(r, _DIGITS, 4, 6) + "-" + _some(r, _DIGITS, 2, 4),
}


def made_up(kinds: dict, label: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows of made-up runs of these shapes, among made-up words."""
    rng = random.Random(seed)
    xs = []
    for i in range(n):
        body = list(kinds.values())[i % len(kinds)](rng)
        before = " ".join(_word(rng) for _ in range(4)) + rng.choice((" ", " ", " ", "\n", ' "', ' = "', ": ", "key "))
        text = f"{before}{body}{rng.choice((' ', ' ', ', ', chr(34) + ' '))}{_word(rng)} {_word(rng)}"
        for a, b in pieces(len(before), len(before) + len(body))[:1]:
            xs.append(window(text, a, b))
    return np.array(xs), np.full(n, label)


def made_up_findings(seed: int = 6, n: int = MADE_UP, leave_out: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows of made-up keys, without the shapes ``leave_out``, and of long runs that are none."""
    x, y = made_up({k: f for k, f in KEYS.items() if k not in leave_out}, 1, n, seed)
    other, zero = made_up(PLAIN, 0, n, seed + 1)
    return np.concatenate([x, other]), np.concatenate([y, zero])


def _labelled(text: str) -> list[tuple[bytes, int]]:
    """Windows and labels of a text's candidates; what a rule finds is a secret, and the words it goes by are hidden."""
    base = base_spans(text)
    out = []
    for whole in candidates(text):
        for a, b in pieces(*whole):
            hit = [s for s, _, e in base if s < b and a < e]
            out.append((window(text, a, b, min(hit, default=None)).tobytes(), int(bool(hit))))
    return out


def labelled_findings(docs: DataFrame, bound: int = TRAIN_DOCS, most: int = TRAIN_CANDIDATES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of candidates from about ``bound`` documents, ``most`` of each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for value in batch.column("text") for w in _labelled(value.as_py() or "")]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.int32())], ["x", "y"])

    chosen = docs.select("text").where(hash_share(F.xxhash64("doc_id", "text"), bound, docs.count(), 6))
    found = stored(chosen.mapInArrow(run, "x binary, y int").distinct(), "secret-findings")
    rows = [r for y in (0, 1) for r in found.where(F.col("y") == y).orderBy(F.xxhash64("x"), "x").limit(most).collect()]
    if not rows:
        return np.zeros((0, BEFORE + INSIDE + AFTER), np.int16), np.zeros(0, int)
    return np.array([np.frombuffer(r.x, np.int16) for r in rows]), np.array([r.y for r in rows])


def fit(docs: DataFrame) -> CharNetwork:
    """The network for these documents.

    Made-up findings are added to theirs, so that it never lacks either label
    and knows keys of other shapes than the rules'. A candidate that no rule
    finds isn't thereby harmless: a first network, which has not seen those,
    sorts out the ones that look like keys, and only the others count as harmless.
    """
    x, y = labelled_findings(docs)
    more, marks = made_up_findings()
    first = train(np.concatenate([x[y == 1], more]), np.concatenate([y[y == 1], marks]))
    sure = (y == 1) | (first.probability(x) < first.threshold)
    return train(np.concatenate([x[sure], more]), np.concatenate([y[sure], marks]))


def scan_text(text: str | None, net: CharNetwork) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every finding, by start and then kind; the network's come last.

    The network adds candidates that no rule's finding overlaps.
    """
    return scan_texts([text], net)[0]


def scan_texts(texts: list[str | None], net: CharNetwork) -> list[list[tuple[int, int, str]]]:
    found = [base_spans(t or "") for t in texts]
    more, xs = [], []
    for i, text in enumerate(texts):
        for a, b in candidates(text or ""):
            if not any(s < b and a < e for s, _, e in found[i]):
                more.append((i, a, b, len(xs)))
                xs += [window(text or "", *s) for s in pieces(a, b)]
    if xs:
        p = np.maximum.reduceat(net.probability(np.array(xs)), [m[3] for m in more])  # a candidate's likeliest piece counts
        for (i, a, b, _), hit in zip(more, p >= net.threshold, strict=True):
            if hit:
                found[i].append((a, len(RULES), b))
    kinds = [*[r[0] for r in RULES], MODEL_KIND]
    return [[(a, b, kinds[k]) for a, k, b in sorted(row)] for row in found]


def scan(docs: DataFrame, net: CharNetwork) -> DataFrame:
    """``(doc_id, findings)`` of every row: structs of kind, start and end in code points, in order.

    Null texts count as empty and have no findings; repeated rows have the same;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = scan_texts(batch.column("text").to_pylist(), shared.value)
                rows = [[{"kind": k, "start": a, "end": b} for a, b, k in row] for row in found]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "findings"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(run, "doc_id long, findings array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, net: CharNetwork, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; overlapping ones are replaced together.

    ``n_chars``, where there is such a column, follows the new text. Null texts stay null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column("text").to_pylist()
                for i, row in enumerate(scan_texts(texts, shared.value)):
                    texts[i] = _without(texts[i], row, mark)
                place = batch.schema.get_field_index("text")
                yield batch.set_column(place, batch.schema.field(place).with_type(pa.string()), pa.array(texts, pa.string()))

    done = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("text"), F.col("n_chars"))
        done = done.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
    return done


def _without(text: str | None, spans: list[tuple[int, int, str]], mark: str) -> str | None:
    if not spans or text is None:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every row."""
    done = scan(docs, fit(docs))
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("findings", lambda x: x["kind"] != MODEL_KIND)
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return done.select(
        "doc_id",
        *[count(k[0]) for k in RULES],
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("findings", text), ",").alias("spans"),
    )
