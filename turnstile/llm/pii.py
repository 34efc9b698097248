"""Personal data by patterns and a skip-chain conditional random field.

The base patterns (email, ip, card, phone) give spans that always stay. On top of them a conditional random
field labels the tokens of each document that hold a digit or ``@`` (all others are surely outside, so
they only cut the chain): node potentials from the token's shape, chain potentials between neighbours, skip
potentials between tokens of a document that are alike (same letters and digits, or the same seven digits or
more). Tokens under a base span are clamped to its kind. Loopy belief propagation passes this along, so that
a second mention in another form takes the label of the first. A token without a base span is added when
one kind's marginal reaches ``SURE``.

Alike tokens are linked occurrence by occurrence (each with the one before), so edges grow with the tokens.
The weights are trained here, by softmax regression on what the base patterns say of a bounded sample
(``SAMPLE_DOCS`` documents in the order of a hash of the id); only counts of shapes reach the driver.

Null texts count as empty and have no spans. Offsets are code points, ends exclusive. One row out per row
in; repeated rows, null ids and further columns pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE_DOCS = 5000
ROUNDS, DAMPING, SURE, CLAMP = 8, 0.3, 0.9, 8.0

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_EMAIL_AT = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot start inside a run of digits that a failed start has already read; each run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_EDGE = "\"'()[]{}<>.,;:!?|*#%&$-+"
_DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base patterns' spans, by kind, then start."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        # A match holds an @; it starts where the run of local characters before it starts.
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        m = _EMAIL_AT.match(text, start)
        if m and start < at:
            out.append((0, start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.findall(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


@dataclass(slots=True)
class Token:
    start: int
    end: int
    shape: int
    label: int  # of the first base span that covers part of it
    follows: bool  # the token before is a node too


def shape(word: str, before: str) -> int:
    """Binary features of a token as bits."""
    digits = len(_DIGITS.findall(word))
    dots = word.strip(_EDGE).count(".")
    core = word.strip(_EDGE)
    numeric = all(c in "0123456789 .()+-" for c in core)
    octets = core.split(".")
    bits = [
        True,
        "@" in core,
        "@" in core and "." in core.partition("@")[2],
        *(digits == 0, 1 <= digits <= 3, 4 <= digits <= 7, 8 <= digits <= 15, 16 <= digits <= 19, digits > 19),
        *(dots == 1, dots == 2, dots == 3, dots > 3),
        numeric,
        word[0] == "+",
        word[0] == "(" and word[-1] == ")",
        "-" in core,
        len(octets) == 4 and all(o.isascii() and o.isdigit() and len(o) <= 3 and int(o) <= 255 for o in octets),
        digits >= 12 and luhn("".join(_DIGITS.findall(word))),
        before[:1] == "+",
        before[:1] == "(",
        core.isdigit() and len(core) == 4,
    ]
    return sum(1 << i for i, b in enumerate(bits) if b)


FEATURES = 22


def nodes(text: str, spans: list[Span]) -> list[Token]:
    """The tokens with a digit or @, in order."""
    out: list[Token] = []
    ordered = sorted(spans, key=lambda s: (s[1], s[2]))
    first, m, end_before = 0, _MARK.search(text), -2
    while m:
        start = m.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        while first < len(ordered) and ordered[first][2] <= start:
            first += 1
        # Spans of different kinds may overlap: the earliest that covers part of the token counts.
        label = next((k + 1 for k, a, b in ordered[first:] if b > start and a < end), 0) if first < len(ordered) and ordered[first][1] < end else 0
        before = text[out[-1].start : out[-1].end] if out and start - out[-1].end == 1 else ""
        out.append(Token(start, end, shape(text[start:end], before), label, bool(before)))
        m = _MARK.search(text, end)
    return out


def alike(text: str, tokens: list[Token]) -> list[tuple[int, int]]:
    """Skip edges: each token with the one before that is like it."""
    last: dict[str, int] = {}
    edges = []
    for i, t in enumerate(tokens):
        word = text[t.start : t.end].strip(_EDGE).lower()
        digits = "".join(_DIGITS.findall(word))
        keys = {word} if len(word) >= 4 else set()
        if len(digits) >= 7:
            keys.add(digits)
        for j in {last[k] for k in keys if k in last}:
            edges.append((j, i))
        for k in keys:
            last[k] = i
    return edges


@dataclass
class Model:
    node: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, log
    skip: float


def train(counts: Counter, follows: np.ndarray, agree: tuple[int, int]) -> Model:
    """Piecewise training: softmax regression for the nodes (counts of (shape, label)), smoothed log ratios for
    the chain (counts of neighbouring labels), the log odds of agreement for the skip edges."""
    weights = np.zeros((FEATURES, len(LABELS)))
    weights[0, 0] = 2.0
    if counts:
        keys = sorted(counts)
        x = np.array([[s >> i & 1 for i in range(FEATURES)] for s, _ in keys], float)
        y = np.eye(len(LABELS))[[label for _, label in keys]]
        n = np.sqrt(np.array([counts[k] for k in keys], float))  # frequent shapes must not drown the rare
        rng = np.random.default_rng(3)
        for step in range(4000):
            i = rng.choice(len(keys), size=min(32, len(keys)), p=n / n.sum())
            z = x[i] @ weights
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            weights -= 0.5 * (1 - step / 4000) * (x[i].T @ (p - y[i]) / len(i) + 1e-4 * weights)
    joint = follows + 1.0
    chain = np.log(joint * joint.sum() / np.outer(joint.sum(axis=1), joint.sum(axis=0)))
    same, other = agree
    return Model(weights, np.clip(chain, -3, 3), float(np.clip(np.log((same + 1) / (other + 1)), 0, 3)))


def marginals(tokens: list[Token], skips: list[tuple[int, int]], model: Model) -> np.ndarray:
    """Loopy sum-product over chain and skip edges: (token, label) probabilities."""
    shapes = np.array([t.shape for t in tokens])
    bits = (shapes[:, None] >> np.arange(FEATURES)) & 1
    unary = bits @ model.node
    for i, t in enumerate(tokens):
        if t.label:
            unary[i, t.label] += CLAMP
    same = np.eye(len(LABELS)) * model.skip
    chain = [(i - 1, i) for i, t in enumerate(tokens) if t.follows]
    edges = np.array(chain + skips, int).reshape(-1, 2)
    if len(edges):
        potential = np.concatenate([np.broadcast_to(model.chain, (len(chain), *same.shape)), np.broadcast_to(same, (len(skips), *same.shape))])
        forward = np.zeros((len(edges), len(LABELS)))  # messages a -> b
        backward = np.zeros_like(forward)
        a, b = edges.T
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, b, forward)
            np.add.at(belief, a, backward)
            to_b = _reduce(potential + (belief[a] - backward)[:, :, None], axis=1)
            to_a = _reduce(potential + (belief[b] - forward)[:, None, :], axis=2)
            forward = DAMPING * forward + (1 - DAMPING) * to_b
            backward = DAMPING * backward + (1 - DAMPING) * to_a
        np.add.at(unary, b, forward)
        np.add.at(unary, a, backward)
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _reduce(x: np.ndarray, axis: int) -> np.ndarray:
    """Log of the summed exponentials, centred."""
    top = x.max(axis=axis, keepdims=True)
    out = (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)
    return out - out.mean(axis=1, keepdims=True)


def find(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a text."""
    base = base_spans(text)
    tokens = nodes(text, base)
    if not tokens:
        return base, []
    p = marginals(tokens, alike(text, tokens), model)
    added: list[Span] = []
    for i in np.flatnonzero(p[:, 1:].max(axis=1) >= SURE):
        t = tokens[i]
        if t.label:
            continue
        word = text[t.start : t.end]
        start = t.start + len(word) - len(word.lstrip(_EDGE))
        end = t.start + len(word.rstrip(_EDGE))
        if end > start:
            added.append((int(p[i, 1:].argmax()), start, end))
    return base, added


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS) -> Model:
    """Train on the base spans of a bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                tokens = nodes(text, base_spans(text))
                seen.update(("node", t.shape, t.label) for t in tokens)
                seen.update(("chain", tokens[i - 1].label, t.label) for i, t in enumerate(tokens) if t.follows)
                seen.update(("skip", int(tokens[i].label == tokens[j].label), 0) for i, j in alike(text, tokens) if tokens[i].label or tokens[j].label)
        yield pa.RecordBatch.from_pydict({"what": pa.array([k[0] for k in seen], pa.string()), "a": pa.array([k[1] for k in seen], pa.int64()), "b": pa.array([k[2] for k in seen], pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")  # at most `sample` ids
    counted = rows.select("text").mapInArrow(run, "what string, a long, b long, n long").groupBy("what", "a", "b").agg(F.sum("n").alias("n"))
    counts, follows, agree = Counter(), np.zeros((len(LABELS), len(LABELS))), [0, 0]
    for r in counted.collect():  # at most a few thousand shapes
        if r.what == "node":
            counts[r.a, r.b] = r.n
        elif r.what == "chain":
            follows[r.a, r.b] = r.n
        else:
            agree[r.a] = r.n
    return train(counts, follows, (agree[1], agree[0]))


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def detect(docs: DataFrame, model: Model, *, text_col: str = "text", spans_col: str = "pii_spans", masked_col: str | None = None) -> DataFrame:
    """``docs`` with its spans (by kind as listed, then start) and, if a name is given, the masked text. Narrow."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    @F.pandas_udf(f"struct<spans:{SPANS},masked:string>")
    def run(texts):
        import pandas as pd

        spans, hidden = [], []
        for text in texts.fillna(""):
            base, added = find(text, sent.value)
            both = sorted([(*s, True) for s in base] + [(*s, False) for s in added])
            spans.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in both])
            hidden.append(masked(text, base + added) if masked_col else None)
        return pd.DataFrame({"spans": spans, "masked": pd.Series(hidden, dtype=object)})

    found = docs.withColumn("__pii", run(F.col(text_col)))
    new = {spans_col: F.col("__pii.spans")}
    if masked_col:
        new[masked_col] = F.col("__pii.masked")
    return found.withColumns(new).drop("__pii")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect(docs, fit(docs))
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["base"])
    written = lambda x: F.concat_ws(",", F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    of_kind = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter(base, of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans"))
