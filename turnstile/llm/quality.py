"""Quality classifier on supervised subword embeddings.

Features of a text are its words, the character n-grams (3 to 5) of each word with its borders, and a mark for each
word that repeats the one before, hashed into ``BUCKETS`` learned vectors. A document is the mean of its features' vectors; a linear layer and a softmax
over the two classes follow. All vectors are trained by numpy stochastic gradient descent, one document a step.

Training takes a bounded sample of the labelled rows: at most ``SAMPLE_ROWS`` documents with at most
``SAMPLE_CHARS`` characters in all, in the order of a hash of the id. Features are made by the executors; the
driver gets hashed counts of the sample only, compressed, and unpacks one document a step. For scoring, the softmax layer is folded into the vectors
(one number a bucket, 512 KB), which is exact because the mean is linear; that table goes to every task.

Null, empty and white-space-only texts have no features and get the share of label 1 in the training sample
(0.5 without one). Conflicting labels of an id count by their mean; labels other than 0 and 1, and those without an
id, are passed over. Without both classes in the sample every score is that share. Repeated rows are scored each
for itself; further columns pass unseen. Words over ``CHUNK`` characters are taken in pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _POWERS, hand_back, packed, prefix_hash, read, unpacked

BITS = 17
BUCKETS = 1 << BITS
DIM, EPOCHS, RATE, BOOST, SEED = 8, 6, 0.5, 20, 7
GRAMS = (3, 4, 5)
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 32_000_000
CHUNK = 1 << 17
#: predicted = 1 from this score on (the contract's).
THRESHOLD = 0.7

_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def chunks(text: str) -> Iterator[str]:
    """The text in pieces of about CHUNK characters, cut at white space where there is some."""
    start = 0
    while len(text) - start > CHUNK:
        cut = max(text.rfind(" ", start + 1, start + CHUNK), text.rfind("\n", start + 1, start + CHUNK))
        cut = cut if cut > 0 else start + CHUNK
        yield text[start:cut]
        start = cut
    yield text[start:]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """For a piece of text: (position, bucket) of every word and n-gram."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (points <= 32) | (points == 0x85) | (points == 0xA0) | (points == 0x3000)
    n = len(points)
    prefix = prefix_hash(np.where(space, np.uint32(32), points).astype(np.uint64))
    _, down = _POWERS.upto(n + 1)
    at, bucket = [], []

    def add(start: np.ndarray, stop: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            h = (prefix[stop] - prefix[start]) * down[start] * _SPREAD
        at.append(start)
        bucket.append((h >> np.uint64(64 - BITS)).astype(np.int32))

    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first, last = edge[::2], edge[1::2]  # words: the text begins and ends with white space
    add(first, last)
    # A word that repeats the one before, one white space apart, has one more feature, the same for all words.
    again = np.flatnonzero((bucket[0][1:] == bucket[0][:-1]) & (first[1:] == last[:-1] + 1)) + 1
    at.append(first[again])
    bucket.append(np.zeros(len(again), np.int32))
    # Distance to the next white space from each position.
    following = np.where(space, np.arange(n), n)
    following = np.minimum.accumulate(following[::-1])[::-1]
    for k in GRAMS:
        if n >= k:
            # Only the first and last place of a window may be white space: a border of the word.
            start = np.flatnonzero(following[1 : n - k + 2] >= np.arange(n - k + 1) + k - 1)
            add(start, start + k)
    return np.concatenate(at), np.concatenate(bucket)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs."""
    total = np.zeros(BUCKETS, np.float32)
    for part in chunks(text):
        total += np.bincount(features(part)[1], minlength=BUCKETS)
    ids = np.flatnonzero(total).astype(np.int32)
    return ids, total[ids]


class Sample(Sequence):
    """Rows of (label, buckets, counts), held compressed: a row is unpacked when it is asked for."""

    def __init__(self, rows: list[tuple[float, bytes, bytes]]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[float, np.ndarray, np.ndarray]:
        y, gaps, n = self.rows[i]
        return y, _buckets(gaps), unpacked(n).view("<f4")

    @staticmethod
    def row(ids: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
        """Of ascending buckets the gaps, and the counts' bits."""
        return packed(np.diff(ids, prepend=0)), packed(n.view("<u4"))


def _buckets(gaps: bytes) -> np.ndarray:
    return np.cumsum(unpacked(gaps), dtype=np.int32)


def train(rows: Sequence[tuple[float, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Rows of (label, buckets, counts) to (logit weight of each bucket, bias)."""
    known = [(y, len(ids)) for y, ids, _ in rows]
    share = sum(y for y, _ in known) / len(known) if known else 0.5
    weights, prior = np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    usable = [i for i, (_, size) in enumerate(known) if size]
    if len({known[i][0] >= 0.5 for i in usable}) < 2:
        return weights, prior
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.array([0, prior], np.float32)
    steps, step = EPOCHS * len(usable), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(usable)):
            y, ids, n = rows[usable[i]]
            share_of = n / n.sum()
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share_of @ vectors[ids]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            wrong = (p - np.array([1 - y, y])).astype(np.float32)
            back = layer.T @ wrong
            layer -= rate * np.outer(wrong, hidden)
            bias -= 0.01 * rate * wrong
            # BOOST: the vectors' own learning rate, as a feature's share of the mean is small.
            vectors[ids] -= rate * BOOST * np.outer(share_of, back)
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def score_texts(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(texts))
    group: list[int] = []
    size = 0

    def flush() -> None:
        # Short texts together: one pass of array operations for all of them.
        # Two line ends between texts: a window that starts at the second one opens the next text.
        ends = np.cumsum([len(texts[i]) + 2 for i in group])
        at, bucket = features("\n\n".join(texts[i] for i in group))
        owner = np.searchsorted(ends, at, side="right")  # positions count from the leading border
        n = np.bincount(owner, minlength=len(group) + 1)[: len(group)]
        z = np.bincount(owner, weights=weights[bucket], minlength=len(group) + 1)[: len(group)]
        out[group] = z / np.maximum(n, 1)
        group.clear()

    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            n, z = 0, 0.0
            for part in chunks(text):
                bucket = features(part)[1]
                n, z = n + len(bucket), z + float(weights[bucket].sum(dtype=np.float64))
            out[i] = z / max(n, 1)
            continue
        if size + len(text) > CHUNK and group:
            flush()
            size = 0
        group.append(i)
        size += len(text) + 2
    if group:
        flush()
    return 1 / (1 + np.exp(-np.clip(out + bias, -500, 500)))


def sample_features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int, chars: int) -> Sequence[tuple[float, np.ndarray, np.ndarray]]:
    """Features of the bounded training sample."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(rows)
    # At most `rows` ids: small enough for every task whatever the tables' sizes.
    joined = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(known), "id")
    sized = joined.groupBy("id").agg(F.max(F.length("text")).alias("n"), F.count("*").alias("m")).orderBy(F.xxhash64("id"), "id").collect()
    kept, total = [], 0
    for row in sized:
        total += row.n * row.m
        if total > chars:
            break
        kept.append(row.id)
    if not kept:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n = Sample.row(*counted(batch.column(2)[i].as_py()))
                yield pa.RecordBatch.from_pydict({"id": pa.array([str(batch.column(0)[i].as_py())]), "y": [batch.column(1)[i].as_py()], "ids": [ids], "n": [n]})

    chosen = docs.sparkSession.createDataFrame([(k,) for k in kept], joined.select("id").schema)
    made = joined.join(F.broadcast(chosen), "id").select("id", "y", "text").mapInArrow(run, "id string, y double, ids binary, n binary")
    out = made.collect()
    often = Counter(r.id for r in out)
    out.sort(key=lambda r: (r.id, _buckets(r.ids).tobytes() if often[r.id] > 1 else b""))
    return Sample([(r.y, r.ids, r.n) for r in out])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[np.ndarray, float]:
    """(weights, bias) of the model trained on the bounded sample of ``labels``."""
    model = train(sample_features(docs, labels, id_col, text_col, label_col, rows, chars))
    hand_back()
    return model


def score(docs: DataFrame, model: tuple[np.ndarray, float], *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score column (0 to 1, higher: label 1 likelier). Narrow: no shuffle."""
    weights = docs.sparkSession.sparkContext.broadcast(model[0])  # BUCKETS floats, whatever the input
    bias = model[1]

    @F.pandas_udf("double")
    def scored(text):
        import pandas as pd

        return pd.Series(score_texts(text.fillna("").tolist(), weights.value, bias))

    return docs.withColumn(score_col, scored(F.col(text_col)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The contract's model: labels of held-out rows are never read."""
    return fit(docs, labels.filter(~held_out(F.col("doc_id"))))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
