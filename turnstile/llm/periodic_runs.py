"""Runs of words that repeat with a period, found while the words go by, and texts with such runs collapsed.

A run is a stretch of words with smallest period q (words q apart are identical) of at least ``LEAST`` words and two
periods, which no neighbouring word extends. On the *diagonal* of a lag q the match length at word i counts the words up to i
that equal the word q before them. A diagonal that ends after q or more matches is a run (q words longer than the matches).

Only diagonals that can become runs are opened. A run has at least 6 matches in a row, so earlier occurrences are looked up
for grams, not for single words: at scale k (6, 12, 24, ...) for lags from k to 2k - 1, with grams of k words. The
gram's three last occurrences are enough: where one lies within k / 2 words, the place repeats with a shorter
period and cannot be the only place at which a run of a lag in that range shows itself (overlapping grams with
periods up to k / 2 share their period, which would be the run's); elsewhere occurrences are more than k / 2 apart, so
that at most three are nearer than 2k. Below lag 6 the last occurrence of the 6-gram is enough. So a word that fills a whole
text opens one diagonal, not one for each earlier word, and a text of n words takes about n log n steps. A
diagonal's match length then advances by whole stretches of equal words, and when it ends it emits its run or nothing. A
multiple of a run's period ends where the run does; of such diagonals the smallest lag stays.

Null and empty texts have no words and no runs. Rows are independent: null ids, repeated ids and repeated rows each give
their own row. A text is held whole in one task, as one row of the table is. Further columns pass unseen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, mix, prefix_hash, read, span_hash

#: Least words of a run.
LEAST = 12
#: Texts are taken together up to so many characters.
GROUP_CHARS = 1_000_000
_RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Numbers(dict):
    """A number for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


def _openers(words: np.ndarray, doc: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, word) of the places at which diagonals open, by lag and word; of adjacent places the first."""
    base = max(1, least // 2)
    prefix = prefix_hash(mix(words.astype(np.uint64) + np.uint64(1)))
    room = ends[doc] - np.arange(len(words))  # words up to the document's end
    salt = mix(doc.astype(np.uint64) + np.uint64(0x51ED2701))
    alive = np.ones(len(words), bool)
    lags, places = [], []
    k = base
    while True:
        at = np.flatnonzero(alive & (room >= k))
        if not len(at):
            break
        key = span_hash(prefix, at, at + k) ^ salt[at]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        before = []  # distance to each of the last three occurrences
        for back in (1, 2, 3):
            far = np.full(len(at), 1 << 60)
            far[back:] = np.where(key[back:] == key[:-back], at[back:] - at[:-back], 1 << 60)
            before.append(far)
        if k == base:
            short = before[0] < k
            lags.append(before[0][short]), places.append(at[short])
        for far in before:
            opens = (before[0] * 2 > k) & (far >= k) & (far < 2 * k)
            lags.append(far[opens]), places.append(at[opens])
        again = np.zeros(len(at), bool)
        again[1:] = key[1:] == key[:-1]
        again[:-1] |= again[1:]
        seen = np.zeros(len(words) + k, bool)
        seen[at[again]] = True
        alive = seen[: len(words)] & seen[k:]  # both halves of a repeated gram of 2k words are repeated
        k *= 2
    lag, place = (np.concatenate([np.zeros(0, np.int64), *some]) for some in (lags, places))
    order = np.lexsort((place, lag))
    lag, place = lag[order], place[order]
    head = np.ones(len(lag), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
    return lag[head], place[head]


def _advance(words: np.ndarray, lag: int, at: int, stop: int) -> int:
    """The first word from ``at`` on that differs from the word ``lag`` before it, or ``stop``."""
    step = 16
    while at < stop:
        upto = min(at + step, stop)
        differ = words[at:upto] != words[at - lag : upto - lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = upto, step * 2
    return stop


def _retreat(words: np.ndarray, lag: int, at: int, stop: int) -> int:
    """The first word of the matches that end before ``at``, not below ``stop``."""
    step = 16
    while at > stop:
        down = max(at - step, stop)
        differ = words[down:at] != words[down - lag : at - lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = down, step * 2
    return stop


def runs_of(words: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """For each document (numbers of its words, concatenated; ``lengths`` words each) its runs
    (start, length, period) by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    if not len(words):
        return out
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    found: dict[tuple[int, int], int] = {}
    active_lag, active_end = -1, -1
    lags, places = _openers(words, doc, ends, least)
    for lag, place in zip(lags.tolist(), places.tolist(), strict=True):
        if lag == active_lag and place < active_end:
            continue  # the diagonal is open there already
        d = doc[place]
        first = int(ends[d] - lengths[d])
        active_lag, active_end = lag, _advance(words, lag, place, int(ends[d]))
        start = _retreat(words, lag, place, first + lag) - lag
        length = active_end - start
        if length >= max(least, 2 * lag):  # the diagonal ends: its run goes out
            found[start, length] = min(lag, found.get((start, length), lag))
    for (start, length), period in found.items():
        d = doc[start]
        out[d].append((int(start - (ends[d] - lengths[d])), length, period))
    for some in out:
        some.sort(key=lambda r: (r[0], r[2]))
    return out


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those that no run holds after its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) == 0


def _collapse(least: int, chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, size = batch.column(1), 0, 0
            held: list[list[bytes]] = []
            for i in range(batch.num_rows):
                held.append(ascii_words(texts[i].as_py() or ""))
                size += sum(map(len, held[-1])) + len(held[-1])
                if size >= chars or i == batch.num_rows - 1:
                    yield rows(batch.column(0).slice(first, len(held)), held)
                    first, held, size = i + 1, [], 0

    def rows(ids: pa.Array, held: list[list[bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(w) for w in held], np.int64)
        numbers = _Numbers()
        words = np.fromiter((numbers[w] for some in held for w in some), np.int64, int(lengths.sum()))
        runs = runs_of(words, lengths, least)
        kept = []
        for some, found in zip(held, runs, strict=True):
            if found:
                stay = _kept(len(some), found).tolist()
                some = [w for w, s in zip(some, stay, strict=True) if s]
            kept.append(b" ".join(some).decode("utf-8"))
        listed = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs], _RUN_TYPE)
        return pa.RecordBatch.from_arrays([ids, pa.array(lengths), listed, pa.array(kept, pa.string())], names=["id", "n_words", "runs", "text"])

    return run


def collapse(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, chars: int = GROUP_CHARS) -> DataFrame:
    """(id, n_words, runs, text): each row's runs by start and period, and its words without those that a run holds after
    its first period, joined by one space. ``least`` is the least length of a run (2 or more)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_collapse(least, chars), f"id {kind}, n_words long, runs {_RUNS}, text string").withColumnRenamed("id", id_col)


def _with_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for i, key in enumerate(batch.column(0).to_pylist()):
            text = batch.column(1)[i].as_py() or ""
            h = zlib.crc32(str(key).encode()) if key is not None else 1
            if h % 10 == 0 and (words := text.encode("utf-8").split()):
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                tail = words[a : a + p]
                text = b" ".join(words[:a] + (tail * ((n - a) // p + 1))[: n - a]).decode("utf-8")
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): about a tenth of the rows, chosen by a checksum of the id, repeat a stretch of their own words up to
    their end (what the query examines). Rows without an id stay as they are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_with_tails, "doc_id long, text string")


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    out = collapse(with_periodic_tails(read(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = out.withColumns({"best": longest, "lines": F.array_join(lines, "")})
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
