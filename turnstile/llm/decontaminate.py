"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-case words with one space between them. An item of n characters may differ by
k = floor(RATE * n) edits. It is cut into k + 1 pieces: k edits leave at least one piece whole, so every match
holds an exact piece hit at the piece's place, give or take k. All pieces are searched at once (Aho-Corasick);
around the hits Myers' bit-parallel distance finds the best substring. Each document gets, for every item found in it, the
least distance and the first place that has it, in code points of the original text.

Null and empty texts hold nothing; items without a word are in nothing. Rows with equal item ids count as one
item (best match). Repeated documents and null ids keep their rows; further columns pass unseen. The benchmark
goes to the driver and the tasks in parts of about ``PART_CHARS`` characters, whatever its size: each further part is one
more pass over the documents, whose result is written before the next part is collected.
"""

from __future__ import annotations

import bisect
import functools
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, scratch

RATE = 0.07
PART_CHARS = 4_000_000
_WORD = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(least distance, first end) of the pattern against any substring of the text."""
    masks = char_masks(pattern) if masks is None else masks
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    get = masks.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        x = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, j
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(x | plus))
        down = plus & x
    return best, end


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Finds items in normalised texts."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        import ahocorasick

        self.items = [(key, text, int(rate * len(text)), char_masks(text)) for key, text in items if text]
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, k, _) in enumerate(self.items):
            for offset, piece in pieces(text, k):
                where.setdefault(piece, []).append((i, offset))
        self.find = ahocorasick.Automaton()
        for piece, places in where.items():
            self.find.add_word(piece, (len(piece), places))
        if where:
            self.find.make_automaton()
        self.empty = not where

    def matches(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, distance, start, end) of each item's best match, in the normalised text."""
        if self.empty or not text:
            return []
        starts: dict[int, list[int]] = {}
        for end, (size, places) in self.find.iter(text):
            for i, offset in places:
                starts.setdefault(i, []).append(end + 1 - size - offset)
        found: dict[object, tuple[int, int, int]] = {}
        for i, at in starts.items():
            key, item, k, masks = self.items[i]
            best = self.best(text, item, k, masks, sorted(set(at)))
            if best and (key not in found or best < found[key]):
                found[key] = best
        return [(key, *best) for key, best in found.items()]

    @staticmethod
    def best(text: str, item: str, k: int, masks: dict[str, int], at: list[int]) -> tuple[int, int, int] | None:
        n = len(item)
        for start in at:  # an exact copy needs no distance
            if start >= 0 and text.startswith(item, start):
                return 0, start, start + n
        if not k:
            return None
        best = None
        i = 0
        while i < len(at):
            j = i
            while j + 1 < len(at) and at[j + 1] - at[j] <= 2 * k:  # windows that overlap anyway, once
                j += 1
            low, high = max(0, at[i] - k), at[j] + n + k
            distance, end = myers(item, text[low:high], masks)
            if distance <= k and (best is None or distance < best[0]):
                # The start: the same search backwards from the end.
                back = text[max(0, low + end - n - k) : low + end][::-1]
                _, length = myers(item[::-1], back)
                best = (distance, low + end - length, low + end)
            i = j + 1
        return best


def original_places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Offsets in ``normal(text)`` to code points of ``text`` (whole words where a span cuts one)."""
    lowered = text.lower()
    words = [m.span() for m in _WORD.finditer(lowered)]
    if len(lowered) != len(text):  # lower-casing can lengthen a text
        back = [i for i, c in enumerate(text) for _ in c.lower()]
        words = [(back[a], back[b - 1] + 1) for a, b in words]
    starts, at = [], 0
    for m in _WORD.finditer(lowered):
        starts.append(at)
        at += m.end() - m.start() + 1
    out = []
    for a, b in spans:
        first = bisect.bisect_right(starts, a) - 1
        last = max(first, bisect.bisect_left(starts, b) - 1)
        out.append((words[first][0], words[last][1]))
    return out


def _scans(spark, benchmark: DataFrame, item_id: str, item_text: str, rate: float, part_chars: int):
    """(whether it is the last, its scanning function) for each part of the benchmark; a part's items reach the driver and
    the tasks together, about ``part_chars`` characters of them. A part is released when the next is asked for: what uses
    it must be written by then."""
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).filter("text is not null").distinct()
    leak = T.StructType([T.StructField("item_id", items.schema["id"].dataType), T.StructField("distance", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_chars))
    for part in range(parts):
        rows = items.filter(F.coalesce(F.pmod(F.xxhash64("id"), F.lit(parts)), F.lit(0)) == part).collect()
        sent = spark.sparkContext.broadcast([(r.id, normal(r.text)) for r in rows])
        del rows
        yield part == parts - 1, _scanner(sent, uuid.uuid4().hex, rate, T.ArrayType(leak))
        if part < parts - 1:
            sent.destroy()
            del sent


_MATCHER: dict[str, Matcher] = {}  # the last one of this Python worker


def _scanner(sent, name: str, rate: float, kind: T.DataType):
    @F.pandas_udf(kind)
    def scan(texts):
        import pandas as pd

        if name not in _MATCHER:
            _MATCHER.clear()
            _MATCHER[name] = Matcher(sent.value, rate)
        matcher, out = _MATCHER[name], []
        for text in texts.fillna(""):
            found = matcher.matches(normal(text))
            places = original_places(text, [(a, b) for _, _, a, b in found]) if found else []
            out.append([{"item_id": key, "distance": d, "start": a, "end": b} for (key, d, _, _), (a, b) in zip(found, places, strict=True)])
        return pd.Series(out)

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE, part_chars: int = PART_CHARS) -> DataFrame:
    """(id, item_id, distance, start, end) for each item in each row of ``docs``. No shuffle of documents."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scans = _scans(docs.sparkSession, benchmark, item_id, item_text, rate, part_chars)
    found = []
    for last, scan in scans:
        leaks = rows.select("id", F.explode(scan(F.col("text"))).alias("l"))
        found.append(leaks if last else scratch(leaks))
        del scan
    found = functools.reduce(DataFrame.unionAll, found)
    return found.select(F.col("id").alias(id_col), "l.item_id", "l.distance", "l.start", "l.end")


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = RATE, part_chars: int = PART_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Between parts of the benchmark the rows are written, so
    that a task holds one part at a time."""
    for last, scan in _scans(docs.sparkSession, benchmark, item_id, item_text, rate, part_chars):
        docs = docs.filter(F.size(scan(F.col(text_col))) == 0)
        docs = docs if last else scratch(docs)
        del scan
    return docs


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
