"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token's bytes are a doubly linked list of symbols. A heap holds every adjacent pair that has a
merge rank, by (rank, position). The lowest live pair is popped and merged until none is left: the
count is the initial number of symbols less the number of merges, and no identifier is made.

Each distinct word (white space and what follows up to the next white space) is counted once per Python
worker and looked up after that. Words are safe units: a pre-token never goes on from a
non-space character into white space. The memory of counted words is bounded (``CACHE_WORDS``);
it is a matter of speed only.

Null texts count as empty (0 bytes, 0 tokens). Repeated rows, null ids and further columns of any name
pass: one row out per row in, with just the given id column and the counts.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UNICODE_SPACE

#: Words whose counts a Python worker keeps; when full it starts over.
CACHE_WORDS = 1_000_000
#: Longer words are counted anew each time, so that the kept words stay small.
CACHE_CHARS = 64

UNIT = re.compile(f"[{UNICODE_SPACE}]*[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+")
#: The byte-level pre-tokenizer's pattern (fixed value of the published tokenizer).
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + UNICODE_SPACE + r"\p{L}\p{N}]+|[" + UNICODE_SPACE + r"]+(?![^" + UNICODE_SPACE + r"])|[" + UNICODE_SPACE + r"]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others get the code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def merges_needed(symbols: list[int], ranks: dict[int, int], made: list[int]) -> int:
    """How many merges byte-pair encoding makes on these symbols (changed in place).

    ``ranks`` maps ``left << 32 | right`` to the rank of the pair, ``made`` a rank to the symbol made.
    """
    n, merged, rank_of = len(symbols), 0, ranks.get
    heap = []
    for i in range(n - 1):
        r = rank_of(symbols[i] << 32 | symbols[i + 1])
        if r is not None:
            heap.append(r << 32 | i)
    if not heap:
        return 0
    heapq.heapify(heap)
    push, pop = heapq.heappush, heapq.heappop
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    while heap:
        entry = pop(heap)
        rank, i = entry >> 32, entry & 0xFFFFFFFF
        left, j = symbols[i], after[i]
        # Stale entries: the symbol at i was merged away (-1), or one of the pair has changed since.
        if left < 0 or j < 0 or rank_of(left << 32 | symbols[j]) != rank:
            continue
        new = symbols[i] = made[rank]
        symbols[j] = -1
        merged += 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            r = rank_of(new << 32 | symbols[k])
            if r is not None:
                push(heap, r << 32 | i)
        h = before[i]
        if h >= 0:
            r = rank_of(symbols[h] << 32 | new)
            if r is not None:
                push(heap, r << 32 | h)
    return merged


class WordCounts(dict):
    """Token count of each word seen so far; computes the missing ones."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left] << 32 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.byte = [vocab[c] for c in byte_symbols()]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.pieces: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        parts = self.split.split(word) if self.split else [word]
        n = len(parts) - 1 + sum(self.piece(p) for part in parts for p in PIECE.findall(part))
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            symbols = [self.byte[b] for b in piece.encode("utf-8")]
            n = len(symbols) - merges_needed(symbols, self.ranks, self.made)
            if len(piece) <= CACHE_CHARS:
                if len(self.pieces) >= CACHE_WORDS // 2:
                    self.pieces.clear()
                self.pieces[piece] = n
        return n


@functools.lru_cache(maxsize=2)
def _counts(path: str) -> WordCounts:
    return WordCounts(path)


def count_text(text: str, path: str) -> int:
    return sum(map(_counts(path).__getitem__, UNIT.findall(text)))


def token_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", path: str | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens) for each row. ``path`` names a byte-level BPE file on every executor; by
    default the installed public tokenizer of that name is used. Narrow: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(path or public_tokenizers.path(tokenizer))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode("utf-8")))
                n_tokens.append(sum(map(counts.__getitem__, UNIT.findall(text))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    from .common import read

    out = token_counts(read(spark, sf_dir, "documents"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)
