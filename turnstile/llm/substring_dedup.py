"""Exact removal of long repeated passages: a de Bruijn graph of token k-mers.

A window of ``WINDOW`` words is an edge of the graph (from its first 19-word node to its last). Only repeated
edges matter, and they are found in three steps, over *blocks* of documents (about ``BLOCK_CHARS`` characters):

1. Anchors: the least hash of the ``ANCHOR``-word k-mers of each window. Equal windows have the same anchor, so an edge can
   be repeated only if its anchor is. A block gives each distinct anchor once, with its count; a window over
   the anchor finds the repeated ones, which go back to their blocks.
2. Edges: a block gives each distinct edge with a repeated anchor once, at its first place (128-bit hash, document, block,
   word). Dealt by hash, an edge's places are ordered by document; every place but the first is a repeat.
3. Paths: repeats go back to their blocks, where they meet the words by their source coordinates. Edges at
   adjacent coordinates compact into paths, and the words a path covers are removed.

An edge or anchor has at most one row a block, so that no key is hot, however often a passage is repeated in
a document or a block. Documents travel as compressed blocks, twice.

Null and empty texts have no words. A null id counts as smaller than all others. Rows with equal ids count as
documents of that id, one before the other in the order of their blocks and rows, so that of equal rows one stays whole. Further
columns pass unseen. As the documents are read three times, they must come in the same order each time (a
table does); else the blocks' keys differ and the job fails (``common.scratch`` cures it).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, ascii_words, mix, prefix_hash, read, span_hash, text_blocks

WINDOW, ANCHOR = 20, 6
BLOCK_CHARS = 8_000_000
#: Documents of a block are hashed together up to so many words at a time.
GROUP_WORDS = 400_000
_SECOND = np.uint64(0xA24BAED4963EE407)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


class Hashed:
    """Windows of some documents' words: where each starts, its anchor, and the anchors place by place."""

    def __init__(self, lengths: np.ndarray, words: np.ndarray, offset: int, window: int, anchor: int):
        self.prefix, self.window = prefix_hash(words), window
        # The second hash sees the words under another mixing.
        self.words, self.offset = words, offset
        self.start, self.anchor, self.chosen = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(words) < window:
            return
        at = np.arange(len(words) - anchor + 1)
        grams = span_hash(self.prefix, at, at + anchor)
        least = _sliding_min(grams, window - anchor + 1)
        ends = np.repeat(np.cumsum(lengths), lengths)  # of each word's document
        inside = np.arange(len(least)) + window <= ends[: len(least)]
        self.start = np.flatnonzero(inside)
        self.anchor = least[self.start]
        # A k-mer's place is an anchor's place if it is the least of some window over it: if the greatest least of
        # those windows is its own hash.
        pad = np.zeros(window - anchor, np.uint64)
        greatest = ~_sliding_min(~np.concatenate([pad, np.where(inside, least, np.uint64(0)), pad]), window - anchor + 1)
        self.chosen = grams[greatest == grams]

    def edges(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = span_hash(self.prefix, start, start + self.window)
        second = span_hash(prefix_hash(mix(self.words ^ _SECOND)), start, start + self.window)
        return first, second


def _hashed(texts: list[str], hashes: WordHashes, window: int, anchor: int) -> Iterator[tuple[int, np.ndarray, Hashed]]:
    """(first document, words of each, windows) for groups of documents."""
    held: list[list[bytes]] = []
    first, offset, size = 0, 0, 0

    def group():
        lengths = np.array([len(w) for w in held], np.int64)
        return first, lengths, Hashed(lengths, np.concatenate([hashes.of(w) for w in held]), offset, window, anchor)

    for i, text in enumerate(texts):
        words = ascii_words(text)
        held.append(words)
        size += len(words)
        if size >= GROUP_WORDS:
            yield group()
            held, first, offset, size = [], i + 1, offset + size, 0
    if held:
        yield group()


def _anchor_rows(window: int, anchor: int, chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for key, _, texts in text_blocks(batches, chars):
            found = []
            for _, _, h in _hashed(texts, hashes, window, anchor):
                found.append(h.chosen)
            values, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            for i in range(0, len(values), 50_000):
                some = values[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(np.full(len(some), key)), pa.array(np.minimum(counts[i : i + 50_000], 2).astype(np.int32))], names=["anchor", "block", "n"])

    return run


def _packed(chars: int):
    """One row a block: its ids and its texts, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for key, ids, texts in text_blocks(batches, chars):
            raw = [t.encode("utf-8") for t in texts]
            sizes = np.array([len(r) for r in raw], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([sizes.tobytes()], pa.binary()), pa.array([squeeze.compress(b"".join(raw))], pa.binary())], names=["block", "ids", "sizes", "data"])

    return run


def _unpacked(blocks: pa.Table) -> tuple[int, pa.Array, list[str]]:
    if blocks.num_rows != 1:
        raise RuntimeError("the input gave other rows when it was read again; write it first")
    ids = blocks.column("ids").combine_chunks().flatten()
    data = zstandard.ZstdDecompressor().decompress(blocks.column("data")[0].as_py())
    ends = np.cumsum(np.frombuffer(blocks.column("sizes")[0].as_py(), np.int64)).tolist()
    return blocks.column("block")[0].as_py(), ids, [data[a:b].decode("utf-8") for a, b in zip([0, *ends], ends, strict=False)]


_EDGES = "w1 long, w2 long, doc long, block long, at int, mask binary"


def _edge_rows(window: int, anchor: int):
    """A block and its repeated anchors to its distinct candidate edges at their first places, and one row with the places of
    the others (``mask``), which are repeats whatever other blocks hold."""

    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        key, ids, texts = _unpacked(blocks)
        repeated = np.sort(anchors.column("anchor").to_numpy().view(np.uint64))
        docs = ids.cast(pa.int64())
        order = np.argsort(docs.fill_null(-(2**63)).to_numpy(zero_copy_only=False), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        w1, w2, at, owner = [], [], [], []
        if len(repeated):
            for first, lengths, h in _hashed(texts, WordHashes(), window, anchor):
                place = np.minimum(np.searchsorted(repeated, h.anchor), len(repeated) - 1)
                start = h.start[repeated[place] == h.anchor]
                a, b = h.edges(start)
                w1.append(a), w2.append(b), at.append(start + h.offset)
                owner.append(first + np.repeat(np.arange(len(lengths)), lengths)[start])
        if not at:
            return pa.Table.from_batches([], pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc", pa.int64()), ("block", pa.int64()), ("at", pa.int32()), ("mask", pa.binary())]))
        w1, w2, at, owner = map(np.concatenate, (w1, w2, at, owner))
        by = np.lexsort((at, rank[owner], w2, w1))
        new = np.ones(len(by), bool)
        new[1:] = (w1[by][1:] != w1[by][:-1]) | (w2[by][1:] != w2[by][:-1])
        chosen, again = by[new], np.sort(at[by[~new]]).astype("<i4")
        n = len(chosen)
        mask = [None] * n + [zstandard.ZstdCompressor().compress(np.diff(again, prepend=np.int32(0)).astype("<i4").tobytes())]
        doc = docs.take(pa.array(np.append(owner[chosen], 0)))
        return pa.Table.from_arrays(
            [pa.array(np.append(w1[chosen].view(np.int64), key)), pa.array(np.append(w2[chosen].view(np.int64), -1)), doc, pa.array(np.full(n + 1, key)), pa.array(np.append(at[chosen], -1).astype(np.int32)), pa.array(mask, pa.binary())],
            names=["w1", "w2", "doc", "block", "at", "mask"],
        )

    return run


def paths(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges at adjacent or overlapping places, in order, to (first word, end) of what they cover."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])] + window


def _kept(window: int):
    """A block and its repeats to one row a document."""

    def run(blocks: pa.Table, repeats: pa.Table) -> pa.Table:
        _, ids, texts = _unpacked(blocks)
        parts = [repeats.column("at").to_numpy()[repeats.column("mask").is_null().to_numpy()]]
        for mask in repeats.column("mask").drop_null():
            parts.append(np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(mask.as_py()), "<i4")))
        starts = np.unique(np.concatenate(parts).astype(np.int64)) if parts else np.zeros(0, np.int64)
        begin, end = paths(starts, window)
        n_words, n_removed, kept = [], [], []
        offset = at = 0
        for text in texts:
            words = ascii_words(text)
            stop = offset + len(words)
            rest, last, gone = [], 0, 0
            # A path never crosses a document's end: its windows do not; but two documents' paths may touch.
            while at < len(begin) and begin[at] < stop:
                a, b = int(begin[at]) - offset, min(int(end[at]), stop) - offset
                rest += words[last:a]
                last, gone = b, gone + b - a
                if end[at] > stop:
                    begin[at] = stop
                    break
                at += 1
            rest += words[last:]
            n_words.append(len(words)), n_removed.append(gone), kept.append(b" ".join(rest).decode("utf-8"))
            offset = stop
        return pa.Table.from_arrays([ids, pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=["id", "text", "n_words", "n_removed"])

    return run


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, text, n_words, n_removed): the kept words of each row joined by one space. Ids must be integers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    anchors = rows.mapInArrow(_anchor_rows(window, anchor, block_chars), "anchor long, block long, n int")
    total = F.sum("n").over(Window.partitionBy("anchor"))
    repeated = anchors.withColumn("total", total).filter("total > 1").select("block", "anchor")
    packed = rows.mapInArrow(_packed(block_chars), "block long, ids array<long>, sizes binary, data binary")
    edges = packed.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_edge_rows(window, anchor), _EDGES)
    place = F.row_number().over(Window.partitionBy("w1", "w2").orderBy("doc", "block", "at"))
    repeats = edges.withColumn("place", place).filter("place > 1 or mask is not null").select("block", "at", "mask")
    out = packed.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(_kept(window), "id long, text string, n_words long, n_removed long")
    return out.withColumnRenamed("id", id_col)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
