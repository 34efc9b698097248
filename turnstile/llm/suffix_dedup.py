"""Removal of repeated byte strings by sorted suffixes: external induced sorting over content-dealt shards.

Every string of ``window`` bytes that starts earlier too loses its bytes. A string's *anchor* is the ``gram``-byte piece of it with the
least hash (the first of equal ones). Strings next to each other that share one place of an anchor make a *piece* of
text, and equal strings have equal anchors; so pieces dealt by anchor meet all their equals in one shard.

1. Anchors: a block of documents gives its distinct anchors; only an anchor that occurs twice in the table matters.
2. Pieces: each block gives its distinct pieces with such anchors once, at their first place; what a block repeats
   itself is marked there. An anchor so has at most as many rows a block as the block has different pieces of it, and a passage
   that is copied in full a million times one row a block.
3. Shards: a task's pieces come sorted by anchor, bytes and place. Of equal pieces all but the first are repeats. Where an
   anchor has different pieces (the edges of shared passages, edited copies), their suffixes are sorted with their
   common prefixes (``induced_sort``): neighbours that share ``window`` bytes are equal strings, and the one of the first place
   stays. Whole anchors are gathered up to ``CHUNK`` bytes; one that is larger by itself, or larger than memory, goes
   through the same sort, whose queues and arrays are on disk beyond its budget.
4. Repeated stretches go back to their blocks, and the covered bytes are removed.

Bytes are UTF-8, so what is kept may not be valid text: it is binary. Strings never cross documents. Null and empty texts have no
bytes. A null id counts as smaller than all others. Rows with equal ids are documents of that id, one before the other
in the order of their blocks and rows; so of equal rows one stays whole. Further columns pass unseen; an empty
table gives no rows. The documents are read more than once and must come in the same order each time (a table does);
else the job fails rather than give a wrong result (``common.scratch`` cures it).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, read, text_blocks
from .induced_sort import BUDGET, array, sort_suffixes

WINDOW = 100
BLOCK_CHARS = 4_000_000
#: Strings whose anchors are found together.
STRETCH = 1 << 18
#: Bytes of pieces sorted together.
CHUNK = 4_000_000
_PLACE = np.uint64((1 << 24) - 1)
_MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def gram_size(window: int) -> int:
    if window < 16:
        raise ValueError("a window has at least 16 bytes")
    return 32 if window >= 64 else 16 if window >= 32 else 8


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` bytes (8, 16 or 32)."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    a, b, c, d = _MULTIPLIERS
    with np.errstate(over="ignore"):
        if gram >= 16:
            words = words[:-8] * a + words[8:] * b
            words ^= words >> np.uint64(29)
        if gram == 32:
            words = words[:-16] * c + words[16:] * d
    return mix(words)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def pieces(data: np.ndarray, ends: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For stretches of the bytes of documents that end at ``ends``: (start, stop, anchor) of their pieces."""
    gram = gram_size(window)
    for first in range(0, len(data), STRETCH):
        part = data[first : first + STRETCH + window - 1]
        hashes = _gram_hashes(part, gram)
        if len(part) < window:
            return
        # The hash without its low bits, then the place: the least is the first of equal ones.
        keys = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)
        place = (_sliding_min(keys, window - gram + 1) & _PLACE).astype(np.int64)
        at = first + np.arange(len(place))
        inside = at + window <= ends[np.searchsorted(ends, at, side="right")]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
        cuts = np.flatnonzero(new | ~inside)
        stops = np.append(cuts[1:], len(place))
        begins = inside[cuts]
        yield at[cuts[begins]], first + stops[begins] + window - 1, hashes[place[cuts[begins]]]


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(np.array([len(r) for r in raw], np.int64))


def _anchors(window: int, chars: int):
    """(anchor, block): each distinct anchor of a block, twice if the block has it more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, texts in text_blocks(batches, chars):
            data, ends = _joined(texts)
            found = [np.zeros(0, np.uint64), *(a for _, _, a in pieces(data, ends, window))]
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            values = np.repeat(values, np.minimum(counts, 2)).view(np.int64)
            for i in range(0, len(values), 50_000):
                some = values[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), key))], names=["anchor", "block"])

    return run


def _packed(chars: int):
    """One row a block: its ids and its texts, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=5)
        for key, ids, texts in text_blocks(batches, chars):
            data, ends = _joined(texts)
            columns = [pa.array([key], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([ends.tobytes()], pa.binary()), pa.array([squeeze.compress(data.tobytes())], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "ends", "data"])

    return run


def _unpacked(blocks: pa.Table) -> tuple[int, pa.Array, np.ndarray, np.ndarray]:
    """(block, ids, bytes, where each document ends)."""
    if blocks.num_rows != 1:
        raise RuntimeError("the input gave other rows when it was read again; write it first")
    ends = np.frombuffer(blocks.column("ends")[0].as_py(), np.int64)
    data = zstandard.ZstdDecompressor().decompress(blocks.column("data")[0].as_py())
    return blocks.column("block")[0].as_py(), blocks.column("ids").combine_chunks().flatten(), np.frombuffer(data, np.uint8), ends


def _spans(pairs: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(pairs, np.int64).tobytes())


def _read_spans(column: pa.ChunkedArray) -> np.ndarray:
    parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), np.int64).reshape(-1, 2) for x in column]
    return np.concatenate([np.zeros((0, 2), np.int64), *parts])


_PIECES = "anchor long, data binary, doc long, block long, at long, spans binary"
_PIECE_SCHEMA = pa.schema([("anchor", pa.int64()), ("data", pa.binary()), ("doc", pa.int64()), ("block", pa.int64()), ("at", pa.int64()), ("spans", pa.binary())])


def _piece_rows(window: int):
    """A block and its repeated anchors to its distinct pieces at their first places, and one row (without data) with the stretches of
    the others, which are repeats whatever other blocks hold."""

    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        key, ids, data, ends = _unpacked(blocks)
        repeated = np.unique(anchors.column("anchor").to_numpy().view(np.uint64))
        if not len(repeated):
            return _PIECE_SCHEMA.empty_table()
        start, stop, anchor = (np.concatenate(x) for x in zip(*pieces(data, ends, window), strict=True))
        place = np.minimum(np.searchsorted(repeated, anchor), len(repeated) - 1)
        some = np.flatnonzero(repeated[place] == anchor)
        start, stop, anchor = start[some], stop[some], anchor[some]
        docs = ids.cast(pa.int64())
        owner = np.searchsorted(ends, start, side="right")
        by_doc = docs.fill_null(-(2**63)).to_numpy(zero_copy_only=False)[owner]
        order = np.lexsort((start, by_doc))
        whole = data.tobytes()
        seen: set[bytes] = set()
        first, again, held = [], [], []
        for i, a, b in zip(order.tolist(), start[order].tolist(), stop[order].tolist(), strict=True):
            piece = whole[a:b]
            if piece in seen:
                again.append((a, b))
            else:
                seen.add(piece)
                first.append(i), held.append(piece)
        chosen = np.array(first, np.int64)
        n = len(chosen)
        columns = [
            pa.array(np.append(anchor[chosen].view(np.int64), key)), pa.array([*held, None], pa.binary()), docs.take(pa.array(np.append(owner[chosen], 0))),
            pa.array(np.full(n + 1, key)), pa.array(np.append(start[chosen], 0)), pa.array([None] * n + [_spans(np.array(again, np.int64).reshape(-1, 2))], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, schema=_PIECE_SCHEMA)

    return run


class _Growing:
    """Values that are appended; beyond ``budget`` they are in a file."""

    def __init__(self, dtype, budget: int):
        self.dtype, self.budget, self.held, self.size, self.file = np.dtype(dtype), budget, [], 0, None
        self.waiting = 0

    def append(self, values) -> None:
        values = np.asarray(values, self.dtype)
        self.held.append(values)
        self.size += len(values)
        self.waiting += len(values)
        if self.waiting > self.budget:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(np.concatenate(self.held).tobytes())
            self.held, self.waiting = [], 0

    def whole(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate([np.zeros(0, self.dtype), *self.held])
        self.file.write(np.concatenate([np.zeros(0, self.dtype), *self.held]).tobytes())
        self.file.flush()
        return np.memmap(self.file, self.dtype, "r+", shape=(self.size,))


class Shard:
    """Different pieces of some anchors, in one text for the suffix sort."""

    def __init__(self, window: int, budget: int):
        self.window, self.budget = window, budget
        self.text = _Growing(np.uint16, budget)
        self.facts = _Growing(np.int64, budget)  # of each piece: where it ends in the text, block, place, rank
        self.n = 0

    def add(self, anchors_pieces: list[tuple[bytes, int, int, int]]) -> None:
        """The pieces (bytes, document, block, place) of one anchor."""
        order = sorted(range(len(anchors_pieces)), key=lambda i: anchors_pieces[i][1:])
        for rank, i in enumerate(order):
            data, _, block, at = anchors_pieces[i]
            self.text.append(np.frombuffer(data, np.uint8).astype(np.uint16) + 2)
            self.text.append([1])
            self.facts.append([self.text.size - 1, block, at, rank])
            self.n += 1

    def repeats(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(block, start, stop) of the stretches whose strings start earlier too."""
        if not self.n:
            return
        self.text.append([0])
        text = self.text.whole()
        facts = self.facts.whole().reshape(-1, 4)
        ends = np.ascontiguousarray(facts[:, 0])
        positions, shared = sort_suffixes(text, 258, self.window, self.budget)
        n = len(text)
        marked = array(n + 1, bool, self.budget)
        marked[:] = False
        step, low = max(1 << 20, self.budget // 4), 0
        while low < n:
            high = min(low + step, n)
            while high < n and shared[high] >= self.window:  # not inside equal strings
                high += 1
            at, equal = np.asarray(positions[low:high]), np.asarray(shared[low:high]) >= self.window
            low = high
            equal[:1] = False
            some = equal.copy()
            some[:-1] |= equal[1:]
            at, equal = at[some], equal[some]
            if not len(at):
                continue
            piece = np.searchsorted(ends, at)
            piece[piece == len(ends)] = 0  # the last symbol
            whole = at + self.window <= ends[piece]
            rank = np.where(whole, facts[piece, 3], 0)
            starts = np.flatnonzero(~equal)
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(at)))
            again = whole & (rank > np.repeat(least, sizes))
            marked[at[again]] = True
        for low in range(0, n + 1, 1 << 22):  # stretches of marked places, which no piece's end is
            upto = min(low + (1 << 22), n + 1)
            here = np.zeros(upto - low + 2, np.int8)
            here[1:-1] = marked[low:upto]
            edges = np.diff(here)
            start, stop = low + np.flatnonzero(edges == 1), low + np.flatnonzero(edges == -1)
            if not len(start):
                continue
            piece = np.searchsorted(ends, start)
            begin = np.where(piece > 0, ends[piece - 1] + 1, 0)
            shift = facts[piece, 2] - begin
            yield facts[piece, 1], start + shift, stop - 1 + self.window + shift


def _by_block(block: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(block, kind="stable")
    block, pairs = block[order], np.stack([start[order], stop[order]], axis=1)
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(block[cuts], pa.int64()), pa.array([_spans(p) for p in np.split(pairs, cuts[1:])] if len(cuts) else [], pa.binary())], names=["block", "spans"])


def _shards(window: int, chunk: int, budget: int):
    """Pieces sorted by anchor, bytes and place to the repeated stretches of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, group, anchor, last = Shard(window, budget), [], None, None
        again: list[tuple[int, int, int]] = []

        def equal_pieces() -> pa.RecordBatch:
            rows = np.array(again, np.int64).reshape(-1, 3)
            again.clear()
            return _by_block(*rows.T)

        for batch in batches:
            for a, data, doc, block, at, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if data is None:
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([spans], pa.binary())], names=["block", "spans"])
                    continue
                if a != anchor:
                    if len(group) > 1:
                        shard.add(group)
                        if shard.text.size >= chunk:
                            for found in shard.repeats():
                                yield _by_block(*found)
                            shard = Shard(window, budget)
                    group, anchor, last = [], a, None
                if data == last:
                    again.append((block, at, at + len(data)))
                    if len(again) >= 100_000:
                        yield equal_pieces()
                else:
                    group.append((data, -(2**63) if doc is None else doc, block, at))
                    last = data
        if len(group) > 1:
            shard.add(group)
        for found in shard.repeats():
            yield _by_block(*found)
        if again:
            yield equal_pieces()

    return run


_OUT = "id long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>"


def _kept(blocks: pa.Table, repeats: pa.Table) -> pa.Table:
    """A block and its repeated stretches to one row a document."""
    _, ids, data, ends = _unpacked(blocks)
    pairs = _read_spans(repeats.column("spans"))
    steps = np.zeros(len(data) + 1, np.int32)
    np.add.at(steps, pairs[:, 0], 1)
    np.add.at(steps, pairs[:, 1], -1)
    removed = np.cumsum(steps[:-1]) > 0
    begins = np.append(0, ends[:-1]) if len(ends) else ends
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = edge[ends] = True
    starts = np.flatnonzero(removed & (edge[:-1] | ~np.append(False, removed[:-1])))
    stops = 1 + np.flatnonzero(removed & (edge[1:] | ~np.append(removed[1:], False)))
    owner = np.searchsorted(ends, starts, side="right")
    gone = np.append(0, np.cumsum(removed))
    n_removed = gone[ends] - gone[begins]
    kept = data[~removed].tobytes()
    upto = (ends - gone[ends]).tolist()
    places = pa.StructArray.from_arrays([pa.array(starts - begins[owner]), pa.array(stops - begins[owner])], names=["start", "stop"])
    offsets = np.searchsorted(owner, np.arange(len(ends) + 1))
    return pa.Table.from_arrays(
        [ids.cast(pa.int64()), pa.array([kept[a:b] for a, b in zip([0, *upto], upto, strict=False)], pa.binary()), pa.array(ends - begins), pa.array(n_removed), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), places)],
        names=["id", "kept", "n_bytes", "n_removed", "spans"],
    )


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS, chunk: int = CHUNK, budget: int = BUDGET) -> DataFrame:
    """(id, kept, n_bytes, n_removed, spans): of each row the bytes that stay, and the stretches of bytes that go. Ids must be
    integers. ``chunk`` bytes of pieces are sorted together; ``budget`` numbers of a sort are in memory."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    anchors = rows.mapInArrow(_anchors(window, block_chars), "anchor long, block long")
    count = F.count(F.lit(1)).over(Window.partitionBy("anchor"))
    repeated = anchors.withColumn("n", count).filter("n > 1").select("block", "anchor")
    packed = rows.mapInArrow(_packed(block_chars), "block long, ids array<long>, ends binary, data binary")
    found = packed.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_piece_rows(window), _PIECES)
    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "data", "doc", "block", "at")
    repeats = dealt.mapInArrow(_shards(window, chunk, budget), "block long, spans binary")
    out = packed.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(_kept, _OUT)
    return out.withColumnRenamed("id", id_col)


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
