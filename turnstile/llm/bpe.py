"""Byte-pair encoding and decoding through a distinct-word table.

Documents are read in *blocks* (rows of one task up to ``BLOCK_CHARS`` characters). A word is white space and
what follows up to the next white space; pre-tokens never cross its borders. A block gives

- its distinct words, dealt by hash into buckets, one compressed row for each bucket;
- its layout: for each document the positions of its words in the block's word list, compressed.

All rows of a bucket meet in one task, which keeps that part of the distinct-word table: each distinct word is
encoded once, and its ids go back in the place of the word. A block's ids then meet its layout and are joined back by
position. A word has at most one place a block, so no word is hot however often it occurs, and the
buckets grow in number with ``spark.sql.shuffle.partitions``. The texts themselves are not shuffled, only layouts
(some bits a word) and distinct words.

Decoding joins ids to their pieces: the piece table (the vocabulary, one row an id) goes to every
task, and since ids are dense the join is an array lookup. ``pieces_table`` gives it as a DataFrame.

Ids are a binary column of little-endian unsigned 32-bit integers; ``as_ints`` makes an array of it. Null texts
count as empty (no ids), null ids decode to an empty text. Rows come back one for one, with equal and null document ids too, in
any order. Further columns pass unseen. The words and the layout are made in two passes: if the rows of ``docs``
come in another order the second time (a plan that is not deterministic), the blocks' keys differ and the job fails
rather than mix them; such inputs should be written first (``common.scratch``).
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UNICODE_SPACE, hand_back, packed, read, unpacked
from .token_count import byte_symbols

BLOCK_CHARS = 6_000_000
BUCKETS_A_PARTITION = 4
WORDS = re.compile(f"[{UNICODE_SPACE}]*[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+")
NAME = "byte_bpe_50k.json"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=2)
def _vocab_size(path: str) -> int:
    """The tokenizer itself is not kept: the driver needs only this number of it."""
    size = _tokenizer.__wrapped__(path).get_vocab_size()
    hand_back()
    return size


def pieces(path: str) -> list[bytes]:
    """The bytes of each id, special tokens included."""
    tokenizer = _tokenizer(path)
    byte = {c: b for b, c in enumerate(byte_symbols())}
    special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = [b""] * tokenizer.get_vocab_size()
    for text, i in tokenizer.get_vocab().items():
        out[i] = text.encode("utf-8") if i in special else bytes(byte[c] for c in text)
    return out


@functools.lru_cache(maxsize=2)
def _piece_arrays(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces' bytes, and where each begins and how long it is; one empty piece more at the end."""
    table = [*pieces(path), b""]
    size = np.array([len(p) for p in table], np.int64)
    return np.frombuffer(b"".join(table), np.uint8), np.cumsum(size) - size, size


def pieces_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(pieces(path))), "id int, piece binary")


def _own(values: pa.Array) -> pa.Array:
    """A copy: a slice would hold the memory of its whole batch, texts included."""
    return pa.array(values.to_pylist(), values.type)


def _blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_CHARS) -> Iterator[tuple[int, pa.Array, list[int], list[int], list[str]]]:
    """(key, document ids, words of each document, word positions, distinct words) of each block of (id, text) rows."""
    part, made = TaskContext.get().partitionId(), 0
    ids: list[pa.Array] = []
    lengths: list[int] = []
    size, stream, seen, content = 0, [], None, None

    def flush():
        nonlocal made
        made += 1
        content.update(f"{part}:{made}")
        key = content.intdigest() - (1 << 63)
        return key, pa.concat_arrays(ids), lengths[:], stream, list(seen)

    for batch in batches:
        start = 0
        for i, value in enumerate(batch.column(1)):
            text = value.as_py() or ""
            if seen is None:
                seen, stream, content = defaultdict(), [], xxhash.xxh64()
                seen.default_factory = seen.__len__
            words = WORDS.findall(text)
            stream += map(seen.__getitem__, words)
            lengths.append(len(words))
            content.update(text.encode("utf-8", "surrogatepass"))
            size += len(text) + 1
            if size >= most:
                ids.append(_own(batch.column(0).slice(start, i + 1 - start)))
                yield flush()
                ids.clear(), lengths.clear()
                size, start, seen = 0, i + 1, None
        if start < batch.num_rows:
            ids.append(_own(batch.column(0).slice(start)))
    if seen is not None:
        yield flush()


def _bucket(words: list[bytes], buckets: int) -> np.ndarray:
    return (np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(buckets)).astype(np.int32)


def _squeezed(sizes: np.ndarray, data: bytes) -> bytes:
    """Slices of ``data``: how many, their sizes, the bytes; compressed."""
    return zstandard.ZstdCompressor(level=3).compress(np.int32(len(sizes)).tobytes() + sizes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes() + data)


def _loosened(value: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, "<i4", 1)[0])
    planes = np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").ravel(), raw[4 + 4 * n :]


def _word_rows(buckets: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        for key, _, _, _, words in _blocks(batches, most):
            raw = [w.encode("utf-8") for w in words]
            bucket = _bucket(raw, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist()
            out_bucket, out = [], []
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=False):  # none at all in a block without words
                some = [raw[i] for i in order[a:b].tolist()]
                out_bucket.append(int(bucket[order[a]]))
                out.append(_squeezed(np.fromiter(map(len, some), np.int64, len(some)), b"".join(some)))
            yield pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array([key] * len(out), pa.int64()), pa.array(out, pa.binary())], names=["bucket", "block", "words"])

    return run


def _layout_rows(buckets: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        for key, ids, lengths, stream, words in _blocks(batches, most):
            bucket = _bucket([w.encode("utf-8") for w in words], buckets)
            whole = pa.ListArray.from_arrays([0, len(ids)], ids)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), whole, *(pa.array([packed(x)], pa.binary()) for x in (bucket, lengths, stream))], names=["block", "ids", "buckets", "lengths", "stream"])

    return run


def _encode_buckets(path: str | None, name: str):
    """Rows in the order of their bucket to (block, bucket, ids): every distinct word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        tokenizer = _tokenizer(path or public_tokenizers.path(name))
        kind = _id_type(tokenizer.get_vocab_size())
        current, table = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = batch.column(0)[i].as_py()
                if bucket != current:
                    current, table = bucket, {}
                sizes, data = _loosened(batch.column(2)[i].as_py())
                ends = np.cumsum(sizes).tolist()
                words = [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                fresh = [w for w in words if w not in table]
                for w, e in zip(fresh, tokenizer.encode_batch([w.decode("utf-8") for w in fresh], add_special_tokens=False), strict=True):
                    table[w] = np.asarray(e.ids, kind).tobytes()
                found = [table[w] for w in words]
                packed = _squeezed(np.fromiter(map(len, found), np.int64, len(found)), b"".join(found))
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), batch.column(1).slice(i, 1), pa.array([packed], pa.binary())], names=["bucket", "block", "ids"])

    return run


def _id_type(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


def ragged(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``data[starts[i]:starts[i] + lengths[i]]`` one after another."""
    total = int(lengths.sum())
    begins = np.cumsum(lengths) - lengths
    return data[np.repeat(starts - begins, lengths) + np.arange(total)]


def _strings(kind: pa.DataType, sizes: np.ndarray, data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _join_back(kind: str, decoded: bool, path: str | None, name: str):
    """A block's layout and its words' ids to one row a document: id, ids, and the decoded text if asked for."""
    names = ["id", "ids", "text"][: 3 if decoded else 2]

    def run(layouts: pa.Table, words: pa.Table) -> pa.Table:
        out = []
        bucket = unpacked(layouts.column("buckets")[0].as_py()) if layouts.num_rows == 1 else None
        parts = [_loosened(words.column("ids")[int(i)].as_py()) for i in np.argsort(words.column("bucket").to_numpy())]
        sizes = np.concatenate([np.zeros(0, np.int64), *(s for s, _ in parts)]).astype(np.int64)
        if bucket is None or len(bucket) != len(sizes):
            raise RuntimeError("the input gave other rows when it was read again; write it first")
        raw = np.frombuffer(b"".join(d for _, d in parts), kind)
        sizes //= raw.itemsize
        # Words stand by bucket, then position in the block's list.
        at = np.argsort(bucket, kind="stable")
        begin, size = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        begin[at], size[at] = np.cumsum(sizes) - sizes, sizes
        ids = layouts.column("ids").combine_chunks().flatten()
        lengths, stream = unpacked(layouts.column("lengths")[0].as_py()).astype(np.int64), unpacked(layouts.column("stream")[0].as_py())
        ends = np.cumsum(lengths)
        # A few documents at a time: the positions of all tokens of a block would be large.
        first = 0
        while first < len(lengths):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + 400_000, side="right")))
            part = stream[ends[first] - lengths[first] : ends[last - 1]]
            tokens = ragged(raw, begin[part], size[part]).astype("<u4")
            per_word = np.concatenate([[0], np.cumsum(size[part])])
            n = np.diff(per_word[np.concatenate([[0], np.cumsum(lengths[first:last])])])
            columns = [ids.slice(first, last - first), _strings(pa.binary(), n * 4, tokens.tobytes())]
            if decoded:
                columns.append(pa.array(_decoded(tokens, n, path or public_tokenizers.path(name)), pa.string()))
            out.append(pa.RecordBatch.from_arrays(columns, names=names))
            first = last
        return pa.Table.from_batches(out)

    return run


def _decoded(tokens: np.ndarray, sizes: np.ndarray, path: str) -> list[str]:
    """Joins ids to their pieces; ``sizes`` is how many ids each text has."""
    data, begin, size = _piece_arrays(path)
    out, at = [], 0
    for n in sizes.tolist():
        parts = []
        for i in range(at, at + n, 500_000):  # a long document needs no large index
            key = np.minimum(tokens[i : min(i + 500_000, at + n)], len(size) - 1).astype(np.int64)
            parts.append(ragged(data, begin[key], size[key]).tobytes())
        at += n
        out.append(b"".join(parts).decode("utf-8", "replace"))
    return out


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, tokenizer: str = NAME, path: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, ids) for each row, with ``decoded`` also the text that ``decode`` gives, without a second transfer.
    ``path`` names a byte-level BPE file on every machine; by default the installed public tokenizer is used."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    size = _vocab_size(path or public_tokenizers.path(tokenizer))
    buckets = BUCKETS_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = rows.mapInArrow(_word_rows(buckets, block_chars), "bucket int, block long, words binary")
    table = words.repartition("bucket").sortWithinPartitions("bucket")
    known = table.mapInArrow(_encode_buckets(path, tokenizer), "bucket int, block long, ids binary")
    layout = rows.mapInArrow(_layout_rows(buckets, block_chars), f"block long, ids array<{kind}>, buckets binary, lengths binary, stream binary")
    join = _join_back(_id_type(size), decoded, path, tokenizer)
    joined = layout.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(join, f"id {kind}, ids binary" + ", text string" * decoded)
    return joined.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, *, ids_col: str = "ids", text_col: str = "text", tokenizer: str = NAME, path: str | None = None) -> DataFrame:
    """``tokens`` with the decoded text. Bytes that are not UTF-8 become U+FFFD, as in the library; ids that the
    vocabulary does not have are skipped. Narrow."""

    @F.pandas_udf("string")
    def run(ids):
        import pandas as pd

        ids = [np.frombuffer(v or b"", "<u4") for v in ids]
        return pd.Series([_decoded(x, np.array([len(x)]), path or public_tokenizers.path(tokenizer))[0] for x in ids], dtype=object)

    return tokens.withColumn(text_col, run(F.col(ids_col)))


def as_ints(ids: Column) -> Column:
    """The binary ids as array<int>."""

    @F.pandas_udf("array<int>")
    def run(values):
        return values.map(lambda v: np.frombuffer(v, "<u4").astype(np.int32) if v is not None else None)

    return run(ids)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    both = encode(read(spark, sf_dir, "documents"), decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
