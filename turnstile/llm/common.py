"""Helpers that several operators share: reading tables, word patterns, hashing, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: White space as the byte-level pre-tokenizer sees it (Unicode White_Space).
UNICODE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word of the contracts: anything between ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The same in Java's and RE2's regular expressions.
WORD_SQL = r"[^\x20\x09-\x0D]+"

#: Of whole texts: what goes to Python at once, the rows that are decoded from Parquet at once, and what a writer gathers.
BATCH_BYTES, READ_ROWS, ROW_GROUP_BYTES = 2 << 20, 256, 16 << 20

_ODD = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts are read, written and go to Python some MB at a time: each task holds such a batch, the last on both
    sides, and the memory that an executor has taken for large ones stays taken in the stages after."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
    spark.conf.set("parquet.block.size", ROW_GROUP_BYTES)


def hand_back() -> None:
    """Give the system the free memory that this process, a worker or the driver, has kept from what it ran before."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim is not None:
        trim(0)


def _shared(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of its own only where the session names none on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named or f"/tmp/turnstile-{uuid.uuid4().hex}"


def scratch(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: a lost executor then costs a read."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name in the shared folder."""
    return f"{spark.sparkContext.getCheckpointDir() or _shared(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Like ``scratch``, but as a Parquet table: a plan without a shuffle at its end runs once, not twice, and columns
    that are not asked for are not read. ``forget`` removes it."""
    spark = df.sparkSession
    at = scratch_dir(spark)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def forget(df: DataFrame) -> None:
    """Remove a table of ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def packed(values: list[int] | np.ndarray) -> bytes:
    """Byte planes of 32-bit integers, compressed: small where most values are."""
    planes = np.asarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 over uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown by need."""

    def __init__(self, base: int):
        self.up = self.down = np.ones(1, np.uint64)
        self.base = base

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = 1 << (n - 1).bit_length()

            def powers(b: int) -> np.ndarray:
                out = np.full(m, np.uint64(b), np.uint64)
                out[0] = 1
                with np.errstate(over="ignore"):
                    return np.cumprod(out, dtype=np.uint64)

            self.up, self.down = powers(self.base), powers(pow(self.base, -1, 1 << 64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers(_ODD)


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i`` modulo 2**64, one longer than ``values``."""
    up, _ = _POWERS.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up[: len(values)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of each ``values[start:stop]`` from ``prefix_hash(values)``."""
    _, down = _POWERS.upto(len(prefix))
    with np.errstate(over="ignore"):
        return mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))


class WordHashes(dict):
    """64-bit hash of each word seen (as bytes); starts over when it holds ``most`` words."""

    def __init__(self, most: int = 200_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str) -> list[bytes]:
    """Words between ASCII white space (x20, x09 to x0D), as UTF-8."""
    return text.encode("utf-8").split()


def text_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Array, list[str]]]:
    """(key, ids, texts) of blocks of (id, text) rows, of about ``most`` characters. The key is made of the content
    and of the block's place, so that a second reading in another order gives other keys."""
    part, made = TaskContext.get().partitionId(), 0
    ids: list[pa.Array] = []
    texts: list[str] = []
    size, digest = 0, xxhash.xxh64()

    def flush() -> tuple[int, pa.Array, list[str]]:
        nonlocal made, digest
        made += 1
        digest.update(f"{part}:{made}")
        out = digest.intdigest() - (1 << 63), pa.concat_arrays(ids), texts[:]
        digest = xxhash.xxh64()
        ids.clear(), texts.clear()
        return out

    for batch in batches:
        start = 0
        for i, value in enumerate(batch.column(1)):
            text = value.as_py() or ""
            texts.append(text)
            digest.update(text.encode("utf-8"))
            size += len(text) + 1
            if size >= most:
                ids.append(batch.column(0).slice(start, i + 1 - start))
                yield flush()
                size, start = 0, i + 1
        if start < batch.num_rows:
            ids.append(batch.column(0).slice(start))
    if texts:
        yield flush()
