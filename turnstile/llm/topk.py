"""Exact top-k inner products over norm-sorted blocks.

Components become integers, floor(1024 * x). Vectors are dealt into blocks by descending length; a block is
one row with its matrix. A query block meets every item block of its dimension, dealt over all tasks, but

1. the longest block comes first and gives each query its k-th best score so far, a lower bound;
2. the join drops block pairs whose product of greatest lengths (Cauchy-Schwarz) is below the least such
   bound of the query block;
3. in a pair, vectors are rotated by the singular vectors of the whole table (from its Gram matrix), partial
   sums over the leading coordinates are taken, and a candidate goes when partial sum plus the product of
   the residual lengths is below the query's bound;
4. what is left is scored in integers, exactly. Floating point is used only with a margin for its error.

Vectors that are null or empty, or hold null or non-finite components, and rows without an id take no part.
Vectors meet only vectors of the same dimension. A candidate with the query's own id is the query's own;
of rows that share a query id the smallest vector asks, all rows are candidates, repeated ones each for
itself. Ties go to the smaller id. Further columns pass unseen. Scores beyond 64 bits are held at its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read

ITEM_BLOCK, QUERY_BLOCK = 1024, 128
#: Above this dimension the rotation is left out (its matrix goes to every task).
MOST_ROTATED = 512
_BLOCK = "dim int, block long, norm double, n int, ids binary, vectors binary"
_HITS = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, norm, v array<long>) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))
    rows = rows.select("id", F.size("x").alias("dim"), F.transform("x", lambda c: F.floor(c * float(scale))).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    return rows.withColumn("norm", norm)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def _blocks(size: int):
    """Rows sorted by (dim, norm descending) to block rows of at most ``size`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, float, np.ndarray]] = []
        part, made = None, 0

        def flush() -> pa.RecordBatch:
            nonlocal made
            dim, norm = len(held[0][2]), max(h[1] for h in held)
            ids = np.array([h[0] for h in held], np.int64)
            made += 1
            return pa.RecordBatch.from_pydict(
                {"dim": pa.array([dim], pa.int32()), "block": pa.array([part << 32 | made], pa.int64()), "norm": [norm], "n": pa.array([len(held)], pa.int32()), "ids": [ids.tobytes()], "vectors": [np.stack([h[2] for h in held]).tobytes()]}
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(4)[0].as_py()
            norms = batch.column(2).to_pylist()
            for i, key in enumerate(batch.column(0).to_pylist()):
                v = np.asarray(batch.column(3)[i].values, np.int64)
                if held and (len(held) >= size or len(held[0][2]) != len(v)):
                    yield flush()
                    held.clear()
                held.append((key, norms[i], v))
        if held:
            yield flush()

    return run


def blocks(rows: DataFrame, size: int) -> DataFrame:
    # Dealt by range with the id as last key: equal lengths, or one vector a million times, still spread.
    dealt = rows.repartitionByRange("dim", F.desc("norm"), "id").sortWithinPartitions("dim", F.desc("norm"), "id")
    return dealt.select("id", "dim", "norm", "v", F.spark_partition_id().cast("long").alias("part")).mapInArrow(_blocks(size), _BLOCK)


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the eigenvectors of the Gram matrix (right singular vectors of the table), strongest
    first. What reaches the driver is dim * dim numbers a dimension, whatever the number of rows."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(batch.column(0))
            for dim in np.unique(dims):
                x = _matrix(batch.column(1).filter(pa.array(dims == dim)), int(dim)).astype(float)
                x /= np.maximum(1.0, np.linalg.norm(x, axis=1, keepdims=True))
                sums[int(dim)] = sums.get(int(dim), 0) + x.T @ x
        for dim, gram in sums.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * dim * dim, pa.int32()), "cell": pa.array(np.arange(dim * dim), pa.int32()), "x": gram.ravel()})

    cells = rows.filter(F.col("dim") <= MOST_ROTATED).select("dim", "v").mapInArrow(grams, "dim int, cell int, x double")
    summed = cells.groupBy("dim", "cell").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    for row in summed.collect():
        out.setdefault(row.dim, np.zeros(row.dim * row.dim))[row.cell] = row.x
    return {dim: np.linalg.eigh(g.reshape(dim, dim))[1][:, ::-1].copy() for dim, g in out.items()}


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row integer products of two equally long stacks."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if bound < 2**62:
        return np.einsum("ij,ij->i", q, x)
    wide = (q.astype(object) * x.astype(object)).sum(axis=1)
    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in wide], np.int64)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best, by (query, score descending, id)."""
    order = np.lexsort((ids, -scores.astype(np.float64), query)) if len(scores) and np.abs(scores.astype(np.float64)).max() < 2**52 else np.array(sorted(range(len(scores)), key=lambda i: (query[i], -int(scores[i]), ids[i])), np.int64)
    sorted_q = query[order]
    first = np.searchsorted(sorted_q, sorted_q)
    return order[np.arange(len(order)) - first < k]


def score_pair(q_ids, q, x_ids, x, least, rotation, k):
    """(query position, item position, score) of each query's k best in the block; what is below ``least``
    (the query's bound, -inf if none) may be left out."""
    qf, xf = q.astype(float), x.astype(float)
    if rotation is not None:
        qf, xf = qf @ rotation, xf @ rotation
    q_norm, x_norm = np.linalg.norm(qf, axis=1), np.linalg.norm(xf, axis=1)
    margin = 1e-9 * np.outer(q_norm, x_norm) + 1e-6
    alive = (x_ids[None, :] != q_ids[:, None]) & (np.outer(q_norm, x_norm) + margin >= least[:, None])
    dim = q.shape[1]
    partial = np.zeros(alive.shape)
    done = 0
    for upto in (dim // 4, dim // 2, dim * 3 // 4, dim):
        if upto == done or not alive.any():
            continue
        rows, cols = alive.any(axis=1), alive.any(axis=0)
        partial[np.ix_(rows, cols)] += qf[rows, done:upto] @ xf[cols, done:upto].T
        rest = np.outer(np.linalg.norm(qf[:, upto:], axis=1), np.linalg.norm(xf[:, upto:], axis=1))
        alive &= partial + rest + margin >= least[:, None]
        done = upto
    # Without a bound yet: the k best in floating point, and whatever may tie with them.
    if alive.sum(axis=1).max(initial=0) > k:
        shown = np.where(alive, partial, -np.inf)
        kth = np.partition(shown, -k, axis=1)[:, -k] if shown.shape[1] >= k else np.full(len(shown), -np.inf)
        alive &= shown + 2 * margin >= kth[:, None]
    a, b = np.nonzero(alive)
    scores = _exact(q[a], x[b])
    best = _best(a, x_ids[b], scores, k)
    return a[best], b[best], scores[best]


def _score_blocks(rotation: dict[int, np.ndarray], k: int):
    """Rows of (dim, query ids, query vectors, query bounds, item ids, item vectors) to hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, q_ids, q, least, x_ids, x = (batch.column(c)[i].as_py() for c in range(6))
                q_ids, x_ids = np.frombuffer(q_ids, np.int64), np.frombuffer(x_ids, np.int64)
                q, x = np.frombuffer(q, np.int64).reshape(-1, dim), np.frombuffer(x, np.int64).reshape(-1, dim)
                bound = np.frombuffer(least, np.float64) if least is not None else np.full(len(q_ids), -np.inf)
                a, b, scores = score_pair(q_ids, q, x_ids, x, bound, rotation.get(dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a]), pa.array(x_ids[b]), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return run


def _bounds(k: int):
    """Query block joined with the longest item block: the same block with each query's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, floor = [], []
            for i in range(batch.num_rows):
                dim, q_ids, q, x_ids, x = (batch.column(c)[i].as_py() for c in range(5))
                q_ids, x_ids = np.frombuffer(q_ids, np.int64), np.frombuffer(x_ids, np.int64)
                q, x = np.frombuffer(q, np.int64).reshape(-1, dim), np.frombuffer(x, np.int64).reshape(-1, dim)
                a, _, scores = score_pair(q_ids, q, x_ids, x, np.full(len(q_ids), -np.inf), None, k)
                bound = np.full(len(q_ids), -np.inf)
                full = np.bincount(a, minlength=len(q_ids)) >= k
                last = np.searchsorted(a, np.arange(len(q_ids)), side="right") - 1
                bound[full] = scores[last[full]].astype(float)
                least.append(bound.tobytes())
                floor.append(float(bound.min()))
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(least, pa.binary()), pa.array(floor, pa.float64()), batch.column(5)]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "q_ids", "q", "least", "floor", "q_norm"])

    return run


def top_k(vectors: DataFrame, is_query, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, item_block: int = ITEM_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer products of each query. ``is_query`` is a
    condition on the column ``id``."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    rotation = rotations(rows)
    items = blocks(rows, item_block)
    asked = rows.filter(is_query).groupBy("id", "dim").agg(F.min("v").alias("v"), F.min_by("norm", "v").alias("norm"))
    asked = blocks(asked.select("id", "dim", "norm", "v"), query_block).select("dim", F.col("norm").alias("q_norm"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q"))
    # The longest block of each dimension (one row a dimension).
    longest = items.groupBy("dim").agg(F.max_by(F.struct("ids", "vectors"), F.struct("norm", F.col("n"), -F.col("block"))).alias("i"))
    bounded = asked.join(longest, "dim").select("dim", "q_ids", "q", "i.ids", "i.vectors", "q_norm")
    bounded = bounded.mapInArrow(_bounds(k), "dim int, q_ids binary, q binary, least binary, floor double, q_norm double")
    # Items stay where a salt puts them; query blocks (a hundredth of the table) go to every salt.
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    item = items.select("dim", "norm", "ids", "vectors", F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
    query = bounded.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    pairs = query.join(item, ["dim", "salt"]).filter(F.col("q_norm") * F.col("norm") * (1 + 1e-9) + 1e-6 >= F.col("floor"))
    hits = pairs.select("dim", "q_ids", "q", "least", "ids", "vectors").mapInArrow(_score_blocks(rotation, k), _HITS)
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""
