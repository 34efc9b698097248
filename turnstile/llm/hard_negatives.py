"""Hard negatives of anchors: integer scores by Strassen's multiplication, and heaps that merge.

Components become integers, floor(scale * x). Anchors and rows are dealt into the cells of a grid (groups of anchors by groups
of rows, each of at most ``GROUP_BYTES``); a cell multiplies tiles of anchors and candidates and keeps, for each
anchor, a heap of its best rows, merged tile by tile. The heaps of the cells merge in one ranking with a partial
step, so what leaves a cell is at most a heap for each of its anchors, however many rows share a label or a vector. Twice:

1. positives: an anchor's best ``n_positive`` other rows of its label;
2. windows: for each positive its best ``n_negative`` rows of another label whose score is within ``low`` to ``high`` hundredths
   of the positive's.

Tiles are int64. ``strassen`` pads odd sides with zeros, adds and subtracts in integers and multiplies the leaves
exactly: in float64 where no sum can reach 2**53, else in int64. Where a score itself could pass 63 bits the tile
is multiplied in Python integers and scores are held at the ends of 64 bits.

Rows without an id, a label or a vector, or with null or non-finite components, and empty vectors take no part; vectors meet
vectors of the same length only. Rows with an anchor's id are its own and never its positives or negatives. Of rows that share an
anchor id the smallest (length, label, vector) asks; as positives and negatives all rows count, repeated ones each for
itself. Ties go to the smaller id. Further columns pass unseen; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read

LEAF = 32
ANCHOR_TILE, ITEM_TILE = 256, 1024
#: Most bytes of vectors that a cell takes of either side.
GROUP_BYTES = 32 << 20
#: Fewer rows are not spread over more cells: each cell gives every anchor a heap.
CELL_ROWS = 4096
_LOWEST = np.iinfo(np.int64).min


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b  # modulo 2**64, which is exact for a product that fits


def _padded(x: np.ndarray) -> np.ndarray:
    """With zeros up to even sides."""
    return np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2))) if x.shape[0] % 2 or x.shape[1] % 2 else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The int64 product of two int64 matrices, exact where it fits 64 bits."""
    if min(a.shape[0], a.shape[1], b.shape[1]) <= leaf:
        return _leaf(a, b)
    rows, columns = a.shape[0], b.shape[1]
    a, b = _padded(a), _padded(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k] = m1 + m4 - m5 + m7
    out[:i, k:] = m3 + m5
    out[i:, :k] = m2 + m4
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def scores(anchors: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Inner products of two stacks of integer vectors."""
    bound = float(np.abs(anchors.astype(float)).max(initial=0)) * float(np.abs(items.astype(float)).max(initial=0)) * anchors.shape[1]
    if bound < 2**62:
        return strassen(anchors, np.ascontiguousarray(items.T))
    wide = anchors.astype(object) @ items.astype(object).T
    return np.vectorize(lambda s: min(max(s, -(2**63)), 2**63 - 1), otypes=[np.int64])(wide)


class Heaps:
    """The best ``size`` (score, id) of each of ``n`` owners; smaller ids first among equal scores."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.owner, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, _LOWEST)  # an owner's last score once its heap is full

    def merge(self, owner: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        owner, ids, scores = np.append(self.owner, owner), np.append(self.ids, ids), np.append(self.scores, scores)
        order = np.lexsort((ids, ~scores, owner))
        owner, ids, scores = owner[order], ids[order], scores[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = place < self.size
        last = place == self.size - 1
        self.least[owner[last]] = scores[last]
        self.owner, self.ids, self.scores = owner[keep], ids[keep], scores[keep]

    def offer(self, tile: np.ndarray, ids: np.ndarray, allowed: np.ndarray, first: int) -> None:
        """Candidates of the owners ``first``, ``first + 1``, ... (rows of the tile)."""
        allowed = allowed & (tile >= self.least[first : first + len(tile), None])
        if allowed.sum() > 4 * self.size * len(tile) and tile.shape[1] > self.size:
            shown = np.where(allowed, tile, _LOWEST)
            least = np.partition(shown, -self.size, axis=1)[:, -self.size]
            allowed &= tile >= least[:, None]
        row, column = np.nonzero(allowed)
        if len(row):
            self.merge(first + row, ids[column], tile[row, column])


def _vectors(table: pa.Table, dim: int) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy().astype(np.int64, copy=False).reshape(-1, dim)


def _tiles(anchors: pa.Table, items: pa.Table):
    """(first anchor, scores, item ids, item labels) of a cell's tiles."""
    if not anchors.num_rows or not items.num_rows:
        return
    dim = anchors.column("dim")[0].as_py()
    a, x = _vectors(anchors, dim), _vectors(items, dim)
    ids, labels = items.column("id").to_numpy(), items.column("label").to_numpy()
    for i in range(0, len(a), ANCHOR_TILE):
        for j in range(0, len(x), ITEM_TILE):
            yield i, scores(a[i : i + ANCHOR_TILE], x[j : j + ITEM_TILE]), ids[j : j + ITEM_TILE], labels[j : j + ITEM_TILE]


def _positives(n_positive: int):
    def run(anchors: pa.Table, items: pa.Table) -> pa.Table:
        own, kind = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        best = Heaps(len(own), n_positive)
        for i, tile, ids, labels in _tiles(anchors, items):
            some = slice(i, i + len(tile))
            best.offer(tile, ids, (labels == kind[some, None]) & (ids != own[some, None]), i)
        return pa.table({"anchor_id": own[best.owner], "vec_id": best.ids, "score": best.scores})

    return run


def _negatives(n_negative: int, low: int, high: int):
    def run(anchors: pa.Table, items: pa.Table) -> pa.Table:
        own, kind = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        listed = anchors.column("positives").to_pylist()
        slots = max(map(len, listed), default=0)
        heaps = [Heaps(len(own), n_negative) for _ in range(slots)]
        # Whole numbers that satisfy low * positive <= 100 * s <= high * positive; an absent positive has no window.
        least = np.full((slots, len(own)), 1, np.int64)
        most = np.zeros((slots, len(own)), np.int64)
        for a, positives in enumerate(listed):
            for p in positives:
                least[p["slot"] - 1, a] = max(-((-low * p["score"]) // 100), -(2**63))
                most[p["slot"] - 1, a] = min(high * p["score"] // 100, 2**63 - 1)
        for i, tile, ids, labels in _tiles(anchors, items):
            some = slice(i, i + len(tile))
            other = (labels != kind[some, None]) & (ids != own[some, None])
            for slot in range(slots):
                heaps[slot].offer(tile, ids, other & (tile >= least[slot, some, None]) & (tile <= most[slot, some, None]), i)
        kept = [(h.owner, np.full(len(h.owner), slot + 1), h.ids, h.scores) for slot, h in enumerate(heaps)]
        owner, slot, ids, found = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*kept, strict=True) if kept else [[]] * 4))
        return pa.table({"anchor_id": own[owner], "slot": pa.array(slot.astype(np.int32)), "vec_id": ids, "score": found})

    return run


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, dim, v array<long>) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))
    return rows.select("id", "label", F.size("x").alias("dim"), F.transform("x", lambda c: F.floor(c * float(scale))).alias("v"))


def mine(
    vectors: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, scale: int = 256,
    n_positive: int = 5, n_negative: int = 3, low: int = 50, high: int = 95, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``is_anchor`` is a condition on the column
    ``id``; ``label`` defaults to the column ``label``."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors, id_col, vector_col, F.col("label") if label is None else label, scale)
    asked = rows.filter(is_anchor).groupBy("id").agg(F.min(F.struct("dim", "label", "v")).alias("a")).select("id", "a.*")
    # The grid: three numbers reach the driver.
    n, n_asked, dim = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max("dim")).first()
    a_group = max(1, group_bytes // (8 * (dim or 1)))
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a_cells = max(1, math.ceil(n_asked / a_group))
    i_cells = max(1, math.ceil(n / a_group), min(spread, math.ceil(n / CELL_ROWS)))

    def everywhere(cells: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))

    def cell(cells: int) -> Column:
        # By id and input partition, so that rows of one id spread too.
        return F.pmod(F.xxhash64("id") + F.spark_partition_id(), F.lit(cells)).cast("int")

    items = rows.withColumn("i_cell", cell(i_cells)).withColumn("a_cell", everywhere(a_cells))
    keys = ("dim", "a_cell", "i_cell")

    def in_cells(anchors: DataFrame, run, schema: str) -> DataFrame:
        dealt = anchors.withColumn("a_cell", F.pmod(F.xxhash64("id"), F.lit(a_cells)).cast("int")).withColumn("i_cell", everywhere(i_cells))
        return dealt.toDF(*dealt.columns).groupBy(*keys).cogroup(items.toDF(*items.columns).groupBy(*keys)).applyInArrow(run, schema)

    def ranked(found: DataFrame, owner: list[str], most: int, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*owner).orderBy(F.desc("score"), "vec_id"))
        return found.withColumn(name, place.cast("int")).filter(F.col(name) <= most)

    positives = ranked(in_cells(asked, _positives(n_positive), "anchor_id long, vec_id long, score long"), ["anchor_id"], n_positive, "slot")
    listed = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("slot", "vec_id", "score"))).alias("positives"))
    found = in_cells(asked.join(listed, "id"), _negatives(n_negative, low, high), "anchor_id long, slot int, vec_id long, score long")
    best = ranked(found, ["anchor_id", "slot"], n_negative, "rank")
    named = best.join(positives.select("anchor_id", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor_id", "slot"])
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=moved)


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score,
       s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""
