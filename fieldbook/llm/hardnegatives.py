"""Hard-negative mining: Strassen products of integer tiles, merged into heaps of positives and of windows.

Vectors become integers. Anchors and candidates are dealt out by hash over a grid of cells, so many to a
cell whatever their labels; a cell multiplies its anchors with its candidates tile by tile. A tile is
padded with zeros to halve evenly and multiplied by Strassen's recursion: seven products of half the size
instead of eight, put together by integer additions. 64-bit integers wrap, so intermediate sums may: the
product is exact as long as the scores themselves stay below 2**63.

* *Positives.* A cell keeps for each anchor a heap of its best candidates of the same label. Heaps are
  merged over the tiles of a cell there, and over cells by a grouped limit before and after the shuffle.
* *Windows.* A positive's score p opens a window: scores from ``low`` * p to ``high`` * p. In a second pass
  over the grid each anchor has a heap of candidates of other labels for each window, merged likewise.

Each anchor goes to as many cells as there are parts of the candidates, and the other way round; parts
have a fixed size, so memory is bounded and no label, however common, meets one task.

Null labels, null vectors, vectors with null or non-finite components and rows with a null id take no part.
Vectors are compared with those of as many components. Repeated rows are rows of their own: each is an
anchor and a candidate, and leaves out itself only. Ties go to the smaller id. Fewer candidates give fewer
rows, an empty table none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import on_workers, written
from .topk import usable

#: Anchors and candidates to a cell; rows and columns of a tile; size at which Strassen's recursion ends.
ANCHORS, CANDIDATES, TILE_ROWS, TILE_COLUMNS, LEAF = 16_384, 8_192, 256, 2_048, 32

NONE = np.iinfo(np.int64).min


def halvings(*sizes: int) -> int:
    """How often a product of these sizes is split: until its least side would fall under ``LEAF``."""
    least, n = min(sizes), 0
    while least >= 2 * LEAF:
        least, n = -(-least // 2), n + 1
    return n


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices, exact modulo 2**64."""
    (m, k), n = a.shape, b.shape[1]
    depth = halvings(m, k, n)
    if not a.size or not b.size:
        return np.zeros((m, n), np.int64)
    unit = 1 << depth
    padded = [np.pad(x, [(0, -s % unit) for s in x.shape]) for x in (a, b)]
    # each level at most doubles the entries: where doubles hold every sum at the leaves, they multiply there
    largest = [float(np.abs(x.astype("f8")).max()) * unit for x in (a, b)]
    exact = largest[0] * largest[1] * (-(-k // unit)) < 2.0**53
    leaf = (lambda x, y: (x.astype("f8") @ y.astype("f8")).astype("i8")) if exact else np.matmul
    return _strassen(*padded, depth, leaf)[:m, :n]


def _strassen(a: np.ndarray, b: np.ndarray, depth: int, leaf: Callable) -> np.ndarray:
    if not depth:
        return leaf(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    times = lambda x, y: _strassen(x, y, depth - 1, leaf)
    p1 = times(a11 + a22, b11 + b22)
    p2 = times(a21 + a22, b11)
    p3 = times(a11, b12 - b22)
    p4 = times(a22, b21 - b11)
    p5 = times(a11 + a12, b22)
    p6 = times(a21 - a11, b11 + b12)
    p7 = times(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """For each of some owners the k best of what was offered: (score, id), higher scores and smaller ids first."""

    def __init__(self, k: int):
        self.k = k
        self.owner = np.zeros(0, np.int64)
        self.score, self.id = self.owner.copy(), self.owner.copy()

    def offer(self, owners: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows of ``scores`` belong to ``owners``, columns to ``ids``; only ``allowed`` places count."""
        masked = np.where(allowed, scores, NONE)
        if masked.shape[1] > self.k:
            kth = np.partition(masked, masked.shape[1] - self.k, axis=1)[:, masked.shape[1] - self.k]
            allowed = allowed & (masked >= kth[:, None])
        at, column = np.nonzero(allowed)
        self.merge(owners[at], scores[at, column], ids[column])

    def merge(self, owner: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        owner, score, id = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.id, id)))
        order = np.lexsort((id, ~score, owner))  # ~score falls as score rises, at either end of the range
        owner, score, id = owner[order], score[order], id[order]
        first = np.searchsorted(owner, owner, "left")
        best = np.arange(len(owner)) - first < self.k
        self.owner, self.score, self.id = owner[best], score[best], id[best]


def integers(vectors: DataFrame, label: Column, scale: float, id_column: str, embedding: str) -> DataFrame:
    """(row, id, label, dim, v) of the rows that take part; written, so that ``row`` stays."""
    rows = vectors.withColumn("mined label", label.cast("bigint"))
    rows = rows.where(F.col(id_column).isNotNull() & F.col("mined label").isNotNull() & F.coalesce(usable(embedding), F.lit(False)))
    v = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
                       F.col("mined label").alias("label"), F.size(embedding).alias("dim"), v.alias("v"))
    return written(rows, "labelled-vectors")


def matrix(table: pa.Table) -> np.ndarray:
    """The vectors of a cell's rows, one a row."""
    flat = table["v"].combine_chunks().flatten() if table.num_rows else pa.array([], pa.int64())
    return flat.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(table.num_rows, -1)


def tiles(anchors: pa.Table, candidates: pa.Table) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(anchors, candidates, their scores), tile by tile."""
    a, b = matrix(anchors), np.ascontiguousarray(matrix(candidates).T)
    for row in range(0, len(a), TILE_ROWS):
        for column in range(0, b.shape[1], TILE_COLUMNS):
            rows, columns = slice(row, row + TILE_ROWS), slice(column, column + TILE_COLUMNS)
            yield rows, columns, strassen(a[rows], b[:, columns])


def in_cells(anchors: DataFrame, candidates: DataFrame, grid: tuple[int, int], fn: Callable, schema: str) -> DataFrame:
    """``fn(anchors, candidates)`` for every cell of the grid."""
    high, wide = grid
    on_workers(anchors.sparkSession)
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("ga", part(high)).withColumn("gc", every(wide))
    c = candidates.withColumn("gc", part(wide)).withColumn("ga", every(high))
    cell = ["dim", "ga", "gc"]
    return a.groupBy(*cell).cogroup(c.groupBy(*cell)).applyInArrow(fn, schema)


def best(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """Merge the heaps of all cells: the k best rows of each group, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, label: Column, scale: float = 256.0, n_positives: int = 5, n_negatives: int = 5,
         low: tuple[int, int] = (4, 5), id_column: str = "vec_id", embedding: str = "embedding",
         anchors_per_cell: int = ANCHORS, candidates_per_cell: int = CANDIDATES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` (over ``id``) selects the anchors among the rows that take part; ``label`` is over the input.
    A negative's score is at most its positive's and at least ``low`` (a fraction of two integers) of it.
    """
    rows = integers(vectors, label, scale, id_column, embedding)
    anchors = rows.where(anchor)
    grid = max(1, -(-anchors.count() // anchors_per_cell)), max(1, -(-rows.count() // candidates_per_cell))

    def positives(a: pa.Table, c: pa.Table) -> pa.Table:
        heaps = Heaps(n_positives)
        a_rows, a_ids, a_labels = (a[x].to_numpy() for x in ("row", "id", "label"))
        c_rows, c_ids, c_labels = (c[x].to_numpy() for x in ("row", "id", "label"))
        for i, j, scores in tiles(a, c) if a.num_rows and c.num_rows else ():
            allowed = (a_labels[i, None] == c_labels[None, j]) & (a_rows[i, None] != c_rows[None, j])
            heaps.offer(np.arange(i.start, i.start + len(scores)), scores, c_ids[j], allowed)
        return pa.table({"row": a_rows[heaps.owner], "anchor_id": a_ids[heaps.owner], "id": heaps.id, "score": heaps.score})

    found = in_cells(anchors, rows, grid, positives, "row bigint, anchor_id bigint, id bigint, score bigint")
    known = written(best(found, ["row"], n_positives).drop("rank"), "positives")
    windows = known.groupBy("row").agg(F.sort_array(F.collect_set("score")).alias("windows"))  # n_positives at most
    asked = written(anchors.join(windows, "row"), "anchors")
    over, under = low

    def negatives(a: pa.Table, c: pa.Table) -> pa.Table:
        heaps = Heaps(n_negatives)
        a_rows, a_labels = (a[x].to_numpy() for x in ("row", "label"))
        c_ids, c_labels = (c[x].to_numpy() for x in ("id", "label"))
        tops = np.full((a.num_rows, n_positives), NONE)
        lows = np.full((a.num_rows, n_positives), np.iinfo(np.int64).max)
        for at, scores in enumerate(a["windows"].to_pylist()):
            tops[at, :len(scores)] = scores
            lows[at, :len(scores)] = [-(-over * s // under) for s in scores]  # rounded up
        for i, j, scores in tiles(a, c) if a.num_rows and c.num_rows else ():
            other = a_labels[i, None] != c_labels[None, j]
            for w in range(n_positives):
                allowed = other & (scores <= tops[i, w, None]) & (scores >= lows[i, w, None])
                some = np.flatnonzero(allowed.any(1))
                heaps.offer((some + i.start) * n_positives + w, scores[some], c_ids[j], allowed[some])
        at, w = heaps.owner // n_positives, heaps.owner % n_positives
        return pa.table({"row": a_rows[at], "positive_score": tops[at, w], "id": heaps.id, "score": heaps.score})

    found = in_cells(asked, rows, grid, negatives, "row bigint, positive_score bigint, id bigint, score bigint")
    hard = best(found, ["row", "positive_score"], n_negatives)
    hard = hard.select("row", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = known.select("row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return known.join(hard, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
