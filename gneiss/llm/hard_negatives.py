"""Hard negatives by blocked dense products: anchor blocks are broadcast, candidate blocks stream past them in float64.

Components are whole numbers, so a product is exact while it stays below 2^53. One pass keeps each task's best same-label
rows of every anchor (its positives); these short lists merge in any order. A second pass over the same candidates keeps
the best other-label rows whose score lies in a window set by each positive's score. No matrix is larger than a tile,
and a task returns a few rows for each anchor, whatever it has read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches, settle

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percents of the positive's.
LOW, HIGH = 50, 95
#: Components become floor(SCALE * x).
SCALE = 256
#: Components of the anchors broadcast at once (32 MB), and at most so many anchors.
BLOCK_CELLS, BLOCK_ROWS = 1 << 22, 1 << 14
#: Candidates and their components gathered before a product, and cells of a product.
TOGETHER, TOGETHER_CELLS, TILE_CELLS = 2048, 1 << 21, 1 << 19
#: Scores of a smaller size are packed with their column into one integer.
_PLAIN = 1 << 50
_LARGEST = (1 << 63) - 2
_NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id long, label long, v array<double>) of the rows without a null and with finite components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)


def whole(vectors: pa.ListArray, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each dimension the places of its vectors and floor(scale * x) of their components."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    out = {}
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        with np.errstate(over="ignore"):
            out[dim] = at, np.clip(np.floor(scale * flat[first[at, None] + np.arange(dim)]), -(2.0**62), 2.0**62)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows as int64: float64 products where they are exact, else of Python's integers, held to
    the range of a long."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return np.clip(exact, -_LARGEST, _LARGEST).astype(np.int64)


def leading(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k highest allowed scores, ties to the earlier column; -1 where there are fewer."""
    n = scores.shape[1]
    k = min(k, n)
    if not scores.size or max(-int(scores.min()), int(scores.max())) < _PLAIN and n <= 4096:
        key = np.where(allowed, (scores << 12) + (4095 - np.arange(n)), _NONE)
        key = -np.sort(-np.partition(key, n - k, axis=1)[:, n - k :], axis=1)
        return np.where(key == _NONE, -1, 4095 - (key & 4095))
    order = np.argsort(np.where(allowed, -scores, _LARGEST + 1), axis=1, kind="stable")[:, :k]
    return np.where(np.take_along_axis(allowed, order, axis=1), order, -1)


class Best:
    """The k best (score, id) so far of each of n lists; lists merge in any order."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores, self.ids, self.have = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), bool)

    def floor(self, rows: np.ndarray) -> np.ndarray:
        """A score below this can't enter the list any more."""
        return np.where(self.have[rows, -1], self.scores[rows, -1], -_LARGEST)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, have: np.ndarray) -> None:
        s, i, h = (np.concatenate([old[rows], new], axis=1) for old, new in ((self.scores, scores), (self.ids, ids), (self.have, have)))
        order = np.lexsort((i, -s, ~h), axis=1)[:, : self.k]
        self.scores[rows], self.ids[rows], self.have[rows] = (np.take_along_axis(x, order, axis=1) for x in (s, i, h))


@dataclass
class Anchors:
    """A block of anchors; limits (low, high), if any, has a row for each anchor and a column for each of its positives."""

    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]]
    limits: tuple[np.ndarray, np.ndarray] | None = None


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, cells = [], 0, 0
    for b in batches:
        held.append(b)
        rows, cells = rows + b.num_rows, cells + len(b.column(2).flatten())
        if rows >= TOGETHER or cells >= TOGETHER_CELLS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows, cells = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _scan(candidates: DataFrame, block, scale: int, lists: int, k: int, tile: Callable) -> DataFrame:
    """(key, list, score, id): what each task's candidates leave in the lists of every anchor.

    ``tile(anchors, rows, scores, ids, labels, best)`` puts one product's rows in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = Best(len(anchors.keys) * lists, k)
        for t in _gathered(batches):
            ids, labels = (t.column(c).to_numpy() for c in ("id", "label"))
            for dim, (at, v) in whole(t.column("v").combine_chunks(), scale).items():
                if dim in anchors.by_dim:
                    order = at[np.argsort(ids[at], kind="stable")]
                    v = v[np.argsort(ids[at], kind="stable")]
                    rows, a = anchors.by_dim[dim]
                    step = max(1, TILE_CELLS // max(1, len(v)))
                    for lo in range(0, len(rows), step):
                        tile(anchors, rows[lo : lo + step], products(a[lo : lo + step], v), ids[order], labels[order], best)
        row, place = np.nonzero(best.have)
        columns = (anchors.keys[row // lists], row % lists, best.scores[row, place], best.ids[row, place])
        for lo in range(0, len(row), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + (1 << 16)].astype(np.int64)) for c in columns], names=["key", "list", "score", "id"])

    return candidates.mapInArrow(run, "key long, list long, score long, id long")


def _positive_tile(anchors: Anchors, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, best: Best) -> None:
    for label in np.intersect1d(anchors.labels[rows], labels):
        own, cols = np.flatnonzero(anchors.labels[rows] == label), np.flatnonzero(labels == label)
        part, at = scores[np.ix_(own, cols)], rows[own]
        allowed = (anchors.ids[at, None] != ids[cols]) & (part >= best.floor(at)[:, None])
        _put(best, at, part, ids[cols], allowed)


def _negative_tile(anchors: Anchors, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, best: Best) -> None:
    low, high = anchors.limits
    other = (anchors.labels[rows, None] != labels) & (anchors.ids[rows, None] != ids)
    for j in range(low.shape[1]):
        at = rows * low.shape[1] + j
        least = np.maximum(low[rows, j], best.floor(at))
        _put(best, at, scores, ids, other & (scores >= least[:, None]) & (scores <= high[rows, j, None]))


def _put(best: Best, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
    some = np.flatnonzero(allowed.any(axis=1))
    if some.size:
        found = leading(scores[some], allowed[some], best.k)
        best.add(at[some], np.take_along_axis(scores[some], np.maximum(found, 0), axis=1), ids[np.maximum(found, 0)], found >= 0)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each list, with their rank."""
    rank = F.row_number().over(Window.partitionBy("key", "list").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.

    A score is the inner product of the vectors with components floor(scale * x). An anchor's positives are its
    ``positives`` best rows of the same label, a positive's negatives the ``negatives`` best rows of another label whose
    score is between ``low`` and ``high`` percent of the positive's; ties go to the smaller id. Anchors without a
    positive and positives without a negative give no row.

    Rows with a null id, label, vector or component or a component that isn't finite take no part. Rows of the anchor's
    own id are never its partners; otherwise repeated rows count one by one, as partners and as anchors. Only vectors of
    one dimension meet. Scores are exact; those beyond the range of a long are held to it. An empty table gives no rows;
    other columns are ignored. Anchors go to the driver and to the workers a block at a time, a block's size being bound
    in rows and in cells.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    candidates = usable(vectors, id_col, vector_col, label_col)
    chosen = settle(usable(vectors.where(anchor), id_col, vector_col, label_col).withColumn("key", F.monotonically_increasing_id()))
    total = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v")).alias("cells")).first()
    blocks = max(1, -(-total["n"] // block_rows), -(-(total["cells"] or 0) // BLOCK_CELLS))
    dealt = F.pmod(F.xxhash64("key"), F.lit(blocks))
    out = []
    for b in range(blocks):
        t = chosen.where(dealt == b).orderBy("key").toArrow().combine_chunks()
        if not t.num_rows:
            continue
        anchors = Anchors(*(t.column(c).to_numpy() for c in ("key", "id", "label")), whole(t.column("v").combine_chunks(), scale))
        held = spark.sparkContext.broadcast(anchors)
        first = settle(_merged(_scan(candidates, held, scale, 1, positives, _positive_tile), positives).drop("list"))
        anchors.limits = _limits(anchors, first.toArrow(), positives, low, high)
        held = spark.sparkContext.broadcast(anchors)
        second = _merged(_scan(candidates, held, scale, positives, negatives, _negative_tile), negatives)
        named = spark.createDataFrame(pa.table({"key": anchors.keys, "anchor_id": anchors.ids}))
        first = first.select("key", (F.col("rank") - 1).alias("list"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(named, "key")
        second = second.select("key", "list", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        out.append(settle(first.join(second, ["key", "list"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")))
    none = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionAll, out) if out else none


def _limits(anchors: Anchors, found: pa.Table, positives: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole score within the window of each anchor's positives; an empty window where there is none."""
    at = np.searchsorted(anchors.keys, found.column("key").to_numpy())  # keys are sorted
    least, most = np.ones((2, len(anchors.keys), positives), np.int64)
    most = most * 0
    for i, rank, score in zip(at, found.column("rank").to_pylist(), found.column("score").to_pylist(), strict=True):
        least[i, rank - 1], most[i, rank - 1] = -(-low * score // 100), high * score // 100
    return least, most
