"""Hard negatives by Strassen products of integer tiles and mergeable heaps."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shipping import ship
from millrace.storage import materialize

# Rows of the two sides of a cell, and of the tiles that are multiplied at a time.
CELL_ROWS = 65_536
TILE_ANCHORS, TILE_ROWS = 256, 2_048
# A product with a side of at most this length is not split further.
_LEAF = 16
_LOWEST = np.int64(np.iinfo(np.int64).min)


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of 64-bit integers with seven products of half the size.

    Sides are padded with zeros to even lengths.  Additions are exact; sums
    beyond 64 bits wrap around on the way and back, so the product is exact
    whenever its own values fit.
    """
    n, inner = a.shape
    m = b.shape[1]
    if min(n, inner, m) <= _LEAF:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, m % 2)))
    i, k, j = (n + 1) // 2, (inner + 1) // 2, (m + 1) // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


class Heaps:
    """The best ``k`` entries ``(score, id)`` of each of ``n`` heaps, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.heap = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        # What an entry with a larger id than all held ones has to exceed.
        self.least = np.full(n, _LOWEST, np.int64)
        self.full = np.zeros(n, bool)

    def merge(self, heap: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Take in entries, in any order."""
        if not len(heap):
            return
        heap = np.append(self.heap, heap)
        score = np.append(self.score, score)
        ident = np.append(self.id, ident)
        # ~score falls as the score rises and, unlike -score, never overflows.
        order = np.lexsort((ident, ~score, heap))
        heap, score, ident = heap[order], score[order], ident[order]
        first = np.flatnonzero(np.append(True, heap[1:] != heap[:-1]))
        nth = np.arange(len(heap)) - np.repeat(first, np.diff(np.append(first, len(heap))))
        keep = nth < self.k
        self.heap, self.score, self.id = heap[keep], score[keep], ident[keep]
        last = nth[keep] == self.k - 1
        self.least[self.heap[last]] = self.score[last]
        self.full[self.heap[last]] = True

    def offer(self, first: int, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        """Entries of heaps ``first, first + 1, ...`` from a matrix where ``fits``.

        Ids ascend along the row and over the calls, so an entry that only ties
        with the last one of a full heap is behind it.
        """
        rows = slice(first, first + len(scores))
        fits &= (scores > self.least[rows, None]) | ~self.full[rows, None]
        which, at = np.nonzero(fits)
        self.merge(which + first, scores[which, at], ids[at])


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros to ``width``."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _widest(column: pa.ChunkedArray) -> int:
    return max(int(np.diff(c.offsets.to_numpy()).max()) for c in column.chunks if len(c))


def _tiles(anchors: pa.Table, rows: pa.Table, visit: Callable) -> None:
    """``visit(first anchor, rows of it, scores, row ids, row labels)`` for all tiles.

    Rows come in ascending order of their id.
    """
    width = max(_widest(anchors["vector"]), _widest(rows["vector"]))
    left, right = _matrix(anchors["vector"], width), _matrix(rows["vector"], width)
    ids = rows["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    labels = rows["label"].to_numpy()
    for j in range(0, len(order), TILE_ROWS):
        part = order[j : j + TILE_ROWS]
        block = np.ascontiguousarray(right[part].T)
        for i in range(0, len(left), TILE_ANCHORS):
            scores = strassen(left[i : i + TILE_ANCHORS], block)
            visit(i, slice(i, i + len(scores)), scores, ids[part], labels[part])


def _best_positives(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The best ``k`` rows of the cell for each anchor: same label, another id."""
    own_id, own_label = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
    heaps = Heaps(anchors.num_rows, k)

    def visit(first, part, scores, ids, labels):
        fits = (own_label[part, None] == labels) & (own_id[part, None] != ids)
        heaps.offer(first, scores, fits, ids)

    _tiles(anchors, rows, visit)
    numbers = anchors["anchor"].to_numpy()
    return pa.table(
        {"anchor": numbers[heaps.heap], "positive_id": heaps.id, "positive_score": heaps.score}
    )


def _best_negatives(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """The best ``k`` rows of the cell for each anchor and distinct positive score.

    ``low * positive <= high * score <= high * positive``, another label.
    """
    own_label = anchors["label"].to_numpy()
    wanted = anchors["scores"].combine_chunks()
    slots = _widest(anchors["scores"])
    counts = np.diff(wanted.offsets.to_numpy())
    most = _matrix(anchors["scores"], slots)
    # The smallest score that fits, without a product that could overflow.
    g = math.gcd(low, high)
    a, b = low // g, high // g
    least = (most // b) * a + -(-((most % b) * a) // b)
    windows = [Heaps(anchors.num_rows, k) for _ in range(slots)]

    def visit(first, part, scores, ids, labels):
        other = own_label[part, None] != labels
        for s, heaps in enumerate(windows):
            fits = other & (scores <= most[part, s, None]) & (scores >= least[part, s, None])
            fits &= (counts[part] > s)[:, None]
            if fits.any():
                heaps.offer(first, scores, fits, ids)

    _tiles(anchors, rows, visit)
    numbers = anchors["anchor"].to_numpy()
    join = np.concatenate
    return pa.table(
        {
            "anchor": join([numbers[h.heap] for h in windows]),
            "positive_score": join([most[h.heap, s] for s, h in enumerate(windows)]),
            "negative_id": join([h.id for h in windows]),
            "negative_score": join([h.score for h in windows]),
        }
    )


def quantised(vectors: DataFrame, *, scale: int = 256, relabel: Column | None = None) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, components as integers.

    Rows without an id, a label or a vector, and those with a null, NaN or
    infinite component, take no part.  A component is ``floor(scale * x)``.
    """
    value = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vectors.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False))
    ).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col("label") if relabel is None else relabel).cast("bigint").alias("label"),
        F.transform(value, lambda x: F.floor(x * scale).cast("bigint")).alias("vector"),
    )


def _in_cells(
    anchors: DataFrame,
    rows: DataFrame,
    counts: tuple[int, int],
    function: Callable[[pa.Table, pa.Table], pa.Table],
    names: list[str],
) -> DataFrame:
    """``function`` of every block of anchors with every block of rows, all 64-bit integers.

    Rows and anchors are dealt into blocks of about ``CELL_ROWS`` (rows into at
    least as many as there are shuffle partitions), whatever their ids are, and
    each block is sent to the cells of its row or column.
    """
    spark = rows.sparkSession
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, math.ceil(counts[0] / CELL_ROWS))
    down = max(parallel, math.ceil(counts[1] / CELL_ROWS))

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(n))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    left = anchors.withColumns({"i": dealt("anchor", across), "j": every(down)})
    right = rows.withColumns({"i": every(across), "j": dealt("row", down)})

    def cell(some: pa.Table, others: pa.Table) -> pa.Table:
        if not some.num_rows or not others.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        return function(some, others)

    schema = ", ".join(f"{n} long" for n in names)
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(cell, schema)


def _numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """Written once, so that the numbers of the rows never change."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), label)


def _ranked(df: DataFrame, keys: list[str], score: str, ident: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, *, k: int = 5, low: int = 80, high: int = 100
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, label, vector`` (see ``quantised``); other columns
    are ignored.  A score is the integer inner product, the shorter vector
    padded with zeros; results are exact while scores are below 2**60.  The
    positives of an anchor are the ``k`` best rows of its label with another
    id; for each, the ``k`` best rows of other labels with
    ``low * positive <= high * score <= high * positive`` follow.  Higher
    scores come first, then smaller ids.  Each of several rows of one id counts
    for itself, as an anchor too.  Empty tables and anchors without a positive
    give no rows.

    All anchors meet all rows in blocks: a task holds one block of each side as
    integers and the product of one pair of tiles.  Only heaps of ``k`` entries
    leave a cell.
    """
    spark = rows.sparkSession
    ship(spark)
    slim = _numbered(rows.select("vec_id", "label", "vector"), "row", "vectors")
    anchors = _numbered(
        slim.filter(is_anchor).select("vec_id", "label", "vector"), "anchor", "anchors"
    )
    counts = (anchors.count(), slim.count())
    found = _in_cells(
        anchors,
        slim,
        counts,
        lambda a, r: _best_positives(a, r, k),
        ["anchor", "positive_id", "positive_score"],
    )
    positives = materialize(
        _ranked(found, ["anchor"], "positive_score", "positive_id", k), "positives"
    )
    scores = positives.groupBy("anchor").agg(
        F.sort_array(F.collect_set("positive_score"), asc=False).alias("scores")
    )
    found = _in_cells(
        anchors.join(scores, "anchor"),
        slim,
        counts,
        lambda a, r: _best_negatives(a, r, k, low, high),
        ["anchor", "positive_score", "negative_id", "negative_score"],
    )
    negatives = _ranked(found, ["anchor", "positive_score"], "negative_score", "negative_id", k)
    return (
        positives.drop("rank")
        .join(negatives, ["anchor", "positive_score"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
