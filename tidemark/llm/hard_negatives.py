"""Hard-negative mining over R-trees that are packed by sort, tile, recurse.

Rows are cut into blocks by Spark: sorted by label and the coordinate that varies most, cut into slabs, each slab
sorted by the next coordinate and cut into blocks of equal length. A block is one R-tree: its rows are tiled further by its own
widest coordinates into leaves, and inner nodes hold consecutive leaves. The bounding box of a node gives
an interval for the inner product with any vector, coordinate by coordinate. For each anchor a queue hands
out the node with the highest bound; boxes outside the score window, of the wrong label, or strictly below
the worst score that is still among the best ``k`` are never opened. Anchors are streamed past each block,
and the few best of every block meet in a window of their anchor.

All scores are exact integers: 32-bit floats hold them where sums stay below 2^24, 64-bit floats below 2^53, Python
integers beyond.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.operators.windows import number_rows
from tidemark.session import cut

LEAF = 256  # rows of a leaf
FANOUT = 8  # children of an inner node
BLOCK_ROWS = (1 << 12, 1 << 17)  # of one block, at least and at most: a tree must fit one task
LOW, HIGH = -(2**63), 2**63 - 1
FOUND = "anchor_id long, positive long, other long, score long"


def tiles(matrix: np.ndarray, rows: np.ndarray, coordinates: list[int], leaf: int) -> list[np.ndarray]:
    """Sort, tile, recurse: the rows of each leaf, in the order of packing."""
    wanted = math.ceil(len(rows) / leaf)
    if wanted <= 1 or not coordinates:
        return [rows[k : k + leaf] for k in range(0, len(rows), leaf)]
    slabs = math.ceil(wanted ** (1 / len(coordinates)))
    length = math.ceil(wanted / slabs) * leaf
    ordered = rows[np.argsort(matrix[rows, coordinates[0]], kind="stable")]
    return [t for k in range(0, len(ordered), length) for t in tiles(matrix, ordered[k : k + length], coordinates[1:], leaf)]


def exact_type(largest: float, columns: int, anchor: float) -> type:
    """A number type in which sums of products of such components are exact."""
    bound = float(largest) * float(anchor) * max(columns, 1)
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


class PackedTree:
    """An R-tree over the rows of one block; the label is one more side of each box."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        depth = max(1, math.ceil(math.log2(max(2, len(ids) / leaf))))
        spread = matrix.std(axis=0) if matrix.shape[1] else np.zeros(0)
        widest = [int(c) for c in np.argsort(-spread, kind="stable")[:depth]]
        # Labels come first, a slab for each if there are leaves enough; each slab is tiled by the coordinates.
        by_label = np.argsort(labels, kind="stable")
        slabs = max(1, min(math.ceil(len(ids) / leaf), len(np.unique(labels))))
        length = max(1, math.ceil(len(ids) / slabs))
        leaves = [t for k in range(0, len(ids), length) for t in tiles(matrix, by_label[k : k + length], widest, leaf)]
        order = np.concatenate(leaves)
        self.ids, self.labels, self.matrix = ids[order], labels[order], matrix[order]
        ends = np.cumsum([len(t) for t in leaves])
        self.spans = list(zip([0, *ends[:-1].tolist()], ends.tolist()))  # rows of a leaf
        starts = np.array([a for a, _ in self.spans])
        lo, hi = np.minimum.reduceat(self.matrix, starts), np.maximum.reduceat(self.matrix, starts)
        label_lo, label_hi = np.minimum.reduceat(self.labels, starts), np.maximum.reduceat(self.labels, starts)
        self.children: list[range | None] = [None] * len(leaves)
        boxes = [(lo, hi, label_lo, label_hi)]
        begin, n = 0, len(leaves)
        while n > 1:  # the level above holds consecutive nodes
            starts = np.arange(0, n, fanout)
            self.children += [range(begin + k, begin + min(n, k + fanout)) for k in starts.tolist()]
            lo, label_lo = np.minimum.reduceat(lo, starts), np.minimum.reduceat(label_lo, starts)
            hi, label_hi = np.maximum.reduceat(hi, starts), np.maximum.reduceat(label_hi, starts)
            boxes.append((lo, hi, label_lo, label_hi))
            begin, n = begin + n, len(starts)
        self.root = len(self.children) - 1
        *self.box, self.label_lo, self.label_hi = (np.concatenate(x) for x in zip(*boxes))
        self.form = None
        self.largest = float(np.abs(matrix).max(initial=0))

    def typed(self, width: int, kind: type) -> None:
        """From now on vectors and boxes have this width and numbers of this type."""
        if (width, kind) != self.form:
            self.rows, self.lo, self.hi = (integers(widened(x, width), kind) for x in (self.matrix, *self.box))
            self.form = (width, kind)

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and the highest inner product of each anchor with anything in each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return held(up @ self.lo.T + down @ self.hi.T), held(up @ self.hi.T + down @ self.lo.T)


def integers(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    return np.array([[int(x) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def held(scores: np.ndarray) -> np.ndarray:
    """Scores within the longs; floats are exact, so they are within them anyway."""
    return np.minimum(np.maximum(scores, LOW), HIGH) if scores.dtype == object else scores


def better(found: list[tuple], score, row_id: int, k: int) -> None:
    """Put a candidate among the best ``k``: higher scores first, then smaller ids."""
    entry = (-score, row_id)
    at = len(found)
    while at and entry < found[at - 1]:
        at -= 1
    if at < k:
        found.insert(at, entry)
        del found[k:]


def search(tree: PackedTree, anchor: np.ndarray, anchor_id: int, label: int, low: np.ndarray, high: np.ndarray, windows: list[tuple], k: int, same: bool) -> list[list[tuple]]:
    """For each score window the best ``k`` rows of the same (or of another) label as ``(-score, id)``.

    ``low`` and ``high`` are the intervals of all boxes. A window is ``(least, most)``, both included.
    """
    found: list[list[tuple]] = [[] for _ in windows]
    floors = [w[0] for w in windows]
    ceiling = max(w[1] for w in windows)
    if same:
        fits = (tree.label_lo <= label) & (tree.label_hi >= label)
    else:
        fits = (tree.label_lo != label) | (tree.label_hi != label)
    reached = np.zeros(len(fits), bool)
    for least, most in windows:
        reached |= (high >= least) & (low <= most)
    fits &= reached
    tops = np.minimum(high, ceiling) if ceiling < math.inf else high
    queue = [(-tops[tree.root], tree.root)] if fits[tree.root] else []
    while queue:
        top, node = heappop(queue)
        worst = min(floors)
        if -top < worst:
            break
        inner = tree.children[node]
        if inner is not None:
            for child in inner:
                if fits[child] and tops[child] >= worst:
                    heappush(queue, (-tops[child], child))
            continue
        a, b = tree.spans[node]
        scores = held(tree.rows[a:b] @ anchor)
        near = np.flatnonzero((scores >= worst) & (scores <= ceiling))
        labels, ids = tree.labels[a:b], tree.ids[a:b]
        for r in near:
            if (labels[r] == label) != same:
                continue
            row_id, score = int(ids[r]), scores[r]
            if same and row_id == anchor_id:
                continue
            for w, (least, most) in enumerate(windows):
                if floors[w] <= score <= most:
                    better(found[w], score, row_id, k)
                    if len(found[w]) == k:
                        floors[w] = max(least, -found[w][-1][0])
    return found


def matrix_of(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows; shorter ones are filled with zeros."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if len(lengths) * width == len(values):
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])] = values
    return out


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def searcher(k: int, least: tuple[int, int], same: bool):
    """The task: rows come sorted by block, those of the tree before the anchors that are searched in it."""
    above, below = least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        block, parts, tree = None, [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            asks = batch.column("ask").to_numpy(zero_copy_only=False)
            border = np.flatnonzero((blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *border.tolist()], [*border.tolist(), len(blocks)]):
                if b == a:
                    continue
                if blocks[a] != block:
                    block, parts, tree = blocks[a], [], None
                piece = batch.slice(a, b - a)
                if not asks[a]:
                    parts.append(piece)
                    continue
                if not parts:
                    continue
                if tree is None:
                    stored = pa.Table.from_batches(parts)
                    vectors = matrix_of(stored["v"].combine_chunks())
                    tree = PackedTree(stored["id"].to_numpy(), stored["label"].to_numpy(), vectors)
                yield answer(tree, piece)

    def answer(tree: PackedTree, piece: pa.RecordBatch) -> pa.RecordBatch:
        asked = matrix_of(piece.column("v"))
        width = max(tree.matrix.shape[1], asked.shape[1])
        kind = exact_type(tree.largest, width, np.abs(asked).max(initial=0))
        tree.typed(width, kind)
        anchors = integers(widened(asked, width), kind)
        low, high = tree.intervals(anchors)
        rows: list[tuple] = []
        ids, labels, positives = piece.column("id").to_pylist(), piece.column("label").to_pylist(), piece.column("positives").to_pylist()
        for n, (anchor_id, label, known) in enumerate(zip(ids, labels, positives)):
            if same:
                windows = [(-math.inf, math.inf)]
            else:  # 80 p <= 100 s means s >= ceil(80 p / 100)
                windows = [(-((-above * p["score"]) // below), p["score"]) for p in known]
            for w, best in enumerate(search(tree, anchors[n], anchor_id, label, low[n], high[n], windows, k, same)):
                rows += [(anchor_id, None if same else known[w]["id"], other, int(-s)) for s, other in best]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "positive", "other", "score"])

    return run


def widest(rows: DataFrame, n: int) -> list[int]:
    """The ``n`` coordinates of the largest variance over all rows: sums of every task, summed by Spark."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            m = matrix_of(batch.column(0))
            counted = [np.full(m.shape[1], float(len(m))), m.sum(axis=0), (m * m).sum(axis=0)]
            yield pa.record_batch([pa.array(np.arange(m.shape[1])), *[pa.array(c) for c in counted]], names=["c", "n", "s", "q"])

    by = map_batches(rows.select("v"), sums, "c long, n double, s double, q double").groupBy("c")
    mean = F.sum("s") / F.sum("n")
    spread = by.agg((F.sum("q") / F.sum("n") - mean * mean).alias("spread"))
    return [r["c"] for r in spread.orderBy(F.desc("spread"), "c").limit(n).collect()]


def into_blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with the number of their block: sort, tile and sort again over the whole table."""
    chosen = (widest(rows, 2) + [0, 0])[:2]
    count = rows.count()
    blocks = max(1, math.ceil(count / size))
    slab = math.ceil(blocks / math.ceil(math.sqrt(blocks))) * size
    at = [F.coalesce(F.get(F.col("v"), F.lit(c)), F.lit(0.0)).alias(f"c{k}") for k, c in enumerate(chosen)]
    slabs = number_rows(rows.select("id", "label", *at), ["label", "c0", "id"], "place", unique=True)
    tiled = slabs.select("id", "c1", F.expr(f"(place - 1) div {slab}").alias("slab"))
    placed = number_rows(tiled, ["slab", "c1", "id"], "place", unique=True)
    return rows.join(placed.select("id", F.expr(f"(place - 1) div {size}").alias("block")), "id")


def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of all blocks, with their rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, k: int = 5, window: tuple[int, int] = (80, 100), id_column: str = "vec_id", label: str = "label", vector: str = "vector") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` hold integers (as numbers of any type). Anchors are the rows where ``anchor`` is true. Positives are the first
    ``k`` other rows of an anchor's label, by score and then by smaller id; the negatives of a positive are the first ``k`` rows of another
    label whose score is at least ``window[0] / window[1]`` of the positive's and at most the positive's. A positive
    without such a row gives none.

    Rows with a NULL id, label, vector or component, or a component that is not finite, take no part. Of rows that
    share an id the smallest (by label, then vector) stands. Vectors of different lengths are filled with zeros.
    A score beyond a long counts as the end of the longs. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    finite = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf))
    given = vectors.filter(F.col(f"`{id_column}`").isNotNull() & F.col(f"`{label}`").isNotNull() & finite).select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.struct(F.col(f"`{label}`").cast("bigint").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"), anchor.alias("anchor")).alias("row"),
    )
    rows = cut(given.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v", "row.anchor"))
    count = rows.count()
    size = max(BLOCK_ROWS[0], min(BLOCK_ROWS[1], math.ceil(count / (2 * spark.sparkContext.defaultParallelism))))
    blocks = max(1, math.ceil(count / size))
    placed = cut(into_blocks(rows.select("id", "label", "v"), size))
    anchors = rows.filter("anchor").select("id", "label", "v")
    positives = "array<struct<id: bigint, score: bigint>>"

    def searched(asked: DataFrame, same: bool) -> DataFrame:
        stored = placed.select("block", F.lit(False).alias("ask"), "id", "label", "v", F.lit(None).cast(positives).alias("positives"))
        asks = asked.select(
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
            F.lit(True).alias("ask"),
            *["id", "label", "v", "positives"],
        )
        met = stored.unionByName(asks).repartition(2 * blocks, "block").sortWithinPartitions("block", "ask")
        return map_batches(met, searcher(k, window, same), FOUND)

    near = best(searched(anchors.withColumn("positives", F.lit(None).cast(positives)), True), ["anchor_id"], k)
    near = cut(near.select("anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")))
    entry = F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    known = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(entry).alias("positives"))  # at most k
    far = best(searched(anchors.join(known, "id"), False), ["anchor_id", "positive"], k)
    found = far.select("anchor_id", F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(near, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
