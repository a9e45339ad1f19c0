"""SimHash near-duplicates by exact comparison of tiles.

Only distinct fingerprints are compared. They are laid out in cells by the population counts of their
four 16-bit parts. Two fingerprints within the radius differ by at most the radius in the sum of these counts,
so tiles of cells further apart are skipped without loss. The tiles of the other pairs are compared whole,
with exclusive-or and bit counts in numpy, and each pair of tiles returns a spanning forest of its links,
never the links themselves: no more rows than it has fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches, without
from tidemark.llm.components import components
from tidemark.session import cut

WORDS = 3
RADIUS = 2
SEED = 42
TILE = 2_048  # fingerprints in a tile, on average at most
PARTS = 4  # 17 ** 4 cells at most
PART_BITS = 64 // PARTS
HASHES = 1 << 15  # hashes whose bits are counted at a time


def fingerprint(text: str, words: int = WORDS) -> int:
    """A bit is set where more than half of the hashes of the word shingles set it."""
    found = text.encode().lower().split()  # of bytes: folds A-Z only, splits at ASCII white space
    if not found:
        return 0
    shingles = [b" ".join(found)] if len(found) < words else list(map(b" ".join, zip(*(found[k:] for k in range(words)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), HASHES):
        bits = np.unpackbits(hashes[k : k + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as a signed long. NULL counts as the empty text: zero."""
    source = without(docs, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            values = np.fromiter((fingerprint(t.as_py() or "") for t in column), np.uint64, len(column))
            yield batch.append_column(out, pa.array(values.view(np.int64)))

    return map_batches(source, run, T.StructType([*source.schema.fields, T.StructField(out, T.LongType())]))


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that it reaches by the given links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        lower = label.copy()
        np.minimum.at(lower, left, low)
        np.minimum.at(lower, right, low)
        lower = lower[lower]
        if np.array_equal(lower, label):
            return label
        label = lower


def linked(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and their roots in the links between the fingerprints of two tiles."""
    left, right = [], []
    step = max(1, (1 << 18) // max(1, len(b)))
    for k in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[k : k + step, None] ^ b[None, :]) <= radius)
        left.append(i + k)
        right.append(j + len(a))
    both = np.concatenate([a, b])
    label = forest(len(both), np.concatenate(left), np.concatenate(right)) if len(a) else np.arange(len(both))
    moved = np.nonzero(label != np.arange(len(both)))[0]
    members, roots = both[moved], both[label[moved]]
    own = members != roots
    return members[own], roots[own]


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Offsets of population counts within the radius; of an offset and its opposite only one."""
    span = range(-radius, radius + 1)
    near = [o for o in product(span, repeat=PARTS) if sum(map(abs, o)) <= radius]
    return [o for o in near if o >= (0,) * PARTS]


def _cell(counts: list[Column]) -> Column:
    return sum((c * (PART_BITS + 1) ** k for k, c in enumerate(counts)), F.lit(0))


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links between distinct fingerprints, column ``fp``."""
    parts = [
        F.bit_count(F.shiftrightunsigned("fp", k * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1))).cast("int")
        for k in range(PARTS)
    ]
    placed = distinct.select("fp", *[p.alias(f"p{k}") for k, p in enumerate(parts)])
    names = [f"p{k}" for k in range(PARTS)]
    # one row per cell: 83,521 at most, whatever the input
    cells = cut(placed.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")))
    cell = _cell([F.col(n) for n in names])
    cells = cells.withColumn("cell", cell)
    block = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiles = cut(
        placed.withColumn("cell", cell)
        .join(F.broadcast(cells.select("cell", "tiles")), "cell")
        .groupBy("cell", block.alias("block"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    offsets = F.array(*[F.array(*[F.lit(x) for x in o]) for o in _steps(radius)])
    beside = [F.col(n) + F.col("__o")[k] for k, n in enumerate(names)]
    inside = [(b >= 0) & (b <= PART_BITS) for b in beside]
    near = cells.withColumn("__o", F.explode(offsets)).filter(inside[0] & inside[1] & inside[2] & inside[3])
    pairs = (
        near.select(F.col("cell").alias("cell_a"), F.col("tiles").alias("tiles_a"), _cell(beside).alias("cell_b"))
        .join(F.broadcast(cells.select(F.col("cell").alias("cell_b"), F.col("tiles").alias("tiles_b"))), "cell_b")
        .withColumn("block_a", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)))
        .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("tiles_b") - 1)))
        .filter("cell_a <> cell_b OR block_a <= block_b")
        .select("cell_a", "block_a", "cell_b", "block_b")
    )
    sides = [tiles.select(*[F.col(c).alias(f"{c}_{s}") for c in ("cell", "block", "fps")]) for s in "ab"]
    tasks = pairs.join(sides[0], ["cell_a", "block_a"]).join(sides[1], ["cell_b", "block_b"]).select("fps_a", "fps_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                a, b = (side.values.to_numpy(zero_copy_only=False).view(np.uint64) for side in (left, right))
                members, roots = linked(a, b, radius)
                if len(members):
                    yield pa.record_batch({"a": pa.array(members.view(np.int64)), "b": pa.array(roots.view(np.int64))})

    return map_batches(tasks, compare, "a long, b long")


def simhash_components(docs: DataFrame, text: str = "text", id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``(id, fp, component_id)`` for every row: fingerprint, and the smallest id of its group of near copies.

    Fingerprints that differ in ``radius`` bits or fewer are linked. NULL and empty texts have the
    fingerprint zero and are linked like any other. NULL ids are passed over as ``component_id`` unless a group has
    no other. Repeated rows are members like any other. An empty table gives an empty result.
    """
    rows = cut(
        fingerprints(docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text")), "__text", "fp")
        .select("__id", "fp")
    )
    distinct = cut(rows.groupBy("fp").agg(F.min("__id").alias("low")))
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    grouped = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = grouped.filter(F.col("root") != F.col("fp")).groupBy("root").agg(F.min("low").alias("other"))
    group_low = grouped.filter("root = fp").select("root", F.col("low").alias("own")).join(lowest, "root", "left")
    group_low = group_low.select("root", F.least("own", "other").alias("component_id"))
    named = grouped.select("fp", "root").join(group_low, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("__id").alias(id_column), "fp", "component_id")


def simhash_dedup(docs: DataFrame, text: str = "text", id_column: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``docs`` without the near copies: of each group the row with the smallest id stays.

    A row with a NULL id cannot be named and stays, as do rows that repeat the id that stays.
    """
    found = simhash_components(docs, text, id_column, radius)
    copies = found.filter(F.col(f"`{id_column}`") != F.col("component_id")).select(F.col(f"`{id_column}`").alias("__gone"))
    return docs.join(cut(copies.distinct()), F.col(f"`{id_column}`") == F.col("__gone"), "left_anti")
