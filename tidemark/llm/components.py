"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut


def _state(edges: DataFrame) -> tuple:
    """Count and order-free hash of the edges: equal where the table did not change."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("big", "small")), F.sum(F.hash("big", "small"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the smallest node that it reaches.

    Each round replaces edges by stars whose centre is the smallest neighbour, so the number of rounds
    grows with the logarithm of the longest path. Minima are aggregated partially before each shuffle, and
    joins on a hub are split by Spark. Each round is written to the shared folder. Edges with a NULL end and
    loops are ignored; an empty table has no components.
    """
    ordered = edges.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small"))
    current = cut(ordered.filter((F.col(a) != F.col(b))).distinct())
    state = _state(current)
    while state[0]:
        both = current.select(F.col("big").alias("u"), F.col("small").alias("v")).unionByName(
            current.select(F.col("small").alias("u"), F.col("big").alias("v"))
        )
        centre = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(centre, "u").select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()
        lowest = large.groupBy("big").agg(F.min("small").alias("m"))
        moved = large.join(lowest, "big").filter("small <> m").select(F.col("small").alias("big"), F.col("m").alias("small"))
        current = cut(moved.unionByName(lowest.select("big", F.col("m").alias("small"))).distinct())
        before, state = state, _state(current)
        if state == before:
            break
    members = current.select(F.col("big").alias("node"), F.col("small").alias("root"))
    return members.unionByName(current.select(F.col("small").alias("node"), F.col("small").alias("root")).distinct())
