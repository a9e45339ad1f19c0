"""Sharding by histogram sort: exact byte histograms refine the splitters, then one exchange.

Key order is (hash of the text, id, row number), so equal texts stand together and even one text that
fills a third of the table can be cut between its rows. In each round the bytes of the rows whose key
starts with an undecided prefix are summed by the next three digits, which gives the exact bytes below
4,096 evenly placed probes inside each open interval. A splitter is settled once its interval holds
fewer bytes than the tolerance, or a single row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_of, unsigned_hex, without
from tidemark.session import cut

DIGITS = 3  # hexadecimal digits a round: 4,096 probes in each open interval
TOLERANCE = 1e-4  # share of a shard's bytes that a splitter may miss
KEY_DIGITS = 48


@dataclass
class _Open:
    """A splitter between shards: it lies among the keys that start with ``prefix``."""

    target: float  # bytes that should lie below
    prefix: str = ""
    below: int = 0  # bytes of all keys before the prefix
    bound: str | None = None  # smallest key of the right-hand shard, once settled


def _splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[str]:
    """The shard borders, each the smallest key prefix of the right-hand shard. Driver state: shards - 1 entries."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    opened = [_Open(total * k / shards) for k in range(1, shards)]
    for depth in range(0, KEY_DIGITS, DIGITS):
        active = sorted({o.prefix for o in opened if o.bound is None})
        if not active or not total:
            break
        rows = keyed if active == [""] else keyed.filter(F.substring("key", 1, depth).isin(active))
        counted = (
            rows.groupBy(F.substring("key", 1, depth + DIGITS).alias("probe"))
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
            .collect()  # at most (shards - 1) * 4,096 sums
        )
        histogram: dict[str, list[tuple[str, int, int]]] = {}
        for probe, size, n in sorted(counted):
            histogram.setdefault(probe[:depth], []).append((probe, size, n))
        for o in opened:
            if o.bound is not None:
                continue
            below = o.below
            for probe, size, n in histogram[o.prefix]:
                if below + size >= o.target:
                    break
                below += size
            o.prefix, o.below = probe, below
            if n == 1 or size <= allowed or depth + DIGITS >= KEY_DIGITS:
                # the nearer side of the interval that is left
                o.bound = probe if o.target - below <= below + size - o.target else probe + "g"
    return [o.bound or "" for o in opened]


def histogram_shards(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shards: int = 16, tolerance: float = TOLERANCE
) -> DataFrame:
    """One row per row of ``docs``: ``(id, size, text_crc32, law, shard, slot, grown_shard)``.

    ``size`` is the UTF-8 length of the text plus one; NULL text has none. Shard sizes differ by at most
    the tolerance or one row. ``slot`` counts the rows of a shard from 0 in key order. Ids that are no whole
    numbers are ordered by their hash; NULL ids come first among equal texts; repeated rows get slots of their own. An empty table gives an empty result; with
    few rows some shards stay empty.
    """
    body, doc = text_of(text), F.col(f"`{id_column}`")
    whole = isinstance(docs.schema[id_column].dataType, T.IntegralType)
    number = doc.cast("bigint") if whole else F.when(doc.isNotNull(), F.xxhash64(doc.cast("string")))
    key = F.concat(
        unsigned_hex(F.xxhash64(body)),
        F.coalesce(unsigned_hex(number), F.lit("0" * 16)),
        unsigned_hex(F.monotonically_increasing_id()),
    )
    keyed = cut(
        docs.select(
            F.col(f"`{id_column}`").alias("__id"),
            F.when(F.col(f"`{text}`").isNull(), F.lit(0)).otherwise(F.octet_length(body)).cast("bigint").alias("bytes"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            key.alias("key"),
        ).withColumn("size", F.col("bytes") + 1)
    )
    bounds = _splitters(keyed, shards, tolerance)
    shard: Column = sum((F.when(F.col("key") >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    return _numbered(keyed.withColumn("shard", shard)).select(
        F.col("__id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """The one exchange: rows sorted by key, each with its place in its shard.

    The sorted rows are written with the task that sorted them and their place there; the place in the
    shard follows from one count per task and shard.
    """
    row = F.monotonically_increasing_id()
    placed = cut(rows.repartitionByRange("key").sortWithinPartitions("key").withColumn("__row", row))
    placed = placed.withColumn("__task", F.shiftright("__row", 33))
    counts = placed.groupBy("__task", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("__first"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("__task")) - F.col("n")
    starts = counts.select("__task", "shard", (before - F.col("__first")).alias("__start"))
    # at most one row per task and one per border: a size that does not follow the rows
    return placed.join(F.broadcast(starts), ["__task", "shard"]).withColumn("slot", F.col("__row") + F.col("__start"))


def shard_tables(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shards: int = 16) -> DataFrame:
    """Bytes and rows of each shard, for a report."""
    return (
        histogram_shards(without(docs, "shard"), text, id_column, shards)
        .groupBy("shard")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )
