"""File layout: compaction, multi-column clustering, interval depth."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import quoted
from tidemark.operators.windows import number_rows
from tidemark.sources.readers import list_files


def compact(spark: SparkSession, path: str, out: str, target_mb: int = 128, fmt: str = "parquet") -> int:
    """Rewrite a folder as files of about the target size, without a shuffle; returns their number."""
    size = list_files(spark, path).filter(~F.startswith("name", F.lit("_"))).agg(F.sum("size")).first()[0] or 0
    files = max(1, math.ceil(size / (target_mb * 1024 * 1024)))
    spark.read.format(fmt).load(path).coalesce(files).write.mode("overwrite").format(fmt).save(out)
    return files


def _bucket(c: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds are at or below the value: a binary search in one literal array.

    The expression does not grow with the bounds. NULL is in bucket 0.
    """
    n = len(bounds)
    if not n:
        return F.lit(0)
    listed = F.lit([float(b) for b in bounds])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])

    def further(at: Column, step: Column) -> Column:
        reached = F.element_at(listed, F.least(at + step, F.lit(n)))
        return F.when((at + step <= n) & (c >= reached), at + step).otherwise(at)

    return F.aggregate(halves, F.lit(0), further)


def quantile_bounds(df: DataFrame, columns: list[str], bits: int) -> dict[str, list[float]]:
    """At most 2^bits - 1 bounds per numeric column, from one approximate pass."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(quoted(c).cast("double"), shares).alias(c) for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def z_value(columns: list[Column], bounds: list[list[float]], bits: int) -> Column:
    """Interleave the bits of the columns' quantile buckets."""
    z = F.lit(0).cast("bigint")
    for j, (c, b) in enumerate(zip(columns, bounds)):
        bucket = _bucket(c.cast("double"), b).cast("bigint")
        for i in range(bits):
            bit = F.shiftright(bucket, i).bitwiseAND(F.lit(1))
            z = z + F.shiftleft(bit, i * len(columns) + j)
    return z


def zorder_bits(files: int, columns: int) -> int:
    """Bits for each column so that there are about 16 cells for each file, within a 62-bit z-value.

    Bounds are found by sorting quantiles on the driver, so a column has at most 2^12 buckets.
    """
    return max(1, min(12, 62 // columns, math.ceil((math.log2(max(1, files)) + 4) / columns)))


def zorder(
    df: DataFrame,
    columns: list[str],
    files: int,
    bits: int | None = None,
    name: str | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """Cluster rows over several numeric columns; ``bits`` follows from the number of files.

    A z-value that holds very many rows is split over several files by ``spread``: a hash of the whole
    row, or an expression that also tells exact copies apart (such as the row index of a scan).
    """
    bits = bits or zorder_bits(files, len(columns))
    bounds = quantile_bounds(df, columns, bits)
    z = z_value([quoted(c) for c in columns], [bounds[c] for c in columns], bits)
    spread = F.xxhash64(*[quoted(c) for c in df.columns]) if spread is None else spread
    placed = df.withColumn("_z", z).repartitionByRange(files, "_z", spread).sortWithinPartitions("_z", *columns)
    return placed.withColumnRenamed("_z", name) if name else placed.drop("_z")


def file_ranges(df: DataFrame, key: str, file: str | Column = "_metadata.file_path") -> DataFrame:
    """Smallest and largest key of each file; the only step that reads the table."""
    file = F.col(file) if isinstance(file, str) else file
    return df.groupBy(file.alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo IS NOT NULL")


def interval_depth(ranges: DataFrame) -> DataFrame:
    """Per file: how many other files overlap its range, and the most ranges that share one of its points.

    Nothing is paired. Starts and ends are sorted once (starts first on ties) and numbered. Overlaps
    are differences of these ranks. The depth at a start is (starts so far, ties included) minus
    (ends before it), and the largest depth within a file's range comes from maxima over aligned
    blocks of 2^k starts: a range is covered by at most two blocks per level.
    """
    ends = ranges.select("file", F.explode(F.array(
        F.struct(F.col("lo").alias("v"), F.lit(0).alias("kind")),
        F.struct(F.col("hi").alias("v"), F.lit(1).alias("kind")),
    )).alias("e")).select("file", "e.v", "e.kind")
    ranked = number_rows(ends, ["v", "kind", "file"], "pos", unique=True)
    ranked = number_rows(ranked, ["v", "file"], "rank", partition=["kind"], unique=True)
    starts = ranked.filter("kind = 0").select("file", "v", "pos", "rank")
    stops = ranked.filter("kind = 1").select("file", F.col("pos").alias("e_pos"), F.col("rank").alias("e_rank"))
    # Before a start: pos - rank ends. Up to a stop: e_pos - e_rank starts.
    tied = starts.groupBy("v").agg(F.max("rank").alias("last"), F.min("rank").alias("first"))
    points = starts.join(tied, "v").select(
        "file",
        "rank",
        (F.col("pos") - F.col("rank")).alias("ended"),
        F.col("last"),
        F.col("first"),
    )
    depth = points.select((F.col("rank") - 1).alias("at"), (F.col("last") - F.col("ended")).alias("depth"))
    files = points.join(stops, "file").select(
        "file",
        (F.col("e_pos") - F.col("e_rank") - F.col("ended") - 1).alias("n_overlaps"),
        (F.col("first") - 1).alias("a"),
        (F.col("e_pos") - F.col("e_rank")).alias("b"),
    )
    count = starts.agg(F.count(F.lit(1)).alias("n")).scalar()
    levels = F.sequence(F.lit(0), F.ceil(F.log2(count + 1)).cast("int"))
    blocks = (
        depth.select("depth", "at", F.explode(levels).alias("level"))
        .groupBy("level", F.expr("shiftright(at, level)").alias("block"))
        .agg(F.max("depth").alias("depth"))
    )
    cover = files.select("file", "n_overlaps", "a", "b", F.explode(levels).alias("level"))
    left = F.expr("shiftright(a + shiftleft(1L, level) - 1, level)")
    right = F.expr("shiftright(b, level)")
    nodes = cover.withColumn("_l", left).withColumn("_r", right).filter("_l < _r")
    nodes = nodes.select(
        "file",
        "n_overlaps",
        "level",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("_l") % 2 == 1, F.col("_l")),
                    F.when(F.col("_r") % 2 == 1, F.col("_r") - 1),
                )
            )
        ).alias("block"),
    )
    return nodes.join(blocks, ["level", "block"]).groupBy("file").agg(
        F.max("n_overlaps").alias("n_overlaps"), F.max("depth").alias("depth")
    )


def layout_depth(df: DataFrame, key: str, file: str | Column = "_metadata.file_path") -> DataFrame:
    """File count, average overlaps and average depth of a table by one key."""
    per_file = interval_depth(file_ranges(df, key, file))
    return per_file.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.round(F.avg("n_overlaps"), 4).alias("avg_overlaps"),
        F.round(F.avg("depth"), 4).alias("avg_depth"),
    )
