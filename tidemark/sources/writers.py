"""Sinks (K1-K7). No sink reads and overwrites one path, and none runs one job per file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import quoted
from tidemark.session import cut
from tidemark.sources.readers import read_sources

UNEVEN = 1.5  # the largest of a given number of files may have so many times the rows of the average one


def _dated(run_date: dt.date) -> list[Column]:
    return [
        F.lit(run_date.year).alias("year"),
        F.lit(run_date.month).alias("month"),
        F.lit(run_date.day).alias("day"),
    ]


def land_to_bronze(
    spark: SparkSession, sources: dict[str, str], out: str, run_date: dt.date, fmt: str = "parquet", **options: str
) -> None:
    """Copy landed CSV files, all columns as text, to ``source=/year=/month=/day=`` folders.

    ``sources`` maps a source to its folder or file. There is one job per header layout, not one per
    file. Rows are rebalanced by source, so small sources are merged and a source that holds most rows
    is spread over many tasks.
    """
    for rows in read_sources(spark, sources, **options):
        write_partitioned(rows.select("*", *_dated(run_date)), out, ["source", "year", "month", "day"], fmt)


def read_layer(spark: SparkSession, base: str, source: str, fmt: str = "parquet") -> DataFrame:
    """One source of a layer, with its dates as columns."""
    return spark.read.format(fmt).option("header", True).load(f"{base}/source={source}")


def write_partitioned(df: DataFrame, out: str, parts: list[str], fmt: str = "parquet", **options: str) -> None:
    """Overwrite only the partitions present in ``df``; hot partitions are split, small ones merged."""
    (
        df.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .options(**options)
        .partitionBy(*parts)
        .format(fmt)
        .save(out)
    )


def write_layer(df: DataFrame, base: str, run_date: dt.date, fmt: str = "parquet") -> DataFrame:
    """Overwrite one dated partition of a layer and leave the other days alone."""
    (
        df.select("*", *_dated(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("year", "month", "day")
        .format(fmt)
        .save(base)
    )
    return df.sparkSession.read.format(fmt).option("header", True).load(base)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite", fmt: str = "parquet") -> DataFrame:
    """Create or replace a table, managed or at ``path``."""
    writer = df.write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def conform(target: T.StructType, new: DataFrame, merge_schema: bool = False) -> DataFrame:
    """Check ``new`` against the target schema and give it the target's columns.

    A missing column is NULL, an extra column is rejected unless ``merge_schema`` adds it, and a
    changed type is always rejected.
    """
    have = {f.name.lower(): f for f in target.fields}
    extra = [f for f in new.schema.fields if f.name.lower() not in have]
    if extra and not merge_schema:
        raise ValueError(f"columns not in the target: {sorted(f.name for f in extra)}")
    for f in new.schema.fields:
        known = have.get(f.name.lower())
        if known is not None and known.dataType != f.dataType:
            raise ValueError(f"{f.name}: {f.dataType.simpleString()} does not match {known.dataType.simpleString()}")
    given = {f.name.lower(): f.name for f in new.schema.fields}
    columns = [
        (quoted(given[f.name.lower()]) if f.name.lower() in given else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target.fields
    ]
    return new.select(*columns, *[quoted(f.name) for f in extra])


def append_enforced(target: DataFrame, new: DataFrame, merge_schema: bool = False) -> DataFrame:
    """Target plus the checked new rows."""
    return target.unionByName(conform(target.schema, new, merge_schema), allowMissingColumns=True)


def write_files(df: DataFrame, path: str, fmt: str = "parquet", files: int | None = None, **options: str) -> None:
    """Write a given number of files, or leave their size to the rebalance step.

    A file is the work of one task. Rows are written in parallel first, and the files are joined from whole
    splits of that table, so a task reads compressed columns instead of shuffled rows. Where whole splits do not
    make so many files, or uneven ones, rows are dealt out one by one. ``files=1`` is a single task and fits only small results.
    """
    if files:
        staged = cut(df)
        joined = staged.coalesce(files)
        n, most, rows = partition_sizes(joined).agg(F.count(F.lit(1)), F.max("count"), F.sum("count")).first()
        sized = joined if n == files and most * files <= UNEVEN * rows else staged.repartition(files)
    else:
        sized = df.hint("rebalance")
    sized.write.mode("overwrite").option("header", True).options(**options).format(fmt).save(path)


def split_good_bad(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where ``ok`` is true, and all others (false or NULL)."""
    verdict = F.coalesce(ok, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def tag_good_bad(df: DataFrame, ok: Column) -> DataFrame:
    """Every row with its ``verdict``, good or bad, in one read."""
    return df.withColumn("verdict", F.when(F.coalesce(ok, F.lit(False)), "good").otherwise("bad"))


def write_good_bad(df: DataFrame, ok: Column, out: str, fmt: str = "parquet") -> DataFrame:
    """Both halves in one job and one read, as ``verdict=good`` and ``verdict=bad`` folders."""
    (
        tag_good_bad(df, ok)
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("verdict")
        .format(fmt)
        .save(out)
    )
    return df.sparkSession.read.format(fmt).option("header", True).load(out)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, to see skew."""
    return df.groupBy(F.spark_partition_id().alias("partition")).count()
