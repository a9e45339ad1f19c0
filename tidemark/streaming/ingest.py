"""Directory streams, checkpointed append sinks and idempotent file ingest.

A source folder and one checkpoint belong to one target. The checkpoint records which files were
read, so a run after a stop or a lost driver continues with the files that are new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.readers import is_file
from tidemark.sources.writers import conform


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of a folder's files with a declared schema; fields missing in a file are NULL.

    A path to one file is an error: the source is a folder that grows.
    """
    if is_file(spark, folder):
        raise ValueError("a stream reads a folder, not one file")
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def stream_append(
    df: DataFrame,
    target: str,
    checkpoint: str,
    name: str | None = None,
    available_now: bool = True,
    table: bool = False,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a path or a table. ``available_now`` ends after the files present at the start."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.toTable(target) if table else writer.start(target)


def run_to_end(query: StreamingQuery) -> int:
    """Wait for an ``available_now`` query; returns the rows it read, and raises what it failed with."""
    rows: dict[int, int] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(5)
        for p in query.recentProgress:
            rows[p.batchId] = max(rows.get(p.batchId, 0), p.numInputRows)
    return sum(rows.values())


def create_target(spark: SparkSession, table: str, schema: str | T.StructType, path: str | None = None) -> None:
    """Create the table that files are loaded into, unless it exists."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=_struct(schema))


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def copy_into(
    spark: SparkSession,
    src: str,
    table: str,
    checkpoint: str,
    schema: str | T.StructType,
    fmt: str = "parquet",
    merge_schema: bool = False,
    **options: str,
) -> int:
    """Load each file of a folder once; returns the rows loaded by this run (0 when nothing is new).

    The source schema must match the table's, unless ``merge_schema`` lets it add columns. The
    table's schema is kept by the catalog, so no footers of earlier files are read.
    """
    stream = conform(spark.table(table).schema, stream_files(spark, src, schema, fmt, **options), merge_schema)
    known = {c.lower() for c in spark.table(table).columns}
    added = [f for f in stream.schema.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return run_to_end(stream_append(stream, table, checkpoint, table=True))


def read_target(spark: SparkSession, target: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """What a stream has written to a path; ``merge_schema`` unites the columns of files of different runs."""
    return spark.read.option("mergeSchema", merge_schema).format(fmt).load(target)


def reprocess(
    spark: SparkSession, src: str, target: str, checkpoint: str, schema: str | T.StructType, fmt: str = "csv", **options: str
) -> DataFrame:
    """Load everything again into a new target with a new checkpoint; the old ones stay for readers."""
    run_to_end(stream_append(stream_files(spark, src, schema, fmt, **options), target, checkpoint))
    return read_target(spark, target)
