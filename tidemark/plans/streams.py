"""Queries over directory streams: the given events arrive as files in a growing folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.registry import Tables, query
from tidemark.session import scratch
from tidemark.sources.writers import write_files
from tidemark.streaming import ingest

EVENTS = "event_id bigint, user_id bigint, event_type string, value double"
COLUMNS = ["event_id", "user_id", "event_type", "value"]
_ALL = "SELECT event_id, user_id, event_type, value FROM events"


def _folders(t: Tables, label: str) -> tuple[str, str, str]:
    base = scratch(t.spark, label)
    return f"{base}/landing", f"{base}/table", f"{base}/checkpoint"


def _land(rows: DataFrame, folder: str, files: int = 3) -> None:
    rows.repartition(files).write.mode("append").option("header", True).csv(folder)


@query("r1_stream_csv", _ALL)
def r1(t: Tables) -> DataFrame:
    src, target, checkpoint = _folders(t, "r1")
    _land(t.events.select(*COLUMNS), src)
    stream = ingest.stream_files(t.spark, src, EVENTS)
    ingest.run_to_end(ingest.stream_append(stream, target, checkpoint))
    return ingest.read_target(t.spark, target)


@query("r2_stream_to_table", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def r2(t: Tables) -> DataFrame:
    src, _, checkpoint = _folders(t, "r2")
    name = f"tidemark_r2_{uuid.uuid4().hex[:12]}"
    _land(t.events.select(*COLUMNS), src)
    path = scratch(t.spark, "r2-table")
    t.spark.sql(f"CREATE TABLE {name} ({EVENTS}) USING parquet LOCATION '{path}'")
    stream = ingest.stream_files(t.spark, src, EVENTS)
    ingest.run_to_end(ingest.stream_append(stream, name, checkpoint, name=f"append_{name}", table=True))
    return t.spark.table(name).groupBy("event_type").agg(F.count("*").alias("n"))


@query("r3_restart", _ALL)
def r3(t: Tables) -> DataFrame:
    src, target, checkpoint = _folders(t, "r3")
    rows = t.events.select(*COLUMNS)
    for part in ("event_type = 'click'", "event_type = 'view'", "event_type NOT IN ('click', 'view')"):
        _land(rows.filter(part), src)
        stream = ingest.stream_files(t.spark, src, EVENTS)
        ingest.run_to_end(ingest.stream_append(stream, target, checkpoint))
    return ingest.read_target(t.spark, target)


@query("r4_reprocess", _ALL)
def r4(t: Tables) -> DataFrame:
    src, target, checkpoint = _folders(t, "r4")
    _land(t.events.select(*COLUMNS), src)
    ingest.run_to_end(ingest.stream_append(ingest.stream_files(t.spark, src, EVENTS), target, checkpoint))
    return ingest.reprocess(t.spark, src, f"{target}-2", f"{checkpoint}-2", EVENTS)


@query("r5_files_per_batch", _ALL)
def r5(t: Tables) -> DataFrame:
    src, target, checkpoint = _folders(t, "r5")
    _land(t.events.select(*COLUMNS), src, files=6)
    stream = ingest.stream_files(t.spark, src, EVENTS, max_files_per_trigger=2)
    started = ingest.stream_append(stream, target, checkpoint)
    ingest.run_to_end(started)
    if started.lastProgress is None or started.lastProgress["batchId"] < 2:
        raise AssertionError("six files at two per batch need three batches")
    return ingest.read_target(t.spark, target)


@query("r6_stop", _ALL)
def r6(t: Tables) -> DataFrame:
    src, target, checkpoint = _folders(t, "r6")
    _land(t.events.select(*COLUMNS), src)
    running = ingest.stream_append(ingest.stream_files(t.spark, src, EVENTS), target, checkpoint, available_now=False)
    running.processAllAvailable()
    running.stop()
    if running.isActive:
        raise AssertionError("the query still runs")
    return ingest.read_target(t.spark, target)


@query(
    "r7_widened_schema",
    """SELECT event_id, user_id, event_type, value, CASE WHEN event_type <> 'view' THEN CAST(year(ts) AS INTEGER) END AS year,
              CASE WHEN event_type <> 'view' THEN monthname(ts) END AS month FROM events""",
)
def r7(t: Tables) -> DataFrame:
    src, target, checkpoint = _folders(t, "r7")
    narrow, wide = f"{src}/narrow", f"{src}/wide"
    write_files(t.events.filter("event_type = 'view'").select(*COLUMNS), narrow, "csv")
    ingest.run_to_end(ingest.stream_append(ingest.stream_files(t.spark, f"{src}/*", EVENTS), target, checkpoint))
    dated = t.events.filter("event_type <> 'view'").select(*COLUMNS, F.year("ts").alias("year"), F.date_format("ts", "MMMM").alias("month"))
    write_files(dated, wide, "csv")
    widened = ingest.stream_files(t.spark, f"{src}/*", f"{EVENTS}, year int, month string", enforceSchema="false")
    ingest.run_to_end(ingest.stream_append(widened, target, checkpoint))
    return ingest.read_target(t.spark, target, merge_schema=True)
