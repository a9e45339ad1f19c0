"""Load bookkeeping: audit rows, run logs, snapshot and child registration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import moment
from tidemark.functions.text import file_date
from tidemark.operators.dimensions import CLOSE, INSERT

# Load states.
QUEUED, RUNNING, FAILED, SUCCESSFUL = "Queued", "Running", "Failed", "Successful"
# Fixed values end.

SNAPSHOT_LOG = (
    "snapshot_date date, created timestamp_ntz, updated timestamp_ntz, started timestamp_ntz, ended timestamp_ntz, "
    "status string"
)


def _no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def audit_row(tagged: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """Inserted and updated counts of a tagged type 2 result; a time only where rows were touched.

    A changed key counts once as updated, its new version not as inserted.
    """
    counts = tagged.agg(
        F.count_if(F.col("_action") == INSERT).alias("opened"), F.count_if(F.col("_action") == CLOSE).alias("updated_count")
    )
    inserted = F.col("opened") - F.col("updated_count")
    return counts.select(
        F.lit(table).alias("table_name"),
        inserted.alias("inserted_count"),
        "updated_count",
        F.when(inserted > 0, moment(as_of)).alias("inserted_at"),
        F.when(F.col("updated_count") > 0, moment(as_of)).alias("updated_at"),
    )


def load_run(
    df: DataFrame, source: str, destination: str, watermark: Column, started: dt.datetime, ended: dt.datetime
) -> DataFrame:
    """One log row of a finished copy: rows, seconds, watermark, status."""
    return df.agg(F.count(F.lit(1)).alias("rows_read"), watermark.alias("watermark")).select(
        F.lit(source).alias("source_table"),
        F.lit(destination).alias("destination"),
        moment(started).alias("trigger_time"),
        "rows_read",
        F.col("rows_read").alias("rows_copied"),
        F.lit(int((ended - started).total_seconds())).alias("copy_seconds"),
        "watermark",
        F.lit(SUCCESSFUL).alias("status"),
    )


def append_load_log(log: DataFrame, run: DataFrame) -> DataFrame:
    return log.unionByName(run)


def register_snapshot(log: DataFrame, snapshot: dt.date, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Queue a snapshot date; returns the new log and its queued dates in order.

    A failed date invalidates itself and all later dates. The snapshot's own failed or running row
    loses its times, and a date without a row gets one. A snapshot that is already successful queues nothing.
    """
    first_failed = log.filter(F.col("status") == FAILED).agg(F.min("snapshot_date").alias("d")).scalar()
    requeue = F.coalesce(F.col("snapshot_date") >= first_failed, F.lit(False))
    own = (F.col("snapshot_date") == F.lit(snapshot)) & ~requeue & F.col("status").isin(FAILED, RUNNING)
    kept = log.select(
        "snapshot_date",
        "created",
        F.when(requeue | own, moment(as_of)).otherwise(F.col("updated")).alias("updated"),
        F.when(own, _no_time()).otherwise(F.col("started")).alias("started"),
        F.when(own, _no_time()).otherwise(F.col("ended")).alias("ended"),
        F.when(requeue | own, QUEUED).otherwise(F.col("status")).alias("status"),
    )
    fresh = log.sparkSession.range(1).select(
        F.lit(snapshot).alias("snapshot_date"),
        moment(as_of).alias("created"),
        moment(as_of).alias("updated"),
        _no_time().alias("started"),
        _no_time().alias("ended"),
        F.lit(QUEUED).alias("status"),
    )
    rows_of_day = log.filter(F.col("snapshot_date") == F.lit(snapshot)).agg(F.count(F.lit(1)).alias("n")).scalar()
    result = kept.unionByName(fresh.filter(rows_of_day == 0))
    own_success = (F.col("snapshot_date") == F.lit(snapshot)) & (F.col("status") == SUCCESSFUL)
    done = log.filter(own_success).agg(F.count(F.lit(1)).alias("n")).scalar()
    queued = result.filter((F.col("status") == QUEUED) & (done == 0)).select("snapshot_date", "status")
    return result, queued.orderBy("snapshot_date")


def register_children(
    log: DataFrame, registry: DataFrame, parents: DataFrame, parent: str, item: str, as_of: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Queue the active children of all given parents; returns the new log and the queued children.

    ``log`` has (parent, item, created, updated, started, ended, status), ``registry`` has (parent, item,
    is_active); ``parents`` lists the parents to register and may have their ``status``. Failed and
    running rows of active children are queued again, active children without a row get one. A parent
    that is failed or running itself queues all its rows again, whatever their state.
    """
    wanted = parents.select(parent).distinct()
    pairs = registry.filter("is_active").join(wanted, parent).select(parent, item).distinct()
    mark = pairs.withColumn("_active", F.lit(True))
    again = F.coalesce(F.col("_active"), F.lit(False)) & F.col("status").isin(FAILED, RUNNING)
    marked = log.join(mark, [parent, item], "left")
    if "status" in parents.columns:
        broken = parents.filter(F.col("status").isin(FAILED, RUNNING)).select(parent).distinct().withColumn("_cascade", F.lit(True))
        marked = marked.join(broken, parent, "left")
        again = again | F.coalesce(F.col("_cascade"), F.lit(False))
    kept = marked.select(
        parent,
        item,
        "created",
        F.when(again, moment(as_of)).otherwise(F.col("updated")).alias("updated"),
        F.when(again, _no_time()).otherwise(F.col("started")).alias("started"),
        F.when(again, _no_time()).otherwise(F.col("ended")).alias("ended"),
        F.when(again, QUEUED).otherwise(F.col("status")).alias("status"),
    )
    fresh = pairs.join(log.select(parent, item), [parent, item], "left_anti").select(
        parent,
        item,
        moment(as_of).alias("created"),
        moment(as_of).alias("updated"),
        _no_time().alias("started"),
        _no_time().alias("ended"),
        F.lit(QUEUED).alias("status"),
    )
    result = kept.unionByName(fresh)
    queued = result.filter(F.col("status") == QUEUED).join(mark, [parent, item], "left_semi").select(parent, item, "status")
    return result, queued


def apply_status(log: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Apply status events in time order: status, update time, start when running, end when finished.

    Events of one object are combined before the shuffle, so their number does not matter.
    """
    finished = F.col("status").isin(SUCCESSFUL, FAILED)
    latest = events.groupBy(*keys).agg(
        F.max(F.struct("ts", "event_id", "status")).alias("_last"),
        F.max(F.when(F.col("status") == RUNNING, F.col("ts"))).alias("_started"),
        F.max(F.when(finished, F.col("ts"))).alias("_ended"),
    )
    return log.join(latest, keys, "left").select(
        *keys,
        "created",
        F.coalesce(F.col("_last.ts"), F.col("updated")).alias("updated"),
        F.coalesce("_started", "started").alias("started"),
        F.coalesce("_ended", "ended").alias("ended"),
        F.coalesce(F.col("_last.status"), F.col("status")).alias("status"),
    )


def missing_snapshots(files: DataFrame, log: DataFrame, source: str, layout: str) -> DataFrame:
    """Snapshot dates of a source's file names (column ``name``) that have no log row."""
    stem = F.regexp_extract("name", r"^(.*)_[^_]*$", 1)
    found = files.filter(stem == source).select(F.to_date(F.nullif(file_date("name", layout), F.lit("N/A")), "yyyyMMdd").alias("snapshot_date"))
    return found.filter("snapshot_date IS NOT NULL").distinct().join(log.select("snapshot_date"), "snapshot_date", "left_anti")
