"""Versioned tables as an append-only change log.

A log row is a full record plus ``_op`` (I, U or D), ``_version`` and ``_ts``. Reading a version
keeps the last change of each key; Spark reduces that to one row per key and task before the
shuffle, so a key with very many changes does no harm.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import moment
from tidemark.functions.values import quoted
from tidemark.operators.windows import first_per_key

META = ["_op", "_version", "_ts"]


def _data_columns(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in META]


def _stamp(rows: DataFrame, op: str | Column, version: int | Column, ts: dt.datetime | Column) -> DataFrame:
    op = F.lit(op) if isinstance(op, str) else op
    version = F.lit(version) if isinstance(version, int) else version
    ts = ts if isinstance(ts, Column) else moment(ts)
    return rows.select("*", op.alias("_op"), version.cast("bigint").alias("_version"), ts.alias("_ts"))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the condition is true; NULL counts as false."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[
            F.when(hit, values[f.name]).otherwise(quoted(f.name)).cast(f.dataType).alias(f.name)
            if f.name in values
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def delete_where(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Drop rows where the condition is true; rows where it is NULL stay. No condition empties the table."""
    return df.filter(F.lit(False)) if condition is None else df.filter(~F.coalesce(condition, F.lit(False)))


def convert(df: DataFrame, ts: dt.datetime) -> DataFrame:
    """Existing rows as version 0."""
    return _stamp(df, "I", 0, ts)


def insert(log: DataFrame, rows: DataFrame, version: int, ts: dt.datetime) -> DataFrame:
    return log.unionByName(_stamp(rows, "I", version, ts))


def as_of(
    log: DataFrame,
    keys: list[str],
    version: int | None = None,
    ts: dt.datetime | None = None,
    oldest: dt.datetime | None = None,
) -> DataFrame:
    """The table at a version, or at the last version at or before a time; the latest by default.

    A time before the first version is an error, and so is a time before ``oldest`` (the horizon of
    the last vacuum).
    """
    seen = log
    if ts is not None:
        if oldest is not None and ts < oldest:
            raise ValueError(f"versions before {oldest} were vacuumed")
        first = log.agg(F.min("_ts")).first()[0]
        if first is None or ts < first:
            raise ValueError(f"no version at or before {ts}")
        seen = log.filter(F.col("_ts") <= moment(ts))
    if version is not None:
        if log.filter(F.col("_version") <= version).isEmpty():
            raise ValueError(f"no version {version}")
        seen = seen.filter(F.col("_version") <= version)
    latest = first_per_key(seen, keys, [F.col("_version").desc()])
    return latest.filter("_op <> 'D'").select(*_data_columns(log))


def log_update(
    log: DataFrame, keys: list[str], condition: Column, values: dict[str, Column], version: int, ts: dt.datetime
) -> DataFrame:
    """The log with an update as its next version; only touched rows are added."""
    touched = as_of(log, keys).filter(F.coalesce(condition, F.lit(False)))
    return log.unionByName(_stamp(update_where(touched, F.lit(True), values), "U", version, ts))


def log_delete(log: DataFrame, keys: list[str], condition: Column, version: int, ts: dt.datetime) -> DataFrame:
    touched = as_of(log, keys).filter(F.coalesce(condition, F.lit(False)))
    return log.unionByName(_stamp(touched, "D", version, ts))


def history(log: DataFrame) -> DataFrame:
    """One row per version and operation, with its row count."""
    return log.groupBy("_version", "_ts", "_op").agg(F.count(F.lit(1)).alias("n_rows"))


def restore(log: DataFrame, keys: list[str], to_version: int, version: int, ts: dt.datetime) -> DataFrame:
    """The log with one more version that brings the table back to ``to_version``.

    The state now and the state then come from one grouping of the log; only keys that differ are added.
    """
    data = [c for c in _data_columns(log) if c not in keys]
    row = F.struct("_version", "_op", F.struct(*[quoted(c) for c in data]).alias("data"))
    states = log.groupBy(*keys).agg(
        F.max(row).alias("now"), F.max(F.when(F.col("_version") <= to_version, row)).alias("then")
    )
    alive_now = F.col("now._op") != "D"
    alive_then = F.coalesce(F.col("then._op") != "D", F.lit(False))
    op = (
        F.when(alive_then & ~alive_now, "I")
        .when(~alive_then & alive_now, "D")
        .when(alive_then & alive_now & ~F.col("now.data").eqNullSafe(F.col("then.data")), "U")
    )
    source = F.when(alive_then, F.col("then.data")).otherwise(F.col("now.data"))
    back = states.select(*keys, op.alias("_o"), source.alias("_d")).filter("_o IS NOT NULL")
    rows = back.select(*keys, F.col("_o"), "_d.*")
    stamped = _stamp(rows, F.col("_o"), version, ts).drop("_o")
    return log.unionByName(stamped)


def vacuum(
    log: DataFrame, keys: list[str], now: dt.datetime, days: int = 7, dry_run: bool = False
) -> DataFrame:
    """Drop rows superseded before the retention horizon; ``dry_run`` lists them instead.

    A row goes when a later change of its key is itself at or before the horizon. So the rows after
    the horizon stay, and of the older ones only the last of each key.
    """
    horizon = moment(now - dt.timedelta(days=days))
    recent, old = log.filter(F.col("_ts") > horizon), log.filter(F.col("_ts") <= horizon)
    last_old = first_per_key(old, keys, [F.col("_version").desc()])
    if not dry_run:
        return recent.unionByName(last_old)
    same = [quoted(k).eqNullSafe(quoted(f"_k_{k}")) for k in keys]
    lasts = last_old.select(*[quoted(k).alias(f"_k_{k}") for k in keys], F.col("_version").alias("_last"))
    return old.join(lasts, [*same, F.col("_version") < F.col("_last")], "left_semi")


def rewrite(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], out: str, fmt: str = "parquet") -> DataFrame:
    """Plain files cannot be updated: write the changed rows to a new path and return a reader of it."""
    if out.rstrip("/") == path.rstrip("/"):
        raise ValueError("the new path must differ from the one that is read")
    change(spark.read.format(fmt).load(path)).write.format(fmt).save(out)
    return spark.read.format(fmt).load(out)
