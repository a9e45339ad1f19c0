"""Queries over versioned tables, derived from the events.

The change log has one row per user and day with events: the user's last event of the day, where an
error deletes the user, the first day inserts and later days update.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import layout, versioned
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch
from tidemark.sources.readers import with_source_file
from tidemark.sources.writers import write_files

TS = dt.datetime(2024, 6, 1, 12, 0)


def _log(t: Tables) -> DataFrame:
    day = F.dayofmonth("ts")
    last = t.events.groupBy("user_id", day.alias("_day")).agg(
        F.max(F.struct("event_id", "event_type", "value", "ts")).alias("e")
    )
    op = F.when(F.col("e.event_type") == "error", "D").otherwise("U")
    return last.select(
        "user_id",
        "e.event_type",
        "e.value",
        op.alias("_op"),
        F.col("_day").cast("bigint").alias("_version"),
        F.expr("timestamp_ntz'2024-01-01 23:59:59' + make_dt_interval(_day - 1)").alias("_ts"),
    )


_LOG = """log AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
    CASE WHEN arg_max(event_type, event_id) = 'error' THEN 'D' ELSE 'U' END AS _op, day(ts) AS _version,
    TIMESTAMP '2024-01-01 23:59:59' + to_days(CAST(day(ts) - 1 AS INTEGER)) AS _ts FROM events GROUP BY user_id, day(ts))"""


def _at(version: str) -> str:
    return f"""(SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) AS rn
                FROM log WHERE _version <= {version}) WHERE rn = 1 AND _op <> 'D')"""


@query(
    "v1_update_where",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS event_type,
              CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value FROM events""",
)
def v1(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"), "value")
    return versioned.update_where(rows, F.col("event_type") == "click", {"value": F.col("value") * 2})


@query(
    "v1_update_as_version",
    f"""WITH {_LOG}, up AS (SELECT user_id, 'big' AS event_type, value + 1 AS value, 'U' AS _op, CAST(99 AS BIGINT) AS _version,
          TIMESTAMP '2024-06-01 12:00:00' AS _ts FROM {_at('31')} WHERE value > 20)
        SELECT * FROM log UNION ALL SELECT * FROM up""",
)
def v1_log(t: Tables) -> DataFrame:
    values = {"event_type": F.lit("big"), "value": F.col("value") + 1}
    return versioned.log_update(_log(t), ["user_id"], F.col("value") > 20, values, 99, TS)


@query("v2_delete_where", "SELECT event_id, event_type FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type FROM events) WHERE event_type IS DISTINCT FROM 'click'")
def v2(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"))
    return versioned.delete_where(rows, F.col("event_type") == "click")


@query(
    "v2_delete_as_version",
    f"""WITH {_LOG} SELECT * FROM log UNION ALL
        SELECT user_id, event_type, value, 'D', 99, TIMESTAMP '2024-06-01 12:00:00' FROM {_at('31')} WHERE event_type = 'view'""",
)
def v2_log(t: Tables) -> DataFrame:
    return versioned.log_delete(_log(t), ["user_id"], F.col("event_type") == "view", 99, TS)


@query("v2_truncate", "SELECT 'before' AS state, COUNT(*) AS n FROM events")
def v2_truncate(t: Tables) -> DataFrame:
    before, after = t.events.withColumn("state", F.lit("before")), versioned.delete_where(t.events).withColumn("state", F.lit("after"))
    return before.unionByName(after).groupBy("state").agg(F.count("*").alias("n"))


@query(
    "v3_insert_version",
    f"""WITH {_LOG} SELECT * FROM log UNION ALL
        SELECT c_custkey + 1000000, c_mktsegment, c_acctbal, 'I', 50, TIMESTAMP '2024-06-01 12:00:00' FROM customer""",
)
def v3(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("c_custkey + 1000000 AS user_id", "c_mktsegment AS event_type", "c_acctbal AS value")
    return versioned.insert(_log(t), rows, 50, TS)


@query("v4_as_of_version", f"WITH {_LOG} SELECT * FROM {_at('12')}")
def v4(t: Tables) -> DataFrame:
    return versioned.as_of(_log(t), ["user_id"], version=12)


@query("v4_as_of_time", f"WITH {_LOG} SELECT * FROM {_at('19')}")
def v4_time(t: Tables) -> DataFrame:
    return versioned.as_of(_log(t), ["user_id"], ts=dt.datetime(2024, 1, 20, 8, 0))


@query("v5_history", f"WITH {_LOG} SELECT _version, _ts, _op, COUNT(*) AS n_rows FROM log GROUP BY 1, 2, 3")
def v5(t: Tables) -> DataFrame:
    return versioned.history(_log(t))


@query(
    "v6_restore",
    f"""WITH {_LOG}, now AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) AS rn FROM log) WHERE rn = 1),
          old AS {_at('10')},
          diff AS (SELECT COALESCE(old.user_id, now.user_id) AS user_id, CASE WHEN old.user_id IS NULL THEN now.event_type ELSE old.event_type END AS event_type,
                          CASE WHEN old.user_id IS NULL THEN now.value ELSE old.value END AS value,
                          CASE WHEN old.user_id IS NOT NULL AND now._op = 'D' THEN 'I' WHEN old.user_id IS NULL AND now._op <> 'D' THEN 'D'
                               WHEN old.user_id IS NOT NULL AND (now.event_type, now.value) IS DISTINCT FROM (old.event_type, old.value) THEN 'U' END AS _op
                   FROM now LEFT JOIN old ON old.user_id = now.user_id)
        SELECT * FROM log UNION ALL SELECT *, 60, TIMESTAMP '2024-06-01 12:00:00' FROM diff WHERE _op IS NOT NULL""",
)
def v6(t: Tables) -> DataFrame:
    return versioned.restore(_log(t), ["user_id"], 10, 60, TS)


@query("v6_read_restored", f"WITH {_LOG} SELECT * FROM {_at('10')}")
def v6_read(t: Tables) -> DataFrame:
    return versioned.as_of(versioned.restore(_log(t), ["user_id"], 10, 60, TS), ["user_id"])


_LEAD = f"""WITH {_LOG}, n AS (SELECT *, lead(_ts) OVER (PARTITION BY user_id ORDER BY _version) AS next_ts FROM log)
  SELECT user_id, event_type, value, _op, _version, _ts FROM n WHERE """


@query("v7_vacuum", _LEAD + "next_ts IS NULL OR next_ts > TIMESTAMP '2024-01-20 12:00:00'")
def v7(t: Tables) -> DataFrame:
    return versioned.vacuum(_log(t), ["user_id"], dt.datetime(2024, 1, 27, 12, 0))


@query("v7_vacuum_dry_run", _LEAD + "next_ts <= TIMESTAMP '2024-01-20 12:00:00'")
def v7_dry(t: Tables) -> DataFrame:
    return versioned.vacuum(_log(t), ["user_id"], dt.datetime(2024, 1, 27, 12, 0), dry_run=True)


@query("v8_compact", "SELECT CAST(1 AS BIGINT) AS n_files, COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_orders FROM lineitem")
def v8(t: Tables) -> DataFrame:
    base = scratch(t.spark, "v8")
    write_files(t.lineitem, f"{base}/small", files=24)
    layout.compact(t.spark, f"{base}/small", f"{base}/large", target_mb=512)
    read = with_source_file(t.spark.read.parquet(f"{base}/large"))
    return read.agg(
        F.count_distinct("source_file").alias("n_files"), F.count("*").alias("n_rows"), F.count_distinct("l_orderkey").alias("n_orders")
    )


@query("v9_zorder", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem")
def v9(t: Tables) -> DataFrame:
    out = scratch(t.spark, "v9")
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.col("_metadata.row_index").alias("row_no"))
    placed = layout.zorder(rows, ["l_orderkey", "l_partkey"], files=8, spread=F.col("row_no"))
    placed.drop("row_no").write.parquet(out)
    return t.spark.read.parquet(out)


@query(
    "v9_zorder_narrows_files",
    "SELECT TRUE AS both_keys_narrower, CAST(16 AS BIGINT) AS n_files FROM (SELECT COUNT(*) FROM lineitem)",
)
def v9_depth(t: Tables) -> DataFrame:
    out = scratch(t.spark, "v9d")
    rows = t.lineitem.select("l_orderkey", "l_partkey")
    layout.zorder(rows, ["l_orderkey", "l_partkey"], files=16).write.parquet(out)
    read = t.spark.read.parquet(out).select("*", F.col("_metadata.file_name").alias("file"))
    spans = read.groupBy("file").agg(
        (F.max("l_orderkey") - F.min("l_orderkey")).alias("a"), (F.max("l_partkey") - F.min("l_partkey")).alias("b")
    )
    whole = rows.agg((F.max("l_orderkey") - F.min("l_orderkey")).alias("wa"), (F.max("l_partkey") - F.min("l_partkey")).alias("wb"))
    narrower = (F.avg("a") < 0.5 * F.first("wa")) & (F.avg("b") < 0.5 * F.first("wb"))
    sized = spans.select("a", "b", whole.select("wa").scalar().alias("wa"), whole.select("wb").scalar().alias("wb"))
    return sized.agg(narrower.alias("both_keys_narrower"), F.count("*").alias("n_files"))


@query(
    "v10_convert",
    "SELECT *, 'I' AS _op, CAST(0 AS BIGINT) AS _version, TIMESTAMP '2024-06-01 12:00:00' AS _ts FROM supplier",
)
def v10(t: Tables) -> DataFrame:
    return versioned.convert(t.supplier, TS)


@query("v11_rewrite", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer")
def v11(t: Tables) -> DataFrame:
    base = scratch(t.spark, "v11")
    t.customer.select("c_custkey", "c_acctbal").write.parquet(f"{base}/old")
    zero = {"c_acctbal": F.lit(0.0)}
    return versioned.rewrite(
        t.spark, f"{base}/old", lambda df: versioned.update_where(df, F.col("c_acctbal") < 0, zero), f"{base}/new"
    )


