"""Queries over load logs, derived from the events of each day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import recode
from tidemark.operators import dimensions as dims
from tidemark.operators import loadlog
from tidemark.plans import warehouse
from tidemark.plans.registry import Tables, query

AS_OF = dt.datetime(2024, 6, 1, 12, 0)
_STATES = {"click": "Running", "error": "Failed", "purchase": "Successful", "signup": "Queued", "view": "Successful"}
_STATE_SQL = "CASE {c} WHEN 'click' THEN 'Running' WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Queued' ELSE 'Successful' END"


@query(
    "d18_audit_row",
    f"""WITH {warehouse._KNOWN}, {warehouse._STAGED},
          m AS (SELECT k.c_custkey IS NULL AS fresh, k.c_custkey IS NOT NULL AND (s.c_mktsegment IS DISTINCT FROM k.c_mktsegment) AS changed
                FROM stg s LEFT JOIN known k ON k.c_custkey = s.c_custkey),
          c AS (SELECT COUNT(*) FILTER (fresh) AS i, COUNT(*) FILTER (changed) AS u FROM m)
        SELECT 'customer' AS table_name, i AS inserted_count, u AS updated_count, CASE WHEN i > 0 THEN TIMESTAMP '2024-06-01 12:00:00' END AS inserted_at,
               CASE WHEN u > 0 THEN TIMESTAMP '2024-06-01 12:00:00' END AS updated_at FROM c""",
)
def d18(t: Tables) -> DataFrame:
    tagged = dims.scd2_tagged(warehouse._versions(t, None), warehouse._staged(t), ["c_custkey"], ["c_mktsegment"], AS_OF)
    return loadlog.audit_row(tagged, "customer", AS_OF)


@query(
    "d18_audit_row_second_run",
    """SELECT 'customer' AS table_name, CAST(0 AS BIGINT) AS inserted_count, CAST(0 AS BIGINT) AS updated_count,
              CAST(NULL AS TIMESTAMP) AS inserted_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM (SELECT COUNT(*) FROM customer)""",
)
def d18_again(t: Tables) -> DataFrame:
    first = dims.scd2(warehouse._versions(t, None), warehouse._staged(t), ["c_custkey"], ["c_mktsegment"], AS_OF)
    tagged = dims.scd2_tagged(first, warehouse._staged(t), ["c_custkey"], ["c_mktsegment"], AS_OF + dt.timedelta(days=1))
    return loadlog.audit_row(tagged, "customer", AS_OF)


@query(
    "d19_load_log",
    """SELECT 'orders' AS source_table, 'lake/orders' AS destination, TIMESTAMP '2024-06-01 12:00:00' AS trigger_time, COUNT(*) AS rows_read,
              COUNT(*) AS rows_copied, 10 AS copy_seconds, MAX(o_orderdate) AS watermark, 'Successful' AS status FROM orders
       UNION ALL SELECT 'events', 'lake/events', TIMESTAMP '2024-06-01 12:01:00', COUNT(*), COUNT(*), 60, MAX(ts), 'Successful' FROM events""",
)
def d19(t: Tables) -> DataFrame:
    first = loadlog.load_run(t.orders, "orders", "lake/orders", F.max("o_orderdate"), AS_OF, AS_OF + dt.timedelta(seconds=10))
    later = AS_OF + dt.timedelta(minutes=1)
    second = loadlog.load_run(t.events, "events", "lake/events", F.max("ts"), later, later + dt.timedelta(minutes=1))
    return loadlog.append_load_log(first, second)


def _daily(t: Tables) -> DataFrame:
    """A log row per day; days that end with certain events failed or still run."""
    days = t.events.groupBy(F.to_date("ts").alias("snapshot_date")).agg(
        F.min("ts").alias("created"), F.max("ts").alias("updated"), F.max_by("event_type", "event_id").alias("kind")
    )
    return days.select(
        "snapshot_date",
        "created",
        "updated",
        F.col("created").alias("started"),
        F.col("updated").alias("ended"),
        recode("kind", _STATES).alias("status"),
    )


_DAILY = f"""daily AS (SELECT CAST(ts AS DATE) AS snapshot_date, MIN(ts) AS created, MAX(ts) AS updated, MIN(ts) AS started, MAX(ts) AS ended,
  {_STATE_SQL.format(c="max_by(event_type, event_id)")} AS status FROM events GROUP BY 1)"""
_NOW = "TIMESTAMP '2024-06-01 12:00:00'"


def _register_sql(rows: str, day: str) -> str:
    return f"""WITH {_DAILY}, log AS ({rows}), f AS (SELECT MIN(snapshot_date) AS d FROM log WHERE status = 'Failed'),
      marked AS (SELECT log.*, COALESCE(snapshot_date >= d, FALSE) AS again,
                        NOT COALESCE(snapshot_date >= d, FALSE) AND snapshot_date = DATE '{day}' AND status IN ('Failed', 'Running') AS own FROM log, f)
      SELECT snapshot_date, created, CASE WHEN again OR own THEN {_NOW} ELSE updated END AS updated, CASE WHEN NOT own THEN started END AS started,
             CASE WHEN NOT own THEN ended END AS ended, CASE WHEN again OR own THEN 'Queued' ELSE status END AS status FROM marked
      UNION ALL SELECT DATE '{day}', {_NOW}, {_NOW}, NULL, NULL, 'Queued' WHERE DATE '{day}' NOT IN (SELECT snapshot_date FROM log)"""


@query("d20_register_snapshot", _register_sql("SELECT * FROM daily", "2024-02-01"))
def d20(t: Tables) -> DataFrame:
    return loadlog.register_snapshot(_daily(t), dt.date(2024, 2, 1), AS_OF)[0]


@query("d20_register_known_day", _register_sql("SELECT * REPLACE (CASE status WHEN 'Failed' THEN 'Running' ELSE status END AS status) FROM daily", "2024-01-15"))
def d20_known(t: Tables) -> DataFrame:
    calm = _daily(t).withColumn("status", recode("status", {"Failed": "Running"}))
    return loadlog.register_snapshot(calm, dt.date(2024, 1, 15), AS_OF)[0]


@query(
    "d20_queued_snapshots",
    f"WITH r AS ({_register_sql('SELECT * FROM daily', '2024-02-01')}) SELECT snapshot_date, status FROM r WHERE status = 'Queued' ORDER BY 1",
)
def d20_queued(t: Tables) -> DataFrame:
    return loadlog.register_snapshot(_daily(t), dt.date(2024, 2, 1), AS_OF)[1]


def _children(t: Tables) -> DataFrame:
    """A log row per user and event type whose largest value is above 40."""
    seen = t.events.groupBy("user_id", F.col("event_type").alias("item")).agg(
        F.min("ts").alias("created"), F.max("ts").alias("updated"), F.max("value").alias("top")
    )
    state = F.when(F.col("top") > 90, "Failed").when(F.col("top") > 70, "Running").otherwise("Successful")
    return seen.filter("top > 40").select(
        "user_id", "item", "created", "updated", F.col("created").alias("started"), F.col("updated").alias("ended"), state.alias("status")
    )


def _children_sql(cascade: str = "FALSE") -> str:
    return f"""log AS (SELECT user_id, event_type AS item, MIN(ts) AS created, MAX(ts) AS updated, MIN(ts) AS started, MAX(ts) AS ended,
    CASE WHEN MAX(value) > 90 THEN 'Failed' WHEN MAX(value) > 70 THEN 'Running' ELSE 'Successful' END AS status
  FROM events GROUP BY 1, 2 HAVING MAX(value) > 40),
  parents AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 HAVING MAX(value) > 80),
  pairs AS (SELECT DISTINCT user_id, event_type AS item FROM events WHERE event_type <> 'signup' AND user_id IN (SELECT user_id FROM parents)),
  result AS (
    SELECT log.user_id, log.item, created, CASE WHEN again THEN TIMESTAMP '2024-06-01 12:00:00' ELSE updated END AS updated,
           CASE WHEN NOT again THEN started END AS started, CASE WHEN NOT again THEN ended END AS ended, CASE WHEN again THEN 'Queued' ELSE status END AS status
    FROM (SELECT log.*, pairs.item IS NOT NULL AND status IN ('Failed', 'Running') OR COALESCE({cascade}, FALSE) AS again
          FROM log LEFT JOIN pairs ON pairs.user_id = log.user_id AND pairs.item = log.item LEFT JOIN parents ON parents.user_id = log.user_id) log
    UNION ALL SELECT p.user_id, p.item, TIMESTAMP '2024-06-01 12:00:00', TIMESTAMP '2024-06-01 12:00:00', NULL, NULL, 'Queued'
    FROM pairs p LEFT JOIN log ON log.user_id = p.user_id AND log.item = p.item WHERE log.item IS NULL)"""


def _registered(t: Tables, states: bool = False) -> tuple[DataFrame, DataFrame]:
    """Children of the users with a value above 80; a user with three events or fewer counts as failed."""
    registry = t.events.select("user_id", F.col("event_type").alias("item"), (F.col("event_type") != "signup").alias("is_active")).distinct()
    parents = t.events.groupBy("user_id").agg(F.max("value").alias("top"), F.count(F.lit(1)).alias("n")).filter("top > 80")
    state = F.when(F.col("n") <= 3, "Failed").otherwise("Successful").alias("status")
    parents = parents.select("user_id", *([state] if states else []))
    return loadlog.register_children(_children(t), registry, parents, "user_id", "item", AS_OF)


@query("d21_register_children", f"WITH {_children_sql()} SELECT * FROM result")
def d21(t: Tables) -> DataFrame:
    return _registered(t)[0]


@query("d21_queued_children", f"WITH {_children_sql()} SELECT user_id, item, status FROM result JOIN pairs USING (user_id, item) WHERE status = 'Queued'")
def d21_queued(t: Tables) -> DataFrame:
    return _registered(t)[1]


@query("d21_cascade", f"WITH {_children_sql('n <= 3')} SELECT * FROM result")
def d21_cascade(t: Tables) -> DataFrame:
    return _registered(t, states=True)[0]


@query(
    "d22_apply_status",
    f"""WITH log AS (SELECT DISTINCT o_custkey AS user_id FROM orders),
            ev AS (SELECT user_id, event_id, ts, {_STATE_SQL.format(c='event_type')} AS status FROM events)
       SELECT log.user_id, TIMESTAMP '2024-01-01' AS created, COALESCE(MAX(ts), TIMESTAMP '2024-01-01') AS updated, MAX(ts) FILTER (ev.status = 'Running') AS started,
              MAX(ts) FILTER (ev.status IN ('Successful', 'Failed')) AS ended, COALESCE(arg_max(ev.status, ts), 'Queued') AS status
       FROM log LEFT JOIN ev ON ev.user_id = log.user_id GROUP BY 1""",
)
def d22(t: Tables) -> DataFrame:
    first = dims.moment(dt.date(2024, 1, 1))
    none = F.lit(None).cast("timestamp_ntz")
    log = t.orders.select(F.col("o_custkey").alias("user_id")).distinct().select(
        "user_id", first.alias("created"), first.alias("updated"), none.alias("started"), none.alias("ended"), F.lit("Queued").alias("status")
    )
    events = t.events.select("user_id", "event_id", "ts", recode("event_type", _STATES).alias("status"))
    return loadlog.apply_status(log, events, ["user_id"])


@query(
    "d23_missing_snapshots",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) - 1 AS snapshot_date FROM orders
       WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) - 1 NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 300000)""",
)
def d23(t: Tables) -> DataFrame:
    source = F.when(F.col("o_orderstatus") == "P", "other").otherwise("daily_sales")
    files = t.orders.select(F.concat_ws("_", source, F.concat(F.date_format("o_orderdate", "ddMMyyyy"), F.lit(".csv"))).alias("name"))
    log = t.orders.filter("o_totalprice > 300000").select(F.to_date("o_orderdate").alias("snapshot_date"))
    return loadlog.missing_snapshots(files, log, "daily_sales", "ddMMyyyy")
