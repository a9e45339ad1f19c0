"""Queries over the data-quality operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch
from tidemark.sources.writers import write_files


def _meta(t: Tables) -> DataFrame:
    """Control rows for a customer file, derived from the supplier schema, with blanks and capitals."""
    rows = [
        ("customers.csv ", f.name.replace("s_", "C _", 1), {"bigint": "int"}.get(f.dataType.simpleString(), f.dataType.simpleString()))
        for f in t.supplier.schema.fields
    ]
    rows += [("customers.csv", "c_custkey", "int"), ("orders.csv", "o_orderkey", "bigint")]
    return t.spark.createDataFrame(rows, "file_name string, file_column string, target_type string")


@query(
    "q1_compare_columns",
    """WITH a AS (SELECT column_name AS c FROM information_schema.columns WHERE table_name = 'customer'),
            b AS (SELECT replace(column_name, 's_', 'c_') AS c FROM information_schema.columns WHERE table_name = 'supplier' UNION SELECT 'c_custkey')
       SELECT COALESCE(a.c, b.c) AS column_name, CASE WHEN b.c IS NULL THEN 'extra' WHEN a.c IS NULL THEN 'missing' ELSE 'ok' END AS status
       FROM a FULL JOIN b ON a.c = b.c""",
)
def q1(t: Tables) -> DataFrame:
    return quality.compare_columns(t.customer, _meta(t), "customers.csv")


@query(
    "q1_no_extra",
    """WITH a AS (SELECT column_name AS c FROM information_schema.columns WHERE table_name = 'customer'),
            b AS (SELECT replace(column_name, 's_', 'c_') AS c FROM information_schema.columns WHERE table_name = 'supplier' UNION SELECT 'c_custkey')
       SELECT a.c AS column_name, CASE WHEN b.c IS NULL THEN 'extra' ELSE 'ok' END AS status FROM a LEFT JOIN b ON a.c = b.c""",
)
def q1_extra(t: Tables) -> DataFrame:
    return quality.compare_columns(t.customer, _meta(t), "customers.csv", mode="no_extra")


@query(
    "q2_compare_types",
    """SELECT column_name, 'bigint' AS actual, 'int' AS expected FROM information_schema.columns
       WHERE table_name = 'customer' AND data_type = 'BIGINT'""",
)
def q2(t: Tables) -> DataFrame:
    return quality.compare_types(t.customer, _meta(t), "customers.csv")


def _header_files(t: Tables) -> tuple[str, DataFrame, DataFrame]:
    """Three CSV folders, one of them with a column too many and one without a declared column; their control rows; their headers."""
    out = scratch(t.spark, "headers")
    t.customer.select("c_custkey", "c_name", F.col("c_nationkey").alias("C NationKey")).repartition(3).write.option("header", True).csv(f"{out}/customers.csv")
    t.nation.select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(f"{out}/nations.csv")
    t.orders.select("o_orderkey", F.col("o_totalprice").alias('total, "gross"'), "o_orderdate").write.option("header", True).option("escape", '"').csv(f"{out}/orders.csv")
    rows = [
        ("customers.csv ", "c_custkey", "bigint"), ("customers.csv", "C_Name", "string"), ("customers.csv", "c_nationkey", "int"),
        ("nations.csv", "n_nationkey", "int"), ("nations.csv", "n_name", "int"),
        ("orders.csv", "o_orderkey", "int"), ("orders.csv", 'total,"gross"', "int"), ("orders.csv", "o_orderdate", "timestamp"), ("orders.csv", "o_status", "string"),
    ]
    control = t.spark.createDataFrame(rows, "file_name string, file_column string, target_type string")
    return out, control, quality.header_rows(t.spark, out, F.element_at(F.split("file", "/"), -2))


_HEADER_STATUS = """SELECT * FROM (VALUES ('customers.csv', 'c_custkey', 'ok'), ('customers.csv', 'c_name', 'ok'), ('customers.csv', 'cnationkey', 'extra'),
  ('customers.csv', 'c_nationkey', 'missing'), ('nations.csv', 'n_nationkey', 'ok'), ('nations.csv', 'n_name', 'ok'), ('nations.csv', 'n_regionkey', 'extra'),
  ('orders.csv', 'o_orderkey', 'ok'), ('orders.csv', 'total,"gross"', 'ok'), ('orders.csv', 'o_orderdate', 'ok'), ('orders.csv', 'o_status', 'missing')) v(source, column_name, status)"""


@query("q1_header_rows", f"{_HEADER_STATUS} WHERE (SELECT COUNT(*) FROM customer) > 0")
def q1_headers(t: Tables) -> DataFrame:
    _, control, headers = _header_files(t)
    return quality.compare_headers(headers, control).select("source", "column_name", "status").distinct()


@query("q1_files_to_load", "SELECT 'customers.csv' AS source, false AS loads UNION ALL SELECT 'nations.csv', false UNION ALL SELECT 'orders.csv', true WHERE (SELECT COUNT(*) FROM orders) > 0")
def q1_gate(t: Tables) -> DataFrame:
    _, control, headers = _header_files(t)
    return quality.files_to_load(quality.compare_headers(headers, control, "no_extra")).select("source", "loads").distinct()


@query(
    "q2_types_of_files",
    """SELECT 'nations.csv' AS source, 'n_name' AS column_name, 'string' AS actual, 'int' AS expected UNION ALL
       SELECT 'orders.csv', 'total,"gross"', CASE WHEN bool_and(o_totalprice = floor(o_totalprice)) THEN 'int' ELSE 'double' END, 'int' FROM orders""",
)
def q2_files(t: Tables) -> DataFrame:
    path, control, headers = _header_files(t)
    types = quality.column_types(t.spark, headers, path)
    return quality.compare_file_types(types, control).select("source", "column_name", "actual", "expected").distinct()


def _gaps(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
    )


def _marked(good: DataFrame, bad: DataFrame) -> DataFrame:
    return good.withColumn("verdict", F.lit("good")).unionByName(bad.withColumn("verdict", F.lit("bad")))


@query(
    "q3_split_nulls",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type, CASE WHEN value >= 10 THEN value END AS value,
              CASE WHEN event_type = 'error' OR value < 10 THEN 'bad' ELSE 'good' END AS verdict FROM events""",
)
def q3(t: Tables) -> DataFrame:
    return quality.tag_nulls(_gaps(t))


@query(
    "q4_split_duplicates",
    """SELECT o_custkey, o_orderstatus, o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1
              THEN 'good' ELSE 'bad' END AS verdict FROM orders""",
)
def q4(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey")
    return _marked(*quality.split_duplicates(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"]))


@query(
    "q5_split_bad_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '5-LOW' OR o_orderpriority = '1-URGENT' THEN 'bad' ELSE 'good' END AS verdict
       FROM orders""",
)
def q5(t: Tables) -> DataFrame:
    placed = F.date_format("o_orderdate", "dd-MM-yyyy")
    due = F.date_format(F.date_add("o_orderdate", 9), "yyyy/MM/dd")
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "30-02-2001").otherwise(placed).alias("placed"),
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .when(F.col("o_orderpriority") != "1-URGENT", due)
        .alias("due"),
    )
    return quality.tag_bad_dates(rows, {"placed": "dd-MM-yyyy", "due": "yyyy/MM/dd"}).select("o_orderkey", "verdict")


@query(
    "q6_clean",
    """SELECT DISTINCT user_id, CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS event_type,
              CASE WHEN value < 10 THEN 0 ELSE value END AS value FROM events""",
)
def q6(t: Tables) -> DataFrame:
    rows = t.events.select(
        "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
    )
    return quality.clean(rows)[0]


@query(
    "q7_dedup_files",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS k, o_orderstatus AS v, 'orders' AS source, 2024 AS year, 3 AS month, 9 AS day FROM orders
       UNION ALL SELECT DISTINCT CAST(user_id AS VARCHAR), event_type, 'events', 2024, 3, 9 FROM events""",
)
def q7(t: Tables) -> DataFrame:
    base = scratch(t.spark, "q7")
    write_files(t.orders.selectExpr("o_custkey AS k", "o_orderstatus AS v"), f"{base}/in/orders", "csv")
    write_files(t.events.selectExpr("event_type AS v", "user_id AS k"), f"{base}/in/events", "csv")
    sources = {"orders": f"{base}/in/orders", "events": f"{base}/in/events"}
    quality.dedup_files(t.spark, sources, f"{base}/out", dt.date(2024, 3, 9))
    return t.spark.read.parquet(f"{base}/out").select("k", "v", "source", "year", "month", "day")


_CONTROL = [
    ("visits", "user_id", "bigint", "Y", ""),
    ("visits", "event_type", "string", "Y", ""),
    ("visits", "day", "", "Y", "dd-MM-yyyy"),
    ("prices ", "part", "bigint", "Y", ""),
    ("prices", "size", "int", "", ""),
]


@query(
    "q9_validate_files",
    """WITH v AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
                    CASE WHEN value < 10 THEN '30-02-2001' ELSE strftime(ts, '%d-%m-%Y') END AS day FROM events),
            n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day) AS copy FROM v)
       SELECT 'visits' AS source, CAST(user_id AS VARCHAR) AS id, event_type AS label,
              concat_ws(',', CASE WHEN event_type IS NULL THEN 'missing' END, CASE WHEN day = '30-02-2001' THEN 'date' END, CASE WHEN copy > 1 THEN 'duplicate' END) AS reasons FROM n
       UNION ALL SELECT 'prices', CAST(p_partkey AS VARCHAR), CASE WHEN p_size > 40 THEN 'large' ELSE CAST(p_size AS VARCHAR) END,
              CASE WHEN p_size > 40 THEN 'type' ELSE '' END FROM part""",
)
def q9(t: Tables) -> DataFrame:
    base = scratch(t.spark, "q9")
    day = F.when(F.col("value") < 10, "30-02-2001").otherwise(F.date_format("ts", "dd-MM-yyyy"))
    visits = t.events.select("user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), day.alias("day"))
    size = F.when(F.col("p_size") > 40, "large").otherwise(F.col("p_size").cast("string"))
    write_files(visits, f"{base}/in/visits", "csv")
    write_files(t.part.select(F.col("p_partkey").alias("part"), size.alias("size")), f"{base}/in/prices", "csv")
    control = t.spark.createDataFrame(_CONTROL, "file_name string, column_name string, data_type string, is_key string, date_format string")
    sources = {"visits": f"{base}/in/visits", "prices": f"{base}/in/prices"}
    found = quality.validate_files(t.spark, sources, control, f"{base}/out")
    return found.select("source", F.coalesce("user_id", "part").alias("id"), F.coalesce("event_type", "size").alias("label"), F.array_join("reasons", ",").alias("reasons"))


@query(
    "q8_reconcile_counts",
    """SELECT 'raw' AS step, COUNT(*) AS n_rows FROM lineitem UNION ALL SELECT 'kept', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
       UNION ALL SELECT 'returned', COUNT(*) FROM lineitem WHERE l_returnflag = 'R'""",
)
def q8(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    steps = {
        "raw": rows,
        "kept": rows.select("l_orderkey", "l_linenumber").distinct(),
        "returned": rows.filter("l_returnflag = 'R'"),
    }
    return quality.reconcile_counts(steps)
