"""Queries over aggregates, marts and windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import exact
from tidemark.operators import aggregates, windows
from tidemark.plans.marts import claim_mart, revenue_mart
from tidemark.plans.registry import Tables, query

_MART_SQL = """
WITH header AS (
  SELECT o_orderkey AS trans_id, strftime(o_orderdate, '%Y-%m') AS period, o_custkey AS customer_id, o_orderstatus AS type_code,
         substr(o_orderpriority, 1, 1) AS activity_code, o_orderpriority AS fund_code, o_orderdate AS process_date,
         o_orderdate + INTERVAL 45 DAY AS fiscal_date FROM orders),
revenue AS (
  SELECT o_orderkey AS trans_id, o_orderstatus AS data_type,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'F' || substr(o_orderpriority, 1, 1) END AS revenue_fund_code FROM orders),
amounts AS (
  SELECT l_orderkey AS trans_id, l_partkey AS tag_set_id, l_returnflag AS offset_code, l_linestatus AS status_code,
         l_shipdate AS incur_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem WHERE l_extendedprice <> 0),
source AS (
  SELECT o_orderkey AS trans_id, o_orderpriority AS source_type, substr(o_orderpriority, 3, 2) AS suffix FROM orders
  WHERE o_orderpriority = '1-URGENT')
SELECT period, customer_id, type_code, activity_code, COALESCE(revenue_fund_code, fund_code) AS fund_code,
       strftime(process_date, '%Y%m') AS process_month, strftime(fiscal_date, '%Y%m') AS fiscal_month, data_type, source_type, suffix,
       offset_code, status_code, strftime(incur_date, '%Y%m') AS incur_month, p_brand AS unit, p_type AS account,
       substr(p_name, 1, 5) AS location, p_size AS product, c_name AS customer_name, CAST(SUM(amount) AS DOUBLE) AS amount
FROM header JOIN revenue USING (trans_id) JOIN amounts USING (trans_id) JOIN part ON p_partkey = tag_set_id
LEFT JOIN source USING (trans_id) LEFT JOIN customer ON c_custkey = customer_id
WHERE CAST(substr(period, 1, 4) AS INTEGER) >= 1997
GROUP BY ALL"""


def _mart(t: Tables, pre_aggregate: bool) -> DataFrame:
    header = t.orders.select(
        F.col("o_orderkey").alias("trans_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("type_code"),
        F.substring("o_orderpriority", 1, 1).alias("activity_code"),
        F.col("o_orderpriority").alias("fund_code"),
        F.col("o_orderdate").alias("process_date"),
        F.expr("o_orderdate + INTERVAL 45 DAYS").alias("fiscal_date"),
    )
    priority = F.col("o_orderpriority")
    fund = F.when(priority != "5-LOW", F.concat(F.lit("F"), F.substring(priority, 1, 1)))
    revenue = t.orders.select(
        F.col("o_orderkey").alias("trans_id"), F.col("o_orderstatus").alias("data_type"), fund.alias("revenue_fund_code")
    )
    amounts = t.lineitem.select(
        F.col("l_orderkey").alias("trans_id"),
        F.col("l_partkey").alias("tag_set_id"),
        F.col("l_returnflag").alias("offset_code"),
        F.col("l_linestatus").alias("status_code"),
        F.col("l_shipdate").alias("incur_date"),
        exact("l_extendedprice").alias("amount"),
    )
    tags = t.part.selectExpr(
        "p_partkey AS tag_set_id", "p_brand AS unit", "p_type AS account", "p_name AS location", "p_size AS product"
    )
    source = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("trans_id"), priority.alias("source_type"), F.substring(priority, 3, 2).alias("suffix")
    )
    customer = t.customer.selectExpr("c_custkey AS customer_id", "c_name AS customer_name")
    mart = revenue_mart(
        header, revenue, amounts, tags, source, customer, 1997, on=("trans_id",), pre_aggregate=pre_aggregate
    )
    return mart.withColumn("amount", F.col("amount").cast("double"))


@query("a1_revenue_mart", _MART_SQL)
def a1(t: Tables) -> DataFrame:
    return _mart(t, pre_aggregate=False)


@query("a4_revenue_mart_pre_aggregated", _MART_SQL)
def a4(t: Tables) -> DataFrame:
    return _mart(t, pre_aggregate=True)


_FLAGS = {"A": "returned", "N": "normal", "R": "refused"}


@query(
    "a2_sum_by_code",
    """SELECT l_orderkey,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS returned,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS normal,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS refused
       FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1""",
)
def a2(t: Tables) -> DataFrame:
    sums = aggregates.sum_by_code(t.lineitem, ["l_orderkey"], "l_returnflag", exact("l_extendedprice"), _FLAGS)
    return sums.select("l_orderkey", *[F.col(n).cast("double").alias(n) for n in _FLAGS.values()])


@query(
    "a3_claim_mart",
    """WITH header AS (
         SELECT o_orderkey AS claim_id, o_orderstatus AS claim_type, o_custkey AS contract, o_orderdate AS paid_date FROM orders
         WHERE o_orderdate >= TIMESTAMP '1999-07-01' AND (o_orderstatus = 'F' OR o_orderstatus LIKE 'O%')),
       line AS (
         SELECT l_orderkey AS claim_id, l_linenumber AS line_no, p_type AS service_code,
                CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS INTEGER) END AS units_a,
                CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS INTEGER) + 1 END AS units_b
         FROM lineitem JOIN part ON l_partkey = p_partkey WHERE 'F' IN (l_linestatus, l_returnflag) AND p_size > 10),
       amounts AS (
         SELECT l_orderkey AS claim_id, l_linenumber AS line_no,
           SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS returned,
           SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS normal,
           SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS refused
         FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1, 2)
       SELECT claim_id, line_no, claim_type, contract, paid_date, service_code,
              CASE WHEN contract IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'listed' ELSE 'other' END AS contract_group,
              CAST(SUM(returned) AS DOUBLE) AS returned, CAST(SUM(normal) AS DOUBLE) AS normal, CAST(SUM(refused) AS DOUBLE) AS refused,
              CAST(SUM(COALESCE(units_a, units_b, 0)) AS BIGINT) AS units
       FROM header JOIN line USING (claim_id) JOIN amounts USING (claim_id, line_no) WHERE returned + normal >= 500
       GROUP BY 1, 2, 3, 4, 5, 6, 7""",
)
def a3(t: Tables) -> DataFrame:
    header = t.orders.selectExpr(
        "o_orderkey AS claim_id", "o_orderstatus AS claim_type", "o_custkey AS contract", "o_orderdate AS paid_date"
    )
    quantity = F.col("l_quantity").cast("int")
    line = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("claim_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("p_type").alias("service_code"),
        F.when(F.col("l_quantity") > 25, quantity).alias("units_a"),
        F.when(F.col("l_quantity") > 10, quantity + 1).alias("units_b"),
        "p_size",
        F.col("l_linestatus").alias("mod_1"),
        F.col("l_returnflag").alias("mod_2"),
    )
    amounts = t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_returnflag").alias("code"),
        exact("l_extendedprice").alias("amount"),
    )
    mart = claim_mart(
        header,
        line,
        amounts,
        codes=t.customer.filter("c_acctbal < 0").select("c_custkey"),
        names=_FLAGS,
        as_of=dt.date(2001, 6, 30),
        days=730,
        at_least=F.col("returned") + F.col("normal") >= 500,
        header_ok=(F.col("claim_type") == "F") | F.col("claim_type").like("O%"),
        line_ok=F.col("p_size") > 10,
        modifier="F",
        modifiers=["mod_1", "mod_2"],
    )
    return mart.withColumns({n: F.col(n).cast("double") for n in _FLAGS.values()})


@query(
    "a5_count_by_file",
    """SELECT 'orders.parquet' AS source_file, COUNT(*) AS n FROM orders UNION ALL SELECT 'events.parquet', COUNT(*) FROM events""",
)
def a5(t: Tables) -> DataFrame:
    return aggregates.count_by_file(t.orders).unionByName(aggregates.count_by_file(t.events))


@query(
    "a6_count_by_year",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2",
)
def a6(t: Tables) -> DataFrame:
    return aggregates.count_by_year(t.orders, "o_orderdate", "o_orderstatus")


@query("a7_distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def a7(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber").distinct()


_PICK = """SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_orderkey, l_partkey,
  l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE {rule}"""
_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query("a7_distinct_on", _PICK.format(columns=_LINE, rule="rn = 1"))
def a7_on(t: Tables) -> DataFrame:
    return windows.distinct_on(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("a8_duplicate_groups", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def a8(t: Tables) -> DataFrame:
    return aggregates.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "a9_null_counts",
    """SELECT 'event_type' AS column_name, COUNT(*) FILTER (event_type = 'error') AS missing, COUNT(*) AS total FROM events
       UNION ALL SELECT 'value', COUNT(*) FILTER (value < 10), COUNT(*) FROM events
       UNION ALL SELECT 'event_id', 0, COUNT(*) FROM events""",
)
def a9(t: Tables) -> DataFrame:
    gaps = t.events.select(
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") < 10, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "event_id",
    )
    return aggregates.null_counts(gaps)


@query("a10_max_value", "SELECT MAX(o_orderdate) AS watermark FROM orders")
def a10(t: Tables) -> DataFrame:
    return aggregates.max_value(t.orders, "o_orderdate")


@query(
    "a11_collapse_max",
    "SELECT o_custkey, MAX(o_orderkey) AS o_orderkey, MAX(o_totalprice) AS o_totalprice, MAX(o_orderdate) AS o_orderdate, MAX(o_orderstatus) AS o_orderstatus, MAX(o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1",
)
def a11(t: Tables) -> DataFrame:
    return aggregates.collapse_max(t.orders, ["o_custkey"])


@query(
    "a12_string_agg_distinct",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS items FROM orders GROUP BY 1",
)
def a12(t: Tables) -> DataFrame:
    return aggregates.string_agg(t.orders, ["o_custkey"], "o_orderpriority")


@query(
    "a12_string_agg_all",
    "SELECT o_custkey, string_agg(o_orderstatus, ', ' ORDER BY o_orderstatus) AS items FROM orders GROUP BY 1",
)
def a12_all(t: Tables) -> DataFrame:
    return aggregates.string_agg(t.orders, ["o_custkey"], "o_orderstatus", sep=", ", distinct=False)


@query(
    "a12_ordered_distinct",
    """WITH f AS (SELECT user_id, event_type, MIN(event_id) AS p FROM events GROUP BY 1, 2)
       SELECT user_id, string_agg(event_type, ', ' ORDER BY p) AS items FROM f GROUP BY 1""",
)
def a12_order(t: Tables) -> DataFrame:
    return aggregates.ordered_distinct(t.events, ["user_id"], "event_type", "event_id")


@query("a13_status_summary", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def a13(t: Tables) -> DataFrame:
    return aggregates.status_summary(t.events, "event_type")


@query("a13_distinct_count", "SELECT event_type, COUNT(DISTINCT user_id) AS n_values FROM events GROUP BY 1")
def a13_distinct(t: Tables) -> DataFrame:
    return aggregates.distinct_count(t.events, ["event_type"], "user_id")


@query("a13_distinct_count_all", "SELECT COUNT(DISTINCT l_partkey) AS n_values FROM lineitem")
def a13_distinct_all(t: Tables) -> DataFrame:
    return aggregates.distinct_count(t.lineitem, [], "l_partkey")


@query(
    "a14_pivot_max",
    """SELECT user_id, MAX(value) FILTER (event_type = 'click') AS click, MAX(value) FILTER (event_type = 'purchase') AS purchase,
              MAX(value) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""",
)
def a14(t: Tables) -> DataFrame:
    return aggregates.pivot_max(t.events, ["user_id"], "event_type", ["click", "purchase", "view"], "value")


@query(
    "a15_grid",
    """WITH n AS (SELECT c_name, c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer),
            b AS (SELECT c_name, rn % 3 AS b, row_number() OVER (PARTITION BY rn % 3 ORDER BY c_name DESC) AS row_no FROM n)
       SELECT row_no, MAX(c_name) FILTER (b = 0) AS col_0, MAX(c_name) FILTER (b = 1) AS col_1, MAX(c_name) FILTER (b = 2) AS col_2
       FROM b GROUP BY 1""",
)
def a15(t: Tables) -> DataFrame:
    return aggregates.grid(t.customer, "c_name", 3, ["c_custkey"], [F.desc("c_name")])


@query("w1_dedup_kept", _PICK.format(columns=_LINE, rule="rn = 1"))
def w1_kept(t: Tables) -> DataFrame:
    return windows.dedup_by_key(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])[0]


@query("w1_dedup_removed", _PICK.format(columns=_LINE, rule="rn > 1"))
def w1_removed(t: Tables) -> DataFrame:
    return windows.dedup_by_key(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])[1]


@query("w2_number_rows", "SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS rn FROM events")
def w2(t: Tables) -> DataFrame:
    return windows.number_rows(t.events.select("event_id", "value"), ["value", "event_id"], "rn")


@query(
    "w2_number_copies",
    "SELECT event_type, row_number() OVER (PARTITION BY event_type) AS copy_no FROM events",
)
def w2_copies(t: Tables) -> DataFrame:
    return windows.number_copies(t.events.select("event_type"), "copy_no")


@query(
    "w3_forward_fill",
    """WITH g AS (SELECT event_id, event_type, CASE WHEN value > 20 THEN value END AS v FROM events)
       SELECT event_id, last_value(v IGNORE NULLS) OVER (ORDER BY event_id) AS value FROM g""",
)
def w3(t: Tables) -> DataFrame:
    gaps = t.events.select("event_id", F.when(F.col("value") > 20, F.col("value")).alias("value"))
    return windows.forward_fill(gaps, "value", ["event_id"], unique=True)


@query(
    "w3_forward_fill_by_key",
    """WITH g AS (SELECT event_id, event_type, CASE WHEN value > 20 THEN value END AS v FROM events)
       SELECT event_id, event_type, last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id) AS value FROM g""",
)
def w3_key(t: Tables) -> DataFrame:
    gaps = t.events.select("event_id", "event_type", F.when(F.col("value") > 20, F.col("value")).alias("value"))
    return windows.forward_fill(gaps, "value", ["event_id"], ["event_type"])


@query(
    "w4_running_count",
    "SELECT event_id, COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) OVER (ORDER BY event_id) AS n FROM events",
)
def w4(t: Tables) -> DataFrame:
    marked = t.events.select("event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"))
    return windows.running_count(marked, "value", ["event_id"], "n", unique=True).select("event_id", "n")


@query(
    "w5_number_in_bucket",
    "SELECT c_custkey, CAST(c_custkey % 3 AS INTEGER) AS bucket, row_number() OVER (PARTITION BY c_custkey % 3 ORDER BY c_acctbal, c_custkey) AS rn FROM customer",
)
def w5(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_acctbal", F.pmod("c_custkey", F.lit(3)).cast("int").alias("bucket"))
    return windows.number_rows(rows, ["c_acctbal", "c_custkey"], "rn", partition=["bucket"], unique=True).drop("c_acctbal")


@query(
    "w6_earliest_version",
    """SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderkey, o_orderdate FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def w6(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey", "o_orderdate")
    return windows.earliest_version(rows, ["o_custkey", "o_orderstatus", "o_orderpriority"], "o_orderdate", "o_orderkey")
