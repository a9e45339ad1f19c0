"""Queries over projections, filters, joins, ordering and sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import exact
from tidemark.operators import joins, projections, sets
from tidemark.operators.aggregates import rows_as_json
from tidemark.plans.registry import Tables, query


@query("p1_project", "SELECT o_orderkey AS order_id, o_totalprice * 2 AS doubled, 'web' AS channel FROM orders")
def p1(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_totalprice") * 2).alias("doubled"), F.lit("web").alias("channel")
    )


def _column_meta(t: Tables) -> DataFrame:
    """Control rows for the customer file: some names change, a blank keeps the name."""
    rows = [
        ("customers.csv ", "c_custkey", "CustomerKey"),
        ("customers.csv", "c_name ", "CustomerName "),
        ("customers.csv", "c_acctbal", " "),
        ("suppliers.csv", "c_mktsegment", "Wrong"),
    ]
    return t.spark.createDataFrame(rows, "file_name string, file_column string, rename_column string")


@query(
    "p2_rename_by_map",
    'SELECT c_custkey AS "CustomerKey", c_name AS "CustomerName", c_nationkey, c_acctbal, c_mktsegment FROM customer',
)
def p2(t: Tables) -> DataFrame:
    return projections.rename_by_map(t.customer, _column_meta(t), "customers.csv")


@query("p3_normalise_names", "SELECT c_custkey AS customerkey, c_mktsegment AS marketsegment FROM customer")
def p3(t: Tables) -> DataFrame:
    return projections.normalise_names(
        t.customer.select(F.col("c_custkey").alias("Customer Key"), F.col("c_mktsegment").alias("Market Segment "))
    )


@query(
    "p4_schema_map",
    """SELECT CAST(o_orderkey AS INTEGER) AS order_key, o_orderstatus AS status,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS total, CAST(o_orderdate AS DATE) AS order_day
       FROM orders""",
)
def p4(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.concat(F.lit("  "), F.col("o_orderkey").cast("string")).alias("order_key"),
        F.concat(F.col("o_orderstatus"), F.lit("  ")).alias("status"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.lit("not mapped").alias("rest"),
    )
    return projections.apply_schema_map(raw, ["order_key", "status", "total", "order_day"], ["int", "string", "double", "date"])


@query(
    "p5_column_map",
    """SELECT c_name AS file_name, 1 AS position, c_mktsegment AS source_column, upper(c_name) AS target_column, 'string' AS column_type FROM customer
       UNION ALL SELECT c_name, 2, 'n' || c_nationkey, 'key', 'int' FROM customer""",
)
def p5(t: Tables) -> DataFrame:
    return projections.explode_column_map(_mapping(t))


@query(
    "p5_column_map_json",
    """WITH m AS (SELECT c_name AS file_name, 1 AS position, c_mktsegment AS source, upper(c_name) AS target FROM customer
                  UNION ALL SELECT c_name, 2, 'n' || c_nationkey, 'key' FROM customer)
       SELECT file_name, CAST(to_json(list({'position': position, 'source': source, 'target': target} ORDER BY position)) AS VARCHAR) AS body FROM m GROUP BY 1""",
)
def p5_json(t: Tables) -> DataFrame:
    pairs = projections.explode_column_map(_mapping(t))
    names = {"position": "position", "source": "source_column", "target": "target_column"}
    return rows_as_json(pairs, ["file_name"], names)


def _mapping(t: Tables) -> DataFrame:
    """Bracketed column lists per file, one per customer."""
    return t.customer.select(
        F.col("c_name").alias("file_name"),
        F.format_string("[%s, n%d]", "c_mktsegment", "c_nationkey").alias("source_columns"),
        F.format_string("[%s ,key]", F.upper("c_name")).alias("target_columns"),
        F.lit("[string, int]").alias("column_types"),
    )


@query("p6_trim_all", "SELECT p_partkey, p_name, p_type FROM part")
def p6(t: Tables) -> DataFrame:
    padded = t.part.select(
        "p_partkey", F.concat(F.lit(" "), "p_name", F.lit("  ")).alias("p_name"), F.concat("p_type", F.lit(" ")).alias("p_type")
    )
    return projections.trim_all(padded)


@query(
    "p7_replace_token",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'NA' ELSE o_orderpriority END AS o_orderpriority, o_totalprice FROM orders",
)
def p7(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("\\N")).otherwise(F.col("o_orderpriority"))
    return projections.replace_token(t.orders.select("o_orderkey", text.alias("o_orderpriority"), "o_totalprice"), "\\N", "NA")


@query(
    "p8_filters",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_returnflag = 'R' AND l_linestatus <> 'F' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",
)
def p8(t: Tables) -> DataFrame:
    kept = t.lineitem.filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") != "F")
        & F.col("l_discount").between(0.05, 0.07)
        & (F.col("l_quantity") < 24)
    )
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "p9_classify_in_list",
    """SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'debtor' ELSE 'other' END AS kind
       FROM orders""",
)
def p9(t: Tables) -> DataFrame:
    codes = t.customer.filter("c_acctbal < 0").select("c_custkey")
    return projections.classify_in_list(t.orders, "o_custkey", codes, "debtor", "other", "kind").select("o_orderkey", "kind")


@query("p10_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%ring' OR p_name LIKE '%mal%'")
def p10(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.filter(name.startswith("red") | name.endswith("ring") | name.like("%mal%")).select("p_partkey", "p_name")


@query("p11_any_column", "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE 'O' IN (l_returnflag, l_linestatus)")
def p11(t: Tables) -> DataFrame:
    kept = t.lineitem.filter(projections.any_column_equals(["l_returnflag", "l_linestatus"], "O"))
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query(
    "p12_drop_sentinel",
    "SELECT event_id, event_type, user_id FROM events WHERE event_type NOT IN ('error', 'view')",
)
def p12(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "unknown").when(F.col("event_type") != "view", F.col("event_type"))
    return projections.drop_sentinel(t.events.select("event_id", kind.alias("event_type"), "user_id"))


@query("p13_last_days", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-23'")
def p13(t: Tables) -> DataFrame:
    return projections.filter_last_days(t.events, "ts", 7, dt.date(2024, 1, 30)).select("event_id", "ts")


@query(
    "j1_inner_chain",
    """SELECT r_name, n_name, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def j1(t: Tables) -> DataFrame:
    joined = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("r_name", "n_name").agg(
        F.count("*").alias("n"), F.sum(exact("l_extendedprice")).cast("double").alias("total")
    )


def _good_customers(t: Tables) -> DataFrame:
    return t.customer.filter("c_acctbal >= 0")


@query(
    "j2_left_lookup",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""",
)
def j2(t: Tables) -> DataFrame:
    joined = t.orders.join(_good_customers(t), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "j3_left_anti",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
)
def j3(t: Tables) -> DataFrame:
    known = _good_customers(t).select(F.col("c_custkey").alias("o_custkey"))
    return joins.new_rows(t.orders.select("o_orderkey", "o_custkey"), known, ["o_custkey"])


@query(
    "j4_not_exists_expression",
    """SELECT c_custkey, c_name FROM customer s WHERE NOT EXISTS (
         SELECT 1 FROM orders t WHERE t.o_custkey = s.c_custkey AND t.o_totalprice > s.c_acctbal * 45 AND substr(t.o_orderpriority, 1, 1) = '1')""",
)
def j4(t: Tables) -> DataFrame:
    on = (
        (F.col("t.o_custkey") == F.col("s.c_custkey"))
        & (F.col("t.o_totalprice") > F.col("s.c_acctbal") * 45)
        & (F.substring("t.o_orderpriority", 1, 1) == "1")
    )
    return joins.new_rows(t.customer, t.orders, on=on).select("c_custkey", "c_name")


@query(
    "j5_computed_key",
    """WITH days AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n_events FROM events GROUP BY 1)
       SELECT event_id, n_events FROM events JOIN days ON CAST(ts AS DATE) = day""",
)
def j5(t: Tables) -> DataFrame:
    days = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n_events"))
    return t.events.withColumn("day", F.to_date("ts")).join(days, "day").select("event_id", "n_events")


@query(
    "j6_role_playing",
    """SELECT l_orderkey, l_linenumber, l_partkey, a.n_name AS buyer_nation, b.n_name AS seller_nation FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = s_nationkey""",
)
def j6(t: Tables) -> DataFrame:
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    rows = joins.lookup(rows, t.nation, {"c_nationkey": "n_nationkey"}, "n_name", "buyer_nation")
    rows = joins.lookup(rows, t.nation, {"s_nationkey": "n_nationkey"}, "n_name", "seller_nation")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "buyer_nation", "seller_nation")


@query(
    "j7_residual_inequality",
    """SELECT a.c_custkey, a.c_mktsegment AS old_segment, b.seg AS new_segment FROM customer a
       JOIN (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN 'PREMIUM' ELSE c_mktsegment END AS seg FROM customer) b
         ON a.c_custkey = b.c_custkey WHERE a.c_mktsegment IS DISTINCT FROM b.seg""",
)
def j7(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, None).when(F.col("c_acctbal") > 9000, "PREMIUM").otherwise(F.col("c_mktsegment"))
    staged = t.customer.select("c_custkey", segment.alias("new_segment"))
    old = t.customer.select("c_custkey", F.col("c_mktsegment").alias("old_segment"))
    return old.join(staged, "c_custkey").filter(~F.col("old_segment").eqNullSafe(F.col("new_segment")))


@query(
    "j8_join_active",
    """SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'MACHINERY'""",
)
def j8(t: Tables) -> DataFrame:
    dim = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    joined = joins.join_active(t.orders, dim, ["o_custkey"], F.col("c_mktsegment") != "MACHINERY")
    return joined.select("o_orderkey", "c_name")


@query(
    "j9_measured_broadcast",
    """SELECT p_brand, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def j9(t: Tables) -> DataFrame:
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    joined = t.lineitem.select("l_partkey", "l_quantity").join(dim, "l_partkey")
    return joined.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum(exact("l_quantity")).cast("double").alias("quantity"))


@query(
    "j10_pre_aggregated",
    """SELECT o_orderkey, o_totalprice, n_lines, quantity FROM orders JOIN
         (SELECT l_orderkey, COUNT(*) AS n_lines, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
          FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def j10(t: Tables) -> DataFrame:
    detail = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    sums = {"n_lines": F.count("*"), "quantity": F.sum(exact("l_quantity")).cast("double")}
    return joins.pre_aggregate_join(t.orders.select("o_orderkey", "o_totalprice"), detail, ["o_orderkey"], sums)


@query(
    "j11_assemble",
    """SELECT (SELECT MAX(o_orderdate) FROM orders) AS last_order, (SELECT COUNT(*) FROM customer) AS customers,
              (SELECT MIN(ts) FROM events) AS first_event""",
)
def j11(t: Tables) -> DataFrame:
    return joins.assemble(
        t.spark,
        last_order=t.orders.agg(F.max("o_orderdate")),
        customers=t.customer.agg(F.count("*")),
        first_event=t.events.agg(F.min("ts")),
    )


@query(
    "j12_explode_json",
    """SELECT event_id, 'type' AS sub_type, event_type AS value FROM events
       UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events""",
)
def j12(t: Tables) -> DataFrame:
    packed = t.events.select(
        "event_id",
        F.to_json(
            F.array(
                F.struct(F.lit("type").alias("sub_type"), F.col("event_type").alias("value")),
                F.struct(F.lit("k").alias("sub_type"), F.get_json_object("props", "$.k").alias("value")),
            )
        ).alias("body"),
    )
    return joins.explode_json(packed, "body", "array<struct<sub_type: string, value: string>>")


@query(
    "j13_lookup_id",
    """SELECT s_suppkey, (SELECT MIN(c_custkey) FROM customer WHERE c_nationkey = s_nationkey AND c_mktsegment = 'BUILDING') AS builder
       FROM supplier""",
)
def j13(t: Tables) -> DataFrame:
    staged = t.supplier.withColumn("segment", F.lit("BUILDING"))
    on = {"s_nationkey": "c_nationkey", "segment": "c_mktsegment"}
    return joins.lookup_id(staged, t.customer, on, "c_custkey", "builder").select("s_suppkey", "builder")


@query("j14_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING MAX(o_totalprice) > 400000)")
def j14(t: Tables) -> DataFrame:
    buyers = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top")).filter("top > 400000")
    return joins.keep_matching(t.customer, buyers, ["c_custkey"]).select("c_custkey", "c_name")


@query("t1_order_by", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC NULLS LAST")
def t1(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_mktsegment", F.desc_nulls_last("c_acctbal"))


@query("t2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def t2(t: Tables) -> DataFrame:
    return sets.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("t3_preview", "SELECT COUNT(*) AS n FROM (SELECT * FROM lineitem LIMIT 100)")
def t3(t: Tables) -> DataFrame:
    return t.lineitem.limit(100).agg(F.count("*").alias("n"))


@query(
    "t4_union_conformed",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'unknown' FROM supplier""",
)
def t4(t: Tables) -> DataFrame:
    customers = t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    suppliers = t.supplier.selectExpr("s_name AS name", "s_suppkey AS id")
    return sets.union_conformed([customers, suppliers], {"segment": "unknown"})


@query("t5_union_all", "SELECT l_orderkey AS k FROM lineitem UNION ALL SELECT o_orderkey FROM orders")
def t5(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("k")).union(t.orders.select("o_orderkey"))


@query("t6_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def t6(t: Tables) -> DataFrame:
    return sets.union_distinct(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"))


@query(
    "t7_compare_sets",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders),
            b AS (SELECT DISTINCT CASE WHEN c_acctbal > 5000 THEN c_custkey ELSE -c_custkey END AS k FROM customer)
       SELECT COALESCE(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' WHEN a.k IS NULL THEN 'right' ELSE 'both' END AS side
       FROM a FULL JOIN b ON a.k = b.k""",
)
def t7(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_custkey").alias("k"))
    b = t.customer.select(F.when(F.col("c_acctbal") > 5000, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("k"))
    return sets.compare_sets(a, b, ["k"])


@query(
    "t7_array_difference",
    """SELECT o_custkey, CASE WHEN MAX(CASE WHEN o_orderstatus = 'F' THEN 1 END) = 1 AND MAX(CASE WHEN o_orderstatus = 'O' THEN 1 END) = 1
              THEN 'both' WHEN MAX(CASE WHEN o_orderstatus = 'F' THEN 1 END) = 1 THEN 'finished' WHEN MAX(CASE WHEN o_orderstatus = 'O' THEN 1 END) = 1 THEN 'open'
              ELSE 'none' END AS states
       FROM orders GROUP BY 1""",
)
def t7_arrays(t: Tables) -> DataFrame:
    seen = t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s"))
    parts = sets.array_difference(F.col("s"), F.array(F.lit("F"), F.lit("O")))
    lacking = F.array_join(parts["only_right"], "")
    label = (
        F.when(lacking == "", "both").when(lacking == "O", "finished").when(lacking == "F", "open").otherwise("none")
    )
    return seen.select("o_custkey", label.alias("states"))


