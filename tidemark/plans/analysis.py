"""Queries over lineage, layout and query logs, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import aggregates, layout, lineage, querylog
from tidemark.plans.registry import Tables, query

_EDGES_SQL = """edges AS (
  SELECT DISTINCT 'sales.order_' || o_orderkey AS parent, 'crm.customer_' || o_custkey AS object, 'VIEW' AS object_type FROM orders
  UNION SELECT 'crm.customer_' || c_custkey, 'geo.nation_' || c_nationkey, 'VIEW' FROM customer
  UNION SELECT 'geo.nation_' || n_nationkey, 'geo.region_' || n_regionkey, 'VIEW' FROM nation
  UNION SELECT 'geo.region_' || n_regionkey, 'geo.nation_' || MIN(n_nationkey), 'VIEW' FROM nation GROUP BY n_regionkey
  UNION SELECT 'geo.region_' || r_regionkey, 'raw.' || r_name, 'TABLE' FROM region)"""


def _edges(t: Tables) -> DataFrame:
    """Orders depend on customers, nations and regions; regions depend back on a nation (a cycle)."""

    def edge(df: DataFrame, parent, child, kind: str = "VIEW") -> DataFrame:
        return df.select(parent.alias("parent"), child.alias("object"), F.lit(kind).alias("object_type"))

    def name(prefix: str, column: str):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    back = t.nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("n_nationkey"))
    return (
        edge(t.orders, name("sales.order_", "o_orderkey"), name("crm.customer_", "o_custkey"))
        .unionByName(edge(t.customer, name("crm.customer_", "c_custkey"), name("geo.nation_", "c_nationkey")))
        .unionByName(edge(t.nation, name("geo.nation_", "n_nationkey"), name("geo.region_", "n_regionkey")))
        .unionByName(edge(back, name("geo.region_", "n_regionkey"), name("geo.nation_", "n_nationkey")))
        .unionByName(edge(t.region, name("geo.region_", "r_regionkey"), name("raw.", "r_name"), "TABLE"))
    )


_WALK = f"""WITH RECURSIVE {_EDGES_SQL},
  walk(root, object, level) AS (
    SELECT DISTINCT parent, parent, 0 FROM edges WHERE parent LIKE 'sales.%'
    UNION SELECT root, edges.object, level + 1 FROM walk JOIN edges ON edges.parent = walk.object WHERE object_type = 'VIEW' AND level < 8),
  seen AS (SELECT root, object, MIN(level) AS level FROM walk GROUP BY 1, 2),
  found AS (SELECT root, parent, edges.object, object_type, CAST(level AS INTEGER) AS level,
                   CASE WHEN level = 0 THEN 'DIRECT' ELSE 'NESTED-' || level END AS label
            FROM seen JOIN edges ON edges.parent = seen.object)"""


def _roots(t: Tables) -> DataFrame:
    return t.orders.select(F.concat(F.lit("sales.order_"), F.col("o_orderkey").cast("string")).alias("root"))


def _found(t: Tables) -> DataFrame:
    return lineage.lineage(_edges(t), _roots(t))


@query("l1_lineage", f"{_WALK} SELECT * FROM found")
def l1(t: Tables) -> DataFrame:
    return _found(t)


@query(
    "l2_lineage_summary",
    f"{_WALK} SELECT root, object_type, COUNT(DISTINCT object) AS n_objects FROM found WHERE object NOT LIKE 'crm.%' GROUP BY 1, 2",
)
def l2(t: Tables) -> DataFrame:
    return lineage.lineage_summary(_found(t), ["CRM"], F.split_part("object", F.lit("."), F.lit(1)))


@query("l2_objects_per_parent", f"{_WALK} SELECT root, parent, COUNT(DISTINCT object) AS n_objects FROM found GROUP BY 1, 2")
def l2_parents(t: Tables) -> DataFrame:
    return lineage.lineage_per_parent(_edges(t), _roots(t))


@query(
    "l3_consolidate_keys",
    """WITH f AS (SELECT o_custkey, o_orderpriority, MIN(o_orderkey) AS p FROM orders GROUP BY 1, 2),
            k AS (SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY p) AS keys FROM f GROUP BY 1)
       SELECT c_name AS object, COALESCE(keys, 'No partition key specified') AS partition_keys FROM customer LEFT JOIN k ON o_custkey = c_custkey""",
)
def l3(t: Tables) -> DataFrame:
    columns = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_name").alias("object"), F.col("o_orderpriority").alias("column_name"), F.col("o_orderkey").alias("position"))
    )
    return lineage.consolidate_keys(t.customer.select(F.col("c_name").alias("object")), columns)


_LISTS = """firsts AS (SELECT user_id, event_type, MIN(event_id) FILTER (value > 55) AS a, MIN(event_id) FILTER (value <= 55) AS b FROM events GROUP BY 1, 2),
  lists AS (SELECT user_id, COALESCE(list(upper(event_type) ORDER BY a) FILTER (a IS NOT NULL), []) AS x,
                   COALESCE(list(upper(event_type) ORDER BY b) FILTER (b IS NOT NULL), []) AS y FROM firsts GROUP BY 1)"""


def _key_texts(t: Tables) -> DataFrame:
    """Per user, the event types of large and of small values in order of appearance, as key texts."""
    large = aggregates.ordered_distinct(t.events.filter("value > 55"), ["user_id"], "event_type", "event_id", name="large")
    small = aggregates.ordered_distinct(t.events.filter("value <= 55"), ["user_id"], "event_type", "event_id", name="small")
    users = t.events.select("user_id").distinct().join(large, "user_id", "left").join(small, "user_id", "left")
    return users.select(
        "user_id",
        F.when(F.col("large").isNull(), "No Cluster Key").otherwise(F.concat(F.lit("LINEAR("), "large", F.lit(")"))).alias("left_keys"),
        F.when(F.col("small").isNull(), "").otherwise(F.concat(F.lit("["), "small", F.lit("]"))).alias("right_keys"),
    )


@query(
    "l4_compare_keys",
    f"""WITH {_LISTS}, p AS (SELECT user_id, x, y, list_sort(list_filter(x, lambda v: list_contains(y, v))) AS i, list_sort(list_filter(x, lambda v: NOT list_contains(y, v))) AS l,
             list_sort(list_filter(y, lambda v: NOT list_contains(x, v))) AS r FROM lists)
        SELECT user_id, CASE WHEN len(x) = 0 AND len(y) = 0 THEN 'No keys in either' WHEN len(l) = 0 AND len(r) = 0 THEN 'Exact match'
                 WHEN len(i) > 0 THEN 'Partial match' ELSE 'No common keys' END AS status,
               CASE WHEN len(x) = 0 OR len(y) = 0 THEN 'N/A' WHEN x = y THEN 'Exactly Matched and in Same Order'
                    WHEN len(l) = 0 AND len(r) = 0 THEN 'Matched but in different order' ELSE 'N/A' END AS order_status,
               CASE WHEN len(i) = 0 THEN 'None' ELSE array_to_string(i, ', ') END AS in_both, CASE WHEN len(l) = 0 THEN 'None' ELSE array_to_string(l, ', ') END AS only_left,
               CASE WHEN len(r) = 0 THEN 'None' ELSE array_to_string(r, ', ') END AS only_right FROM p""",
)
def l4(t: Tables) -> DataFrame:
    return lineage.compare_keys(_key_texts(t), "left_keys", "right_keys").drop("left_keys", "right_keys")


@query(
    "l5_parse_keys",
    f"WITH {_LISTS} SELECT user_id, 'left' AS side, unnest(x) AS key FROM lists UNION ALL SELECT user_id, 'right', unnest(y) FROM lists",
)
def l5(t: Tables) -> DataFrame:
    texts = _key_texts(t)
    return texts.select("user_id", F.lit("left").alias("side"), F.explode(lineage.parse_keys("left_keys")).alias("key")).unionByName(
        texts.select("user_id", F.lit("right").alias("side"), F.explode(lineage.parse_keys("right_keys")).alias("key"))
    )


_RANGES = """f AS (SELECT o_custkey AS file, MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi FROM orders GROUP BY 1),
  ov AS (SELECT a.file, COUNT(*) - 1 AS n_overlaps FROM f a JOIN f b ON b.lo <= a.hi AND b.hi >= a.lo GROUP BY 1),
  cov AS (SELECT s.lo AS pos, COUNT(*) AS depth FROM (SELECT DISTINCT lo FROM f) s JOIN f b ON b.lo <= s.lo AND b.hi >= s.lo GROUP BY 1),
  deep AS (SELECT f.file, MAX(depth) AS depth FROM f JOIN cov ON cov.pos BETWEEN f.lo AND f.hi GROUP BY 1)"""


@query("l6_interval_depth", f"WITH {_RANGES} SELECT ov.file, n_overlaps, depth FROM ov JOIN deep ON ov.file = deep.file")
def l6(t: Tables) -> DataFrame:
    return layout.interval_depth(layout.file_ranges(t.orders, "o_orderkey", "o_custkey"))


@query(
    "l6_layout_depth",
    f"""WITH {_RANGES} SELECT COUNT(*) AS n_files, round(AVG(n_overlaps), 4) AS avg_overlaps, round(AVG(depth), 4) AS avg_depth
        FROM ov JOIN deep ON ov.file = deep.file""",
)
def l6_summary(t: Tables) -> DataFrame:
    return layout.layout_depth(t.orders, "o_orderkey", "o_custkey")


def _statements(t: Tables) -> DataFrame:
    """One statement per event, with a CTE, comments, a function with FROM, and a derived table."""
    text = F.concat(
        F.lit("create or replace temporary table work_tmp as with recent as (select id from ops."),
        "event_type",
        F.lit("_log) -- from nowhere\nselect extract(year from r.ts), 1 /* join hidden h */ from recent r join crm.sales.user_"),
        F.col("user_id").cast("string"),
        F.lit(" u on r.id = u.id left join (select * from plain_"),
        F.col("event_type"),
        F.lit(") d on d.id = u.id join work_tmp w on w.id = u.id where u.day = current_date"),
    )
    return t.events.select(F.col("event_id").alias("query_id"), text.alias("sql_text"))


@query(
    "l7_sql_references",
    """SELECT event_id AS query_id, '' AS database_name, 'OPS' AS schema_name, upper(event_type) || '_LOG' AS object_name FROM events
       UNION ALL SELECT event_id, 'CRM', 'SALES', 'USER_' || user_id FROM events
       UNION ALL SELECT event_id, '', '', 'PLAIN_' || upper(event_type) FROM events""",
)
def l7(t: Tables) -> DataFrame:
    return querylog.sql_references(_statements(t))


@query(
    "l7_comma_list",
    """SELECT event_id AS query_id, '' AS database_name, 'OPS' AS schema_name, 'LOG_' || upper(event_type) AS object_name FROM events
       UNION ALL SELECT event_id, '', '', 'USER_' || user_id FROM events UNION ALL SELECT event_id, '', '', 'LAST' FROM events
       UNION ALL SELECT event_id, '', '', 'INNER_T' FROM events""",
)
def l7_comma(t: Tables) -> DataFrame:
    text = F.concat(F.lit("select f(a, b) from ops.log_"), "event_type", F.lit(" as x, user_"), F.col("user_id").cast("string"),
                    F.lit(" y, lateral flatten(x.z, y.z), (select i, j from inner_t group by i, j) d, last where x.a in (1, 2) order by a, b"))
    return querylog.sql_references(t.events.select(F.col("event_id").alias("query_id"), text.alias("sql_text")))


@query(
    "l7_quoted_apostrophe",
    """SELECT event_id AS query_id, '' AS database_name, '' AS schema_name, 'EVENTS_' || user_id AS object_name FROM events
       UNION ALL SELECT event_id, '', 'IT''S HERE', 'DAY -- ' || upper(event_type) FROM events""",
)
def l7_apostrophe(t: Tables) -> DataFrame:
    text = F.concat(F.lit('select "it\'s", trim(leading lower(upper(a)) from b) from events_'), F.col("user_id").cast("string"),
                    F.lit(' e join "it\'s here"."day -- '), "event_type", F.lit("\" d on d.a = 'x from y' where e.b = 'it''s' -- from z"))
    return querylog.sql_references(t.events.select(F.col("event_id").alias("query_id"), text.alias("sql_text")))


@query(
    "l7_long_statement",
    """SELECT o_custkey AS query_id, '' AS database_name, '' AS schema_name, 'ORDERS_' || o_orderkey AS object_name FROM orders
       UNION ALL SELECT DISTINCT o_custkey, '', 'CRM', 'CUSTOMER_' || o_custkey FROM orders""",
)
def l7_long(t: Tables) -> DataFrame:
    """A statement for each customer that lists a subquery for each order and all their clerks."""
    part = F.concat(F.lit("select trim('"), "o_orderpriority", F.lit("' from (c)) from orders_"), F.col("o_orderkey").cast("string"), F.lit(" where k in (1, 2)"))
    parts = t.orders.groupBy("o_custkey").agg(F.collect_list(part).alias("parts"), F.collect_list("o_orderpriority").alias("clerks"))
    text = F.concat(F.lit("select substring("), F.array_join("clerks", ", "), F.lit(" from 2) from crm.customer_"), F.col("o_custkey").cast("string"),
                    F.lit(" where x in ("), F.array_join("parts", " union all "), F.lit(")"))
    return querylog.sql_references(parts.select(F.col("o_custkey").alias("query_id"), text.alias("sql_text")))


@query(
    "l7_written_tables",
    """SELECT event_id AS query_id, '' AS database_name, CASE event_type WHEN 'click' THEN 'DW' ELSE '' END AS schema_name,
              CASE event_type WHEN 'click' THEN 'FACT_' || user_id WHEN 'view' THEN 'DIM_' || user_id ELSE 'STAGE_' || user_id END AS object_name FROM events""",
)
def l7_written(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("merge into dw.fact_"), user, F.lit(" f using (select * from src for update) s on f.a = s.a when matched then update set f.b = s.b")))
        .when(F.col("event_type") == "view", F.concat(F.lit("UPDATE dim_"), user, F.lit(" SET a = 1 FROM other WHERE b = 2")))
        .otherwise(F.concat(F.lit("insert overwrite table stage_"), user, F.lit(" select a from b join c using (id)")))
    )
    return querylog.sql_targets(t.events.select(F.col("event_id").alias("query_id"), text.alias("sql_text")))


_USAGE_SQL = """u AS (
  SELECT event_id AS query_id, k AS key,
    CASE WHEN event_type = 'click' THEN k IN ('ID', 'TS', 'USER_ID') ELSE k IN ('USER_ID', 'REGION', 'TS') END AS present,
    event_type = 'click' AND k = 'USER_ID' AS in_join,
    CASE WHEN event_type = 'click' THEN k = 'TS' ELSE k = 'REGION' END AS in_where,
    CASE WHEN event_type = 'click' THEN k IN ('ID', 'TS') ELSE k = 'USER_ID' END AS in_select
  FROM events, (SELECT unnest(['ID', 'TS', 'USER_ID', 'REGION', 'ABSENT']) AS k))"""


def _usage(t: Tables) -> DataFrame:
    joined = "select u.id, ts from a left join u on a.user_id = u.user_id where ts > 5 -- region"
    plain = "select user_id from a where region = 3 order by ts"
    queries = t.events.select(
        F.col("event_id").alias("query_id"), F.when(F.col("event_type") == "click", joined).otherwise(plain).alias("sql_text")
    )
    names = F.array(*[F.lit(k) for k in ("id", "ts", "user_id", "region", "absent")])
    keys = t.events.select(F.col("event_id").alias("query_id"), F.explode(names).alias("key"))
    return querylog.key_usage(queries, keys)


@query("l8_key_usage", f"WITH {_USAGE_SQL} SELECT * FROM u")
def l8(t: Tables) -> DataFrame:
    return _usage(t)


@query(
    "l8_key_usage_summary",
    f"""WITH {_USAGE_SQL} SELECT query_id, COUNT(*) AS n_keys, COUNT(*) FILTER (present) AS n_used,
          CAST(floor(COUNT(*) FILTER (present) * 100 / COUNT(*)) AS INTEGER) AS used_pct,
          CAST(floor(COUNT(*) FILTER (NOT present) * 100 / COUNT(*)) AS INTEGER) AS missing_pct FROM u GROUP BY 1""",
)
def l8_summary(t: Tables) -> DataFrame:
    return querylog.key_usage_summary(_usage(t))


def _profile(t: Tables) -> DataFrame:
    times = F.to_json(F.struct(F.col("value").alias("overall_percentage"), (F.col("value") / 2).alias("processing")))
    stats = F.to_json(
        F.struct(
            F.col("user_id").alias("input_rows"),
            (F.col("user_id") * 3).alias("output_rows"),
            F.struct((F.col("event_id") * 1000).alias("bytes_scanned")).alias("io"),
            F.struct((F.col("event_id") * 10000000).alias("bytes_spilled_local_storage")).alias("spilling"),
            F.struct(F.col("user_id").alias("partitions_scanned"), F.lit(200).alias("partitions_total")).alias("pruning"),
        )
    )
    return t.events.select(
        F.col("event_id").alias("operator_id"),
        F.col("event_type").alias("operator_type"),
        stats.alias("operator_statistics"),
        F.when(F.col("event_type") != "view", times).alias("execution_time_breakdown"),
    )


_METRICS = """SELECT event_id AS operator_id, event_type AS operator_type, CASE WHEN event_type <> 'view' THEN value END AS pct_total_time,
  CASE WHEN event_type <> 'view' THEN value / 2 END AS pct_processing, user_id AS input_rows, user_id * 3 AS rows_produced, event_id * 1000 AS bytes_scanned,
  round(event_id * 10000000 / 1073741824, 2) AS spilled_gib, user_id AS partitions_scanned, CAST(200 AS BIGINT) AS partitions_total FROM events"""


@query("l9_operator_metrics", _METRICS)
def l9_metrics(t: Tables) -> DataFrame:
    return querylog.operator_metrics(_profile(t))


@query("l9_top_operators", f"{_METRICS} ORDER BY pct_total_time DESC NULLS LAST, operator_id LIMIT 10")
def l9(t: Tables) -> DataFrame:
    return querylog.top_operators(_profile(t), 10)


@query(
    "l10_run_metrics",
    """SELECT o_orderkey AS statement_id, o_orderstatus AS execution_status, o_orderpriority AS statement_type, CAST(floor(o_totalprice) AS BIGINT) AS execution_duration_ms,
              o_orderkey * 1000 AS read_bytes, o_custkey AS read_rows, o_custkey * 2 AS produced_rows, round(o_custkey * 123456789 / 1073741824, 2) AS shuffle_read_gb,
              round(o_orderkey * 7654321 / 1073741824, 2) AS spilled_local_gb FROM orders""",
)
def l10(t: Tables) -> DataFrame:
    history = t.orders.selectExpr(
        "o_orderkey AS statement_id",
        "o_orderstatus AS execution_status",
        "o_orderpriority AS statement_type",
        "CAST(floor(o_totalprice) AS BIGINT) AS execution_duration_ms",
        "o_orderkey * 1000 AS read_bytes",
        "o_custkey AS read_rows",
        "o_custkey * 2 AS produced_rows",
        "o_custkey * 123456789 AS shuffle_read_bytes",
        "o_orderkey * 7654321 AS spilled_local_bytes",
    )
    return querylog.run_metrics(history)


@query(
    "l11_match_signature",
    """SELECT c_custkey AS query_id, 'select * from Click where  user = ' || c_custkey AS sql_text, MAX(event_id) AS statement_id, MAX(ts) AS start_time,
              CASE WHEN MAX(event_id) IS NULL THEN NULL ELSE 'FINISHED' END AS status
       FROM customer LEFT JOIN events ON user_id = c_custkey AND event_type = 'click' GROUP BY c_custkey""",
)
def l11(t: Tables) -> DataFrame:
    statement = F.concat(F.lit("SELECT *\n  FROM "), "event_type", F.lit("\twhere user = "), F.col("user_id").cast("string"), F.lit("  "))
    history = t.events.select(
        F.col("event_id").alias("statement_id"),
        F.col("ts").alias("start_time"),
        F.lit("FINISHED").alias("execution_status"),
        statement.alias("statement_text"),
    )
    asked = F.concat(F.lit("select * from Click where  user = "), F.col("c_custkey").cast("string"))
    return querylog.match_signature(history, t.customer.select(F.col("c_custkey").alias("query_id"), asked.alias("sql_text")))


@query(
    "l12_map_names",
    """SELECT c_custkey, COALESCE(r_name, 'nation_' || c_nationkey) AS area FROM customer
       LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') ON n_nationkey = c_nationkey""",
)
def l12(t: Tables) -> DataFrame:
    mapping = (
        t.nation.join(t.region.filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("name"), F.col("r_name").alias("mapped"))
    )
    named = t.customer.select("c_custkey", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("nation"))
    return lineage.map_names(named, "nation", mapping, "area").drop("nation")
