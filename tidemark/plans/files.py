"""Queries over sources and sinks: each writes the given tables to new folders and reads them back."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import path_segment
from tidemark.operators.aggregates import rows_as_json
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch
from tidemark.sources import readers, writers
from tidemark.streaming.ingest import copy_into, create_target

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _table_name(label: str) -> str:
    return f"tidemark_{label}_{uuid.uuid4().hex[:12]}"


@query("s1_csv_inferred", "SELECT * FROM orders")
def s1(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s1")
    writers.write_files(t.orders, out, "csv")
    read = readers.read_csv(t.spark, out)
    wanted = t.orders.schema
    return read.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


@query("s2_csv_declared", "SELECT * FROM customer")
def s2(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s2")
    writers.write_files(t.customer, out, "csv")
    ddl = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return readers.read_csv(t.spark, out, ddl)


@query("s3_tsv", "SELECT * FROM part")
def s3(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s3")
    writers.write_files(t.part, out, "csv", sep="\t")
    ddl = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return readers.read_csv(t.spark, out, ddl, sep="\t")


@query("s4_csv_quoted", "SELECT conv_id, turn, role, text FROM conversations")
def s4(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s4")
    writers.write_files(t.conversations, out, "csv", quote='"', escape='"', **KEEP_BLANKS)
    ddl = "conv_id bigint, turn bigint, role string, text string"
    return readers.read_csv(t.spark, out, ddl, multiLine="true", **KEEP_BLANKS)


@query("s5_parquet_projected", "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem")
def s5(t: Tables) -> DataFrame:
    ddl = "l_orderkey bigint, l_quantity double, l_shipdate timestamp_ntz"
    return readers.read_parquet(t.spark, t.path("lineitem"), ddl)


@query("s6_folder_tree", "SELECT * FROM orders")
def s6(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s6")
    writers.write_files(t.orders.filter("o_orderstatus = 'F'"), f"{out}/finished")
    writers.write_files(t.orders.filter("o_orderstatus = 'O'"), f"{out}/open/first")
    writers.write_files(t.orders.filter("o_orderstatus = 'P'"), f"{out}/open/second")
    return readers.read_files(t.spark, out, "parquet", ORDERS, recursive=True)


@query("s6_glob_and_list", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def s6_glob(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s6g")
    t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderstatus").alias("folder")).write.partitionBy("folder").parquet(out)
    ddl = "o_orderkey bigint, o_orderstatus string"
    return readers.read_files(t.spark, [f"{out}/folder=F", f"{out}/folder=[P-Z]"], "parquet", ddl)


@query(
    "s7_partition_columns",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
       FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) BETWEEN 1 AND 3""",
)
def s7(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s7")
    dated = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    writers.write_partitioned(dated, out, ["year", "month"])
    return readers.read_partitioned(t.spark, out).filter("year = 1997 AND month BETWEEN 1 AND 3")


@query(
    "s7_path_parts",
    "SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus AS state, 'o_orderpriority=' || o_orderpriority AS priority FROM orders",
)
def s7_parts(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s7p")
    # Blanks in folder names would be escaped, so the priority text is shown as it is stored.
    t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").write.partitionBy("o_orderstatus", "o_orderpriority").parquet(out)
    read = readers.read_partitioned(t.spark, out, parts=["state", "priority"], schema="o_orderkey bigint")
    return read.withColumn("priority", F.url_decode(F.col("priority")))


@query("s8_source_file", "SELECT o_orderkey, 'orders.parquet' AS source_file FROM orders")
def s8(t: Tables) -> DataFrame:
    return readers.with_source_file(t.orders).select("o_orderkey", "source_file")


@query(
    "s9_source_tag",
    """SELECT c_custkey AS id, c_name AS name, 'T' AS source_tag FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'F' FROM supplier""",
)
def s9(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s9")
    writers.write_files(t.customer.selectExpr("c_custkey AS id", "c_name AS name"), f"{out}/2_wheelers")
    writers.write_files(t.supplier.selectExpr("s_suppkey AS id", "s_name AS name"), f"{out}/4_wheelers")
    both = readers.read_files(t.spark, out, "parquet", "id bigint, name string", recursive=True)
    return readers.tag_by_source(both, {"/2_wheelers/": "T", "/4_wheelers/": "F"})


@query("s10_json_nested", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def s10(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s10")
    nested = t.orders.select(
        "o_orderkey", F.struct("o_custkey", F.struct("o_orderstatus", "o_totalprice").alias("state")).alias("head")
    )
    writers.write_files(nested, out, "json")
    ddl = "o_orderkey bigint, head struct<o_custkey: bigint, state: struct<o_orderstatus: string, o_totalprice: double>>"
    return readers.read_json(t.spark, out, schema=ddl).select("o_orderkey", "head.o_custkey", "head.state.*")


@query("s10_json_multiline", "SELECT n_name AS name, CAST(n_nationkey AS BIGINT) AS id FROM nation")
def s10_multi(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s10m")
    documents = rows_as_json(t.nation, ["n_regionkey"], {"id": "n_nationkey", "name": "n_name"}, name="value")
    documents.write.partitionBy("n_regionkey").text(out)
    return readers.read_json(t.spark, f"{out}/*", multiline=True, schema="id bigint, name string")


@query(
    "s11_text_rows",
    "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, COUNT(*) AS n FROM events GROUP BY 1",
)
def s11(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s11")
    t.events.select("props").write.text(out)
    rows = readers.read_text(t.spark, out)
    return rows.groupBy(F.get_json_object("value", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))


@query("s11_query_file", "SELECT * FROM supplier")
def s11_file(t: Tables) -> DataFrame:
    return readers.query_file(t.spark, t.path("supplier"))


@query(
    "s12_rescued",
    """SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
              CASE WHEN event_type = 'error' THEN event_id || ',' || event_type || ',n/a' END AS _rescued
       FROM events""",
)
def s12(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s12")
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    writers.write_files(t.events.select("event_id", "event_type", text.alias("value")), out, "csv")
    return readers.read_rescued(t.spark, out, "event_id bigint, event_type string, value double", header="true")


@query("s14_catalog_table", "SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1")
def s14(t: Tables) -> DataFrame:
    name = _table_name("s14")
    writers.save_table(t.customer, name, scratch(t.spark, "s14"))
    return t.spark.table(name).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "s14_describe",
    """SELECT column_name AS col_name,
              CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS data_type
       FROM information_schema.columns WHERE table_name = 'customer'""",
)
def s14_describe(t: Tables) -> DataFrame:
    name = _table_name("s14d")
    writers.save_table(t.customer, name, scratch(t.spark, "s14d"))
    return readers.describe_columns(t.spark, name)


@query(
    "s15_profile_widths",
    """SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, CAST(MAX(length(CAST(o_orderkey AS VARCHAR))) AS INTEGER) AS max_len FROM orders
       UNION ALL SELECT 'o_orderstatus', 'string', CAST(MAX(length(o_orderstatus)) AS INTEGER) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'string', CAST(MAX(length(o_orderpriority)) AS INTEGER) FROM orders
       UNION ALL SELECT 'o_custkey', 'bigint', CAST(MAX(length(CAST(o_custkey AS VARCHAR))) AS INTEGER) FROM orders""",
)
def s15(t: Tables) -> DataFrame:
    return readers.profile_widths(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey"))


@query("s16_copy_into", "SELECT event_id, user_id, event_type, value FROM events")
def s16(t: Tables) -> DataFrame:
    base, table = scratch(t.spark, "s16"), _table_name("s16")
    src, checkpoint = f"{base}/landing", f"{base}/checkpoint"
    ddl = "event_id bigint, user_id bigint, event_type string, value double"
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    create_target(t.spark, table, ddl, f"{base}/table")
    rows.filter("event_type IN ('click', 'view')").write.parquet(src)
    copy_into(t.spark, src, table, checkpoint, ddl)
    rows.filter("event_type NOT IN ('click', 'view')").write.mode("append").parquet(src)
    copy_into(t.spark, src, table, checkpoint, ddl)
    again = copy_into(t.spark, src, table, checkpoint, ddl)
    if again:
        raise AssertionError(f"a third run loaded {again} rows again")
    return t.spark.table(table)


@query(
    "s16_copy_into_merge_schema",
    "SELECT event_id, event_type, CASE WHEN event_type <> 'view' THEN value END AS value FROM events",
)
def s16_merge(t: Tables) -> DataFrame:
    base, table = scratch(t.spark, "s16m"), _table_name("s16m")
    narrow, wide = "event_id bigint, event_type string", "event_id bigint, event_type string, value double"
    create_target(t.spark, table, narrow, f"{base}/table")
    t.events.filter("event_type = 'view'").select("event_id", "event_type").write.parquet(f"{base}/landing")
    copy_into(t.spark, f"{base}/landing", table, f"{base}/checkpoint", narrow)
    t.events.filter("event_type <> 'view'").select("event_id", "event_type", "value").write.mode("append").parquet(f"{base}/landing")
    copy_into(t.spark, f"{base}/landing", table, f"{base}/checkpoint", wide, merge_schema=True)
    return t.spark.table(table)


@query("s17_list_files", "SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder FROM orders")
def s17(t: Tables) -> DataFrame:
    out = scratch(t.spark, "s17")
    t.orders.write.partitionBy("o_orderstatus").parquet(out)
    files = readers.list_files(t.spark, out).filter(F.col("size") > 0)
    return files.filter(F.startswith("name", F.lit("part-"))).select(path_segment("path", -2).alias("folder")).distinct()


@query(
    "s18_named_result",
    """WITH big AS (SELECT o_custkey, o_totalprice FROM orders)
       SELECT o_custkey, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM big GROUP BY 1""",
)
def s18(t: Tables) -> DataFrame:
    view = _table_name("big_orders")
    t.orders.select("o_custkey", "o_totalprice").createOrReplaceTempView(view)
    return t.spark.sql(
        f"SELECT o_custkey, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {view} GROUP BY 1"
    )


@query(
    "k1_land_to_bronze",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, NULL AS region, 'customers' AS source, 2024 AS year, 3 AS month, 9 AS day FROM customer
       UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, 'suppliers', 2024, 3, 9 FROM supplier
       UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR), 'nations', 2024, 3, 9 FROM nation""",
)
def k1(t: Tables) -> DataFrame:
    base = scratch(t.spark, "k1")
    landing = {name: f"{base}/landing/{name}" for name in ("customers", "suppliers", "nations")}
    writers.write_files(t.customer.selectExpr("c_custkey AS id", "c_name AS name"), landing["customers"], "csv")
    writers.write_files(t.supplier.selectExpr("s_suppkey AS id", "s_name AS name"), landing["suppliers"], "csv")
    nations = t.nation.selectExpr("n_regionkey AS region", "n_name AS name", "n_nationkey AS id")
    writers.write_files(nations, landing["nations"], "csv")
    writers.land_to_bronze(t.spark, landing, f"{base}/bronze", dt.date(2024, 3, 9))
    layers = [writers.read_layer(t.spark, f"{base}/bronze", name).withColumn("source", F.lit(name)) for name in landing]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


@query(
    "k2_dated_layer",
    """SELECT o_orderkey, 2024 AS year, 3 AS month, 1 AS day FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT o_orderkey, 2024, 3, 2 FROM orders""",
)
def k2(t: Tables) -> DataFrame:
    base = scratch(t.spark, "k2")
    keys = t.orders.select("o_orderkey")
    writers.write_layer(keys, base, dt.date(2024, 3, 1))
    writers.write_layer(keys, base, dt.date(2024, 3, 2))
    return writers.write_layer(t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey"), base, dt.date(2024, 3, 1))


@query("k3_save_table", "SELECT s_suppkey, upper(s_name) AS s_name FROM supplier")
def k3(t: Tables) -> DataFrame:
    name, path = _table_name("k3"), scratch(t.spark, "k3")
    writers.save_table(t.supplier.select("s_suppkey", "s_name"), name, path)
    return writers.save_table(t.supplier.select("s_suppkey", F.upper("s_name").alias("s_name")), name, path)


@query(
    "k4_append_enforced",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice END AS o_totalprice
       FROM orders""",
)
def k4(t: Tables) -> DataFrame:
    old = t.orders.filter("o_orderdate < timestamp_ntz'1998-01-01'").select("o_orderkey", "o_custkey", "o_totalprice")
    new = t.orders.filter("o_orderdate >= timestamp_ntz'1998-01-01'").select("o_orderpriority", "o_custkey", "o_orderkey")
    return writers.append_enforced(old, new, merge_schema=True)


@query("k5_file_count", "SELECT CAST(5 AS BIGINT) AS n_files, COUNT(*) AS n_rows FROM lineitem")
def k5(t: Tables) -> DataFrame:
    out = scratch(t.spark, "k5")
    writers.write_files(t.lineitem, out, files=5)
    read = readers.with_source_file(t.spark.read.parquet(out))
    return read.agg(F.count_distinct("source_file").alias("n_files"), F.count("*").alias("n_rows"))


@query(
    "k6_good_bad",
    "SELECT event_id, value, CASE WHEN value > 5 AND event_type <> 'error' THEN 'good' ELSE 'bad' END AS verdict FROM events",
)
def k6(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "value", "event_type")
    ok = (F.col("value") > 5) & (F.col("event_type") != "error")
    return writers.write_good_bad(rows, ok, scratch(t.spark, "k6")).drop("event_type")


@query("k7_partition_sizes", "SELECT CAST(8 AS BIGINT) AS n_partitions, CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem")
def k7(t: Tables) -> DataFrame:
    sizes = writers.partition_sizes(t.lineitem.repartition(8))
    return sizes.agg(F.count("*").alias("n_partitions"), F.sum("count").alias("n_rows"))
