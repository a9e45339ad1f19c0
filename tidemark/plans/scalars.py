"""Queries over text, JSON, date and numeric expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, documents, text, values
from tidemark.operators import aggregates
from tidemark.plans.registry import Tables, query


@query(
    "f1_basic_text",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, ltrim('  ' || p_name || ' ') AS left_trimmed, rtrim('  ' || p_name || ' ') AS right_trimmed,
              lower(p_brand) AS low, upper(p_name) AS up, CAST(length(p_name) AS INTEGER) AS len, p_brand || '/' || p_type AS both_parts FROM part""",
)
def f1(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return t.part.select(
        "p_partkey",
        F.trim(padded).alias("trimmed"),
        F.ltrim(padded).alias("left_trimmed"),
        F.rtrim(padded).alias("right_trimmed"),
        F.lower("p_brand").alias("low"),
        F.upper("p_name").alias("up"),
        text.text_length(F.concat("p_name", F.lit("  "))).alias("len"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("both_parts"),
    )


@query(
    "f2_between_markers",
    """WITH a AS (SELECT doc_id, text, instr(text, 'the') AS p FROM documents),
            b AS (SELECT doc_id, CASE WHEN p > 0 THEN substr(text, 1, p - 1) END AS before_text,
                         CASE WHEN p > 0 THEN substr(text, p + 3) END AS after_text FROM a)
       SELECT doc_id, before_text, after_text,
              CASE WHEN instr(after_text, '.') > 0 THEN substr(after_text, 1, instr(after_text, '.') - 1) ELSE after_text END AS between_text FROM b""",
)
def f2(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        text.text_before("text", "the").alias("before_text"),
        text.text_after("text", "the").alias("after_text"),
        text.text_between("text", "the", ".").alias("between_text"),
    )


def _nested_replace(column: str) -> str:
    out = column
    for token, value in text.RICH_TEXT_TOKENS:
        out = f"replace({out}, '{token}', '{value}')"
    return out


@query("f3_plain_text", f"SELECT page_id, trim({_nested_replace('html')}) AS plain FROM pages")
def f3(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.plain_text("html").alias("plain"))


@query("f4_one_line", "SELECT doc_id, replace(replace(replace(text, chr(13), ''), chr(10), ''), chr(9), '') AS line FROM documents")
def f4(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.one_line("text").alias("line"))


@query("f5_regexp_replace", "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS bare FROM pages")
def f5(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace("html", "<[^>]*>", "").alias("bare"))


@query(
    "f6_dotted_part",
    """WITH p AS (SELECT page_id, string_split(url, '.') AS parts FROM pages)
       SELECT page_id, CASE WHEN len(parts) <= 4 THEN parts[-1] END AS last_part, CASE WHEN len(parts) <= 4 THEN parts[-3] END AS third_part FROM p""",
)
def f6(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", text.dotted_part("url", 1).alias("last_part"), text.dotted_part("url", 3).alias("third_part")
    )


@query(
    "f6_names_of_email",
    "SELECT c_custkey, 'customer' AS first_name, split_part(c_name, '#', 2) AS last_name FROM customer",
)
def f6_email(t: Tables) -> DataFrame:
    email = F.lower(F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"), "c_mktsegment", F.lit(".com")))
    return t.customer.select(
        "c_custkey", text.email_first_name(email).alias("first_name"), text.email_last_name(email).alias("last_name")
    )


@query("f7_initial_capital", "SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS label FROM part")
def f7(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.initial_capital("p_name").alias("label"))


@query(
    "f8_path_parts",
    """SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '/')[7] AS deep, regexp_replace(string_split(url, '/')[-1], '\\.[^.]*$', '') AS stem,
              split_part(url, '?', 2) AS query_text FROM pages""",
)
def f8(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        text.path_segment("url", 3).alias("host"),
        text.path_segment("url", 7).alias("deep"),
        text.file_stem("url").alias("stem"),
        F.split_part("url", F.lit("?"), F.lit(2)).alias("query_text"),
    )


@query(
    "f9_list_items",
    """SELECT c_custkey, c_mktsegment AS item FROM customer UNION ALL SELECT c_custkey, 'n' || c_nationkey FROM customer""",
)
def f9(t: Tables) -> DataFrame:
    packed = F.format_string("[%s ,  n%d]", "c_mktsegment", "c_nationkey")
    return t.customer.select("c_custkey", F.explode(text.list_items(packed)).alias("item"))


@query(
    "f10_arrays",
    """WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
       SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words[2:4], '-') AS some, words[1] || '|' || doc_id AS tag FROM w""",
)
def f10(t: Tables) -> DataFrame:
    words = F.split("text", " ")
    return t.documents.select(
        "doc_id",
        F.size(words).alias("n_words"),
        F.array_join(F.slice(words, 2, 3), "-").alias("some"),
        F.concat_ws("|", words[0], F.col("doc_id").cast("string")).alias("tag"),
    )


@query(
    "f10_explode_words",
    "SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1",
)
def f10_explode(t: Tables) -> DataFrame:
    words = values.exploded(t.documents.select(F.split("text", " ").alias("words")), F.col("words"), "word")
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(
    "f11_json_value",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS absent,
              event_type AS second FROM events""",
)
def f11(t: Tables) -> DataFrame:
    nested = F.to_json(F.struct(F.array(F.lit("x"), F.col("event_type")).alias("items")))
    return t.events.select(
        "event_id",
        documents.json_value("props", "$.k", "int").alias("k"),
        documents.json_value("props", "$.none").alias("absent"),
        documents.json_value(nested, "$.items[1]").alias("second"),
    )


@query(
    "f12_json_typed",
    """SELECT event_id, event_type AS kind, value AS amount FROM events WHERE value IS NOT NULL""",
)
def f12(t: Tables) -> DataFrame:
    body = F.to_json(F.struct("event_id", F.array(F.struct("event_type", "value")).alias("parts")))
    parsed = t.events.select(
        documents.json_struct(body, "event_id bigint, parts array<struct<event_type: string, value: double>>").alias("d")
    )
    rows = parsed.select("d.event_id", F.inline("d.parts"))
    return rows.select("event_id", F.col("event_type").alias("kind"), F.col("value").alias("amount"))


@query(
    "f13_tolerant_json",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def f13(t: Tables) -> DataFrame:
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "props")).otherwise(
        F.concat(F.lit('{"a": {"b": '), "props", F.lit("}}"))
    )
    return t.events.select("event_id", documents.json_variant(body, "$.a.b.k", "bigint").alias("k"))


@query(
    "f14_rows_as_json",
    """SELECT l_orderkey, CAST(to_json(list({'line': l_linenumber, 'part': l_partkey} ORDER BY l_linenumber, l_partkey)) AS VARCHAR) AS body
       FROM lineitem GROUP BY 1""",
)
def f14(t: Tables) -> DataFrame:
    return aggregates.rows_as_json(t.lineitem, ["l_orderkey"], {"line": "l_linenumber", "part": "l_partkey"})


@query(
    "f15_parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 8 HOUR + INTERVAL 5 MINUTE END AS moment FROM orders""",
)
def f15(t: Tables) -> DataFrame:
    day = F.when(F.col("o_orderstatus") == "P", "31-31-1999").otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    return t.orders.select(
        "o_orderkey",
        dates.parse_date(day, "dd-MM-yyyy").alias("day"),
        dates.parse_timestamp(F.concat(day, F.lit(" 08:05")), "dd-MM-yyyy HH:mm").alias("moment"),
    )


@query("f16_month_key", "SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y%m') AS month_key FROM lineitem")
def f16(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", dates.month_key("l_shipdate").alias("month_key"))


@query("f17_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def f17(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.date_key("o_orderdate").alias("date_key"))


@query(
    "f18_date_parts",
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, dayname(ts) AS day_name, CAST(day(ts) AS INTEGER) AS day_of_month,
              CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CAST(weekofyear(ts) AS INTEGER) AS week_of_year, CAST(month(ts) AS INTEGER) AS month,
              monthname(ts) AS month_name, 'Q' || quarter(ts) AS quarter, CAST(year(ts) AS INTEGER) AS year FROM events""",
)
def f18(t: Tables) -> DataFrame:
    return t.events.select("event_id", *[c.alias(n) for n, c in dates.date_parts("ts").items()])


@query(
    "f19_date_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS due, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS age FROM orders""",
)
def f19(t: Tables) -> DataFrame:
    as_of = F.lit(dt.date(2001, 12, 31))
    return t.orders.select(
        "o_orderkey", F.date_add("o_orderdate", 30).alias("due"), F.datediff(as_of, "o_orderdate").alias("age")
    )


@query(
    "f20_date_of_file_name",
    """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS day_first, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS year_first,
              'N/A' AS absent FROM orders""",
)
def f20(t: Tables) -> DataFrame:
    def name(pattern: str):
        return F.concat(F.lit("daily_sales_"), F.date_format("o_orderdate", pattern), F.lit(".csv"))

    return t.orders.select(
        "o_orderkey",
        text.file_date(name("ddMMyyyy"), "ddMMyyyy").alias("day_first"),
        text.file_date(name("yyyyMMdd"), "yyyyMMdd").alias("year_first"),
        text.file_date(F.concat(F.lit("readme_"), "o_orderpriority", F.lit(".txt")), "yyyyMMdd").alias("absent"),
    )


@query(
    "f21_coalesce",
    """SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(CASE WHEN l_quantity > 40 THEN l_quantity END, CASE WHEN l_discount > 0.05 THEN l_discount END,
              CASE WHEN l_tax > 0.04 THEN l_tax END, 0) AS units FROM lineitem""",
)
def f21(t: Tables) -> DataFrame:
    units = F.coalesce(
        F.when(F.col("l_quantity") > 40, F.col("l_quantity")),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")),
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")),
        F.lit(0.0),
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", units.alias("units"))


@query(
    "f22_recode",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Green' WHEN 'error' THEN 'Red' ELSE event_type END AS label,
              CASE WHEN event_type = 'view' THEN 'unknown' ELSE event_type END AS filled FROM events""",
)
def f22(t: Tables) -> DataFrame:
    blank = F.when(F.col("event_type") == "view", "  ").otherwise(F.col("event_type"))
    return t.events.select(
        "event_id",
        text.recode("event_type", {"click": "Green", "error": "Red"}).alias("label"),
        text.blank_to(blank).alias("filled"),
    )


@query(
    "f23_fill_by_type",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS event_type, CASE WHEN value < 10 THEN 0 ELSE value END AS value,
              CASE WHEN event_type = 'click' THEN 0 ELSE user_id END AS user_id FROM events""",
)
def f23(t: Tables) -> DataFrame:
    gaps = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id"),
    )
    return gaps.fillna(values.fill_values(gaps))


@query(
    "f24_any_missing",
    "SELECT event_id, event_type = 'error' OR value < 10 AS incomplete FROM events",
)
def f24(t: Tables) -> DataFrame:
    gaps = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"),
    )
    return gaps.select("event_id", values.any_missing(gaps).alias("incomplete"))


@query(
    "f25_hash_compare",
    "SELECT c_custkey, c_acctbal < 0 OR c_acctbal > 9000 AS changed FROM customer",
)
def f25(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, None).when(F.col("c_acctbal") > 9000, "PREMIUM").otherwise(F.col("c_mktsegment"))
    changed = values.row_hash("c_name", "c_mktsegment") != values.row_hash("c_name", segment)
    return t.customer.select("c_custkey", changed.alias("changed"))


@query(
    "f25_hash_null_move",
    "SELECT c_custkey, c_acctbal < 5000 AS changed FROM customer",
)
def f25_null_move(t: Tables) -> DataFrame:
    """A value that moves from one nullable column to the next is a change."""
    moves = F.col("c_acctbal") < 5000
    none = F.lit(None).cast("string")
    before = F.col("c_mktsegment"), none
    after = F.when(moves, none).otherwise(before[0]), F.when(moves, before[0])
    return t.customer.select("c_custkey", (values.row_hash(*before) != values.row_hash(*after)).alias("changed"))


@query(
    "f26_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * 1000000 / 1073741824, 2) AS gib, CAST(ceil(l_quantity / 3) AS BIGINT) AS thirds,
              l_partkey % 7 AS rest, CAST(floor(l_linenumber * 100 / 7) AS INTEGER) AS pct FROM lineitem""",
)
def f26(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        values.gib(F.col("l_extendedprice") * 1000000).alias("gib"),
        F.ceil(F.col("l_quantity") / 3).alias("thirds"),
        F.pmod("l_partkey", F.lit(7)).alias("rest"),
        values.whole_percent("l_linenumber", F.lit(7)).alias("pct"),
    )


@query(
    "f27_number_prefix",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS year_no, CAST(NULL AS INTEGER) AS absent FROM orders WHERE year(o_orderdate) >= 1998",
)
def f27(t: Tables) -> DataFrame:
    period = F.date_format("o_orderdate", "yyyy-MM")
    return t.orders.select(
        "o_orderkey", values.number_prefix(period, 4).alias("year_no"), values.number_prefix("o_orderstatus", 4).alias("absent")
    ).filter("year_no >= 1998")
