"""Queries over dimensions and facts.

The dimension holds the customers without debts, some with a closed earlier version. The staging
set holds all but the richest customers, some with a changed or missing segment.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import recode
from tidemark.operators import dimensions as dims
from tidemark.operators import facts
from tidemark.operators.dimensions import History
from tidemark.operators.windows import number_rows
from tidemark.plans.registry import Tables, query
from tidemark.session import scratch

AS_OF = dt.datetime(2024, 6, 1, 12, 0)
FAR = dt.date(9999, 12, 31)
BEGIN, EARLIER = dt.datetime(2020, 1, 1), dt.datetime(2019, 1, 1)


def _staged(t: Tables) -> DataFrame:
    segment = (
        F.when(F.col("c_acctbal") > 9000, "PREMIUM")
        .when(F.col("c_acctbal").between(8000, 8500), F.lit(None))
        .otherwise(F.col("c_mktsegment"))
    )
    staged = t.customer.filter("c_acctbal < 9500")
    return staged.select("c_custkey", "c_name", "c_nationkey", segment.alias("c_mktsegment"))


_STAGED = """stg AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal > 9000 THEN 'PREMIUM'
                     WHEN c_acctbal BETWEEN 8000 AND 8500 THEN NULL ELSE c_mktsegment END AS c_mktsegment
              FROM customer WHERE c_acctbal < 9500)"""
_KNOWN = "known AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0)"


def _known(t: Tables) -> DataFrame:
    return t.customer.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query(
    "d1_scd1",
    f"""WITH {_KNOWN}, {_STAGED}
        SELECT COALESCE(s.c_custkey, k.c_custkey) AS c_custkey, COALESCE(s.c_name, k.c_name) AS c_name,
               COALESCE(s.c_nationkey, k.c_nationkey) AS c_nationkey,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE k.c_mktsegment END AS c_mktsegment
        FROM known k FULL JOIN stg s ON k.c_custkey = s.c_custkey""",
)
def d1(t: Tables) -> DataFrame:
    return dims.scd1(_known(t), _staged(t), ["c_custkey"])


@query(
    "d1_scd1_keep_and_drop",
    f"""WITH {_KNOWN}, {_STAGED}
        SELECT s.c_custkey, COALESCE(k.c_name, s.c_name) AS c_name, COALESCE(k.c_nationkey, s.c_nationkey) AS c_nationkey,
               CASE WHEN k.c_custkey IS NOT NULL THEN k.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
        FROM stg s LEFT JOIN known k ON k.c_custkey = s.c_custkey""",
)
def d1_quirks(t: Tables) -> DataFrame:
    return dims.scd1(_known(t), _staged(t), ["c_custkey"], matched="keep_target", unmatched="drop")


_CONTROL = (
    "load_type string, source_table string, source_column string, is_key string, is_auto string, target_table string, "
    "target_column string, is_tracked string"
)


def _control(t: Tables, kinds: tuple[str, str] = ("SCD2", "SCD2")) -> DataFrame:
    def rows(load: str, source: str, target: str, prefix: str, columns: list[tuple[str, str, str]]):
        out = [(load, "", "", "", "Y", target, "row_key", "")]
        return out + [(load, source, f"{prefix}_{c}", key, "", target, c, tracked) for c, key, tracked in columns]

    customer = [("custkey", "Y", ""), ("name", "", ""), ("nationkey", "", "Y"), ("mktsegment", "", "Y")]
    supplier = [("suppkey", "Y", ""), ("name", "", ""), ("nationkey", "", "Y")]
    data = rows(kinds[0], "stg.customer", "dim.customer", "c", customer)
    data += rows(kinds[1], "stg.supplier", "dim.supplier", "s", supplier)
    return t.spark.createDataFrame(data, _CONTROL)


def _plain(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[c.removeprefix(prefix) for c in df.columns])


@query(
    "d2_scd1_from_control",
    f"""WITH {_KNOWN}, {_STAGED}, m AS (
          SELECT k.c_custkey AS old, COALESCE(s.c_custkey, k.c_custkey) AS custkey, COALESCE(s.c_name, k.c_name) AS name,
                 COALESCE(s.c_nationkey, k.c_nationkey) AS nationkey,
                 CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE k.c_mktsegment END AS mktsegment
          FROM known k FULL JOIN stg s ON k.c_custkey = s.c_custkey)
        SELECT CASE WHEN old IS NOT NULL THEN old + 5 ELSE (SELECT MAX(c_custkey) + 5 FROM known)
                    + row_number() OVER (PARTITION BY old IS NULL ORDER BY custkey) END AS row_key, custkey, name, nationkey, mktsegment FROM m""",
)
def d2(t: Tables) -> DataFrame:
    dim = _plain(_known(t), "c_").select((F.col("custkey") + 5).alias("row_key"), "*")
    return dims.scd1_from_control(dim, _staged(t), _control(t, ("SCD1", "SCD1")), "dim.customer")


def _versions(t: Tables, open_end: dt.date | None) -> DataFrame:
    known = _known(t)
    opened = known.select("*", dims.moment(BEGIN).alias("start_date"), dims.moment(open_end).alias("end_date"))
    old = t.customer.filter("c_acctbal > 5000").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.lit("EARLIER").alias("c_mktsegment"),
        dims.moment(EARLIER).alias("start_date"),
        dims.moment(BEGIN).alias("end_date"),
    )
    return opened.unionByName(old)


def _scd2_sql(open_end: str, active: bool = False) -> str:
    flag = (lambda v: f", '{v}' AS active_status") if active else (lambda v: "")
    kept = ", CASE WHEN changed THEN 'N' ELSE 'Y' END AS active_status" if active else ""
    return f"""WITH {_KNOWN}, {_STAGED},
      met AS (SELECT k.*, s.c_custkey IS NOT NULL AND (s.c_mktsegment IS DISTINCT FROM k.c_mktsegment OR s.c_nationkey IS DISTINCT FROM k.c_nationkey) AS changed
              FROM known k LEFT JOIN stg s ON k.c_custkey = s.c_custkey)
      SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '2020-01-01' AS start_date,
             CASE WHEN changed THEN TIMESTAMP '2024-06-01 12:00:00' ELSE {open_end} END AS end_date{kept} FROM met
      UNION ALL SELECT c_custkey, c_name, c_nationkey, 'EARLIER', TIMESTAMP '2019-01-01', TIMESTAMP '2020-01-01'{flag('N')} FROM customer WHERE c_acctbal > 5000
      UNION ALL SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_mktsegment, TIMESTAMP '2024-06-01 12:00:00', {open_end}{flag('Y')}
      FROM stg s LEFT JOIN met ON met.c_custkey = s.c_custkey WHERE met.c_custkey IS NULL OR met.changed"""


_NULL_END, _FAR_END = "CAST(NULL AS TIMESTAMP)", "TIMESTAMP '9999-12-31'"
_TRACKED = ["c_mktsegment", "c_nationkey"]


@query("d3_scd2_merge", _scd2_sql(_NULL_END))
def d3(t: Tables) -> DataFrame:
    return dims.scd2(_versions(t, None), _staged(t), ["c_custkey"], _TRACKED, AS_OF)


@query("d4_scd2_far_end", _scd2_sql(_FAR_END))
def d4(t: Tables) -> DataFrame:
    return dims.scd2(_versions(t, FAR), _staged(t), ["c_custkey"], _TRACKED, AS_OF, history=History(open_end=FAR))


@query("d5_scd2_hash_and_flag", _scd2_sql(_FAR_END, active=True))
def d5(t: Tables) -> DataFrame:
    flagged = _versions(t, FAR)
    open_row = F.col("end_date") == dims.moment(FAR)
    flagged = flagged.withColumn("active_status", F.when(open_row, "Y").otherwise("N"))
    history = History(open_end=FAR, active="active_status")
    return dims.scd2(flagged, _staged(t), ["c_custkey"], _TRACKED, AS_OF, history=history, by_hash=True)


@query(
    "d5_scd2_hash_null_move",
    """SELECT c_custkey, c_mktsegment AS home, CAST(NULL AS VARCHAR) AS away, CASE WHEN c_acctbal < 5000 THEN TIMESTAMP '2024-06-01 12:00:00' END AS end_date FROM customer
       UNION ALL SELECT c_custkey, NULL, c_mktsegment, NULL FROM customer WHERE c_acctbal < 5000""",
)
def d5_null_move(t: Tables) -> DataFrame:
    """A value that moves from one nullable column to the other opens a new version."""
    none, moves = F.lit(None).cast("string"), F.col("c_acctbal") < 5000
    dim = t.customer.select(
        "c_custkey", F.col("c_mktsegment").alias("home"), none.alias("away"), dims.moment(BEGIN).alias("start_date"), dims.moment(None).alias("end_date")
    )
    home = F.col("c_mktsegment")
    staged = t.customer.select("c_custkey", F.when(~moves, home).alias("home"), F.when(moves, home).alias("away"))
    merged = dims.scd2(dim, staged, ["c_custkey"], ["home", "away"], AS_OF, by_hash=True)
    return merged.select("c_custkey", "home", "away", "end_date")


_KEYLESS_SQL = """SELECT c_custkey, c_mktsegment, 'old' AS state FROM customer WHERE c_acctbal >= 5000
       UNION ALL SELECT c_custkey, c_mktsegment, 'new' FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 5000
       UNION ALL SELECT NULL, c_mktsegment, 'rejected' FROM customer WHERE c_acctbal < 0"""


@query("d1_null_keys", _KEYLESS_SQL)
def d1_null_keys(t: Tables) -> DataFrame:
    """Staged rows without a key are rejected, however many and different they are; a second run adds nothing."""
    dim = t.customer.filter("c_acctbal >= 5000").select("c_custkey", "c_mktsegment", F.lit("old").alias("state"))
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("c_custkey")
    state = F.when(F.col("c_acctbal") >= 5000, "old").otherwise("new").alias("state")
    staged = t.customer.select(key, "c_mktsegment", state)
    twice = dims.scd1(dims.scd1(dim, staged, ["c_custkey"]), staged, ["c_custkey"])
    rejected = dims.rejected_rows(staged, ["c_custkey"]).withColumn("state", F.lit("rejected"))
    return twice.unionByName(rejected)


@query("d6_scd2_static", _scd2_sql(_NULL_END))
def d6(t: Tables) -> DataFrame:
    return dims.scd2_static(_versions(t, None), _staged(t), ["c_custkey"], _TRACKED, AS_OF)


@query(
    "d7_scd2_from_control",
    f"""WITH {_KNOWN}, {_STAGED},
      met AS (SELECT k.*, s.c_custkey IS NOT NULL AND (s.c_mktsegment IS DISTINCT FROM k.c_mktsegment OR s.c_nationkey IS DISTINCT FROM k.c_nationkey) AS changed
              FROM known k LEFT JOIN stg s ON k.c_custkey = s.c_custkey),
      fresh AS (SELECT s.* FROM stg s LEFT JOIN met ON met.c_custkey = s.c_custkey WHERE met.c_custkey IS NULL OR met.changed),
      stg2 AS (SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN 0 ELSE s_nationkey END AS nation FROM supplier),
      changed2 AS (SELECT s_suppkey, stg2.s_name, nation FROM supplier JOIN stg2 USING (s_suppkey) WHERE nation <> s_nationkey)
      SELECT 'customer' AS dim, c_custkey AS id, c_custkey AS row_key, CASE WHEN changed THEN TIMESTAMP '2024-06-01 12:00:00' END AS end_date FROM met
      UNION ALL SELECT 'customer', c_custkey, (SELECT MAX(c_custkey) FROM known) + row_number() OVER (ORDER BY c_custkey), NULL FROM fresh
      UNION ALL SELECT 'supplier', s_suppkey, s_suppkey, CASE WHEN s_suppkey IN (SELECT s_suppkey FROM changed2) THEN TIMESTAMP '2024-06-01 12:00:00' END FROM supplier
      UNION ALL SELECT 'supplier', s_suppkey, (SELECT MAX(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY s_suppkey), NULL FROM changed2""",
)
def d7(t: Tables) -> DataFrame:
    return _both_dims(t, ("SCD2", "SCD2"), dims.scd2_from_control)


def _both_dims(t: Tables, kinds: tuple[str, str], load) -> DataFrame:
    def dim(rows: DataFrame, prefix: str, key: str) -> DataFrame:
        plain = _plain(rows, prefix)
        return plain.select(
            F.col(key).alias("row_key"), "*", dims.moment(BEGIN).alias("start_date"), dims.moment(None).alias("end_date")
        )

    suppliers = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    moved = t.supplier.select(
        "s_suppkey", "s_name", F.when(F.col("s_acctbal") < 0, 0).otherwise(F.col("s_nationkey")).alias("s_nationkey")
    )
    targets = {"dim.customer": dim(_known(t), "c_", "custkey"), "dim.supplier": dim(suppliers, "s_", "suppkey")}
    merged = load(targets, {"stg.customer": _staged(t), "stg.supplier": moved}, _control(t, kinds), AS_OF)
    return (
        merged["dim.customer"]
        .select(F.lit("customer").alias("dim"), F.col("custkey").alias("id"), "row_key", "end_date")
        .unionByName(
            merged["dim.supplier"].select(F.lit("supplier").alias("dim"), F.col("suppkey").alias("id"), "row_key", "end_date")
        )
    )


@query(
    "d7_load_by_control",
    f"""WITH {_KNOWN}, {_STAGED},
      m AS (SELECT k.c_custkey AS old, COALESCE(s.c_custkey, k.c_custkey) AS custkey FROM known k FULL JOIN stg s ON k.c_custkey = s.c_custkey),
      changed2 AS (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0 AND s_nationkey <> 0)
      SELECT 'customer' AS dim, custkey AS id, CASE WHEN old IS NOT NULL THEN old ELSE (SELECT MAX(c_custkey) FROM known)
                    + row_number() OVER (PARTITION BY old IS NULL ORDER BY custkey) END AS row_key, CAST(NULL AS TIMESTAMP) AS end_date FROM m
      UNION ALL SELECT 'supplier', s_suppkey, s_suppkey, CASE WHEN s_suppkey IN (SELECT s_suppkey FROM changed2) THEN TIMESTAMP '2024-06-01 12:00:00' END FROM supplier
      UNION ALL SELECT 'supplier', s_suppkey, (SELECT MAX(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY s_suppkey), NULL FROM changed2""",
)
def d7_mixed(t: Tables) -> DataFrame:
    """Customers by type 1 and suppliers by type 2, as the control rows say."""
    return _both_dims(t, ("SCD1", "SCD2"), dims.load_by_control)


@query(
    "d8_merge",
    """WITH agg AS (SELECT o_custkey AS c_custkey, COUNT(*) AS n, MAX(o_totalprice) AS top FROM orders GROUP BY 1 HAVING MAX(o_totalprice) > 300000),
            tgt AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'MACHINERY')
       SELECT COALESCE(tgt.c_custkey, agg.c_custkey) AS c_custkey, CASE WHEN tgt.c_custkey IS NULL THEN 'new ' || n ELSE c_name END AS c_name,
              CASE WHEN tgt.c_custkey IS NULL THEN top WHEN agg.c_custkey IS NULL THEN c_acctbal WHEN c_acctbal < 0 THEN 0 ELSE top END AS c_acctbal
       FROM tgt FULL JOIN agg ON tgt.c_custkey = agg.c_custkey""",
)
def d8(t: Tables) -> DataFrame:
    target = t.customer.filter("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_name", "c_acctbal")
    source = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
        .filter("top > 300000")
    )
    return dims.merge(
        target,
        source,
        ["c_custkey"],
        update={"c_acctbal": F.when(F.col("t.c_acctbal") < 0, 0).otherwise(F.col("s.top"))},
        insert={
            "c_custkey": F.col("s.c_custkey"),
            "c_name": F.concat(F.lit("new "), F.col("s.n").cast("string")),
            "c_acctbal": F.col("s.top"),
        },
    )


@query(
    "d8_update_from_join",
    """SELECT p_partkey, CASE WHEN q IS NULL THEN p_retailprice ELSE q END AS p_retailprice FROM part
       LEFT JOIN (SELECT l_partkey, MAX(l_extendedprice) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_partkey = p_partkey""",
)
def d8_update(t: Tables) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
    source = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(returned).alias("q"))
    price = F.coalesce(F.col("s.q"), F.col("t.p_retailprice"))
    return dims.merge(t.part.select("p_partkey", "p_retailprice"), source, ["p_partkey"], update={"p_retailprice": price})


@query(
    "d9_surrogate_keys",
    """SELECT o_orderkey, (SELECT MAX(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_key FROM orders""",
)
def d9(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    keyed = dims.assign_keys(rows, ["o_totalprice", "o_orderkey"], "row_key", start=dims.next_key(t.customer, "c_custkey"))
    return keyed.select("o_orderkey", "row_key")


@query(
    "d10_date_dim",
    """SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, dayname(d) AS day_name, CAST(day(d) AS INTEGER) AS day_of_month,
              CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month,
              monthname(d) AS month_name, 'Q' || quarter(d) AS quarter, CAST(year(d) AS INTEGER) AS year
       FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1994-06-01', TIMESTAMP '2004-05-08', INTERVAL 1 DAY)) AS DATE) AS d)
       WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 250000)""",
)
def d10(t: Tables) -> DataFrame:
    existing = t.orders.filter("o_totalprice > 250000").select(F.to_date("o_orderdate").alias("date"))
    return dims.date_dim(t.spark, dt.date(1994, 6, 1), 3630, existing)


def _email(name: str, last: str) -> F.Column:
    return F.lower(F.concat(F.replace(F.col(name), F.lit("#"), F.lit(".")), F.lit("@"), F.col(last), F.lit(".com")))


@query(
    "d11_person_dim",
    """WITH mails AS (SELECT lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' AS email, split_part(c_name, '#', 2) AS last_name, 'Customer' AS first_name,
                             c_acctbal FROM customer)
       SELECT DISTINCT first_name, last_name, email FROM mails WHERE c_acctbal >= 1000
       UNION SELECT 'Supplier', split_part(s_name, '#', 2), lower(replace(s_name, '#', '.')) || '@shop.com' FROM supplier""",
)
def d11(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    sellers = F.lower(F.concat(F.replace("s_name", F.lit("#"), F.lit(".")), F.lit("@shop.com")))
    staged = t.customer.select(_email("c_name", "c_mktsegment").alias("employee_email"), none.alias("view_email")).unionByName(
        t.supplier.select(none.alias("employee_email"), sellers.alias("view_email"))
    )
    existing = t.customer.filter("c_acctbal < 1000").select(_email("c_name", "c_mktsegment").alias("email"))
    return dims.person_dim(staged, ["employee_email", "view_email"], existing)


def _journal(t: Tables) -> DataFrame:
    """One journal text per page: project, rich-text body, and for some a status."""
    host = F.split_part(F.split_part("url", F.lit("/"), F.lit(3)), F.lit("."), F.lit(1))
    secure = F.startswith("url", F.lit("https"))
    status = F.when(secure, F.concat(F.lit("Service Health RAG "), F.when(F.contains("url", F.lit("?")), "Amber").otherwise("Green")))
    updates = F.concat(
        F.lit("Service "), host, F.lit("\r\n -Update "), "html", F.coalesce(status, F.lit(""))
    )
    return t.pages.select(
        "page_id",
        updates.alias("updates"),
        F.expr("timestamp_ntz'2024-03-01 09:00:00' + make_dt_interval(CAST(page_id DIV 40 AS INT), CAST(page_id % 7 AS INT))").alias("submitted_time"),
        F.concat(host, F.lit(".writer@example.com")).alias("employee_email"),
        F.concat(F.lit("chief."), F.substring(host, 1, 1), F.lit("@example.com")).alias("view_email"),
    )


_HOST = "split_part(split_part(url, '/', 3), '.', 1)"
_STATUS = "CASE WHEN url LIKE 'https%' THEN CASE WHEN url LIKE '%?%' THEN 'Amber' ELSE 'Green' END ELSE 'unknown' END"


@query(
    "d12_text_dim",
    f"SELECT DISTINCT 'project' AS kind, ' ' || {_HOST} AS name FROM pages UNION ALL SELECT DISTINCT 'status', {_STATUS} FROM pages WHERE {_STATUS} <> 'Green'",
)
def d12(t: Tables) -> DataFrame:
    green = t.pages.filter("url LIKE 'https%' AND url NOT LIKE '%?%'").select("page_id")
    known = _journal(t).join(green, "page_id", "left_semi").select(facts.journal_status("updates").alias("name"))
    projects = dims.text_dim(_journal(t), facts.journal_project("updates"), "name")
    statuses = dims.text_dim(_journal(t), facts.journal_status("updates"), "name", known)
    return projects.select(F.lit("project").alias("kind"), "name").unionByName(statuses.select(F.lit("status").alias("kind"), "name"))


@query(
    "d13_ensure_rows",
    """SELECT event_type AS name, CASE event_type WHEN 'click' THEN 'Good, expectations are being met.' ELSE 'none' END AS description FROM events GROUP BY 1
       UNION ALL SELECT 'Red', 'Poor, requires intervention'""",
)
def d13(t: Tables) -> DataFrame:
    dim = t.events.select(F.col("event_type").alias("name"), F.lit("none").alias("description")).distinct()
    seeded = dims.ensure_rows(
        dim, [{"name": "Red", "description": "Poor, requires intervention"}, {"name": "click", "description": "seed"}], ["name"]
    )
    text = recode("name", {"click": "Good, expectations are being met."}, F.col("description"))
    return seeded.withColumn("description", text)


def _fact_lookups(t: Tables) -> list[facts.Lookup]:
    part = t.part.select("p_partkey", (F.col("p_partkey") + 100000).alias("part_key"))
    supplier = t.supplier.select("s_suppkey", "s_acctbal", (F.col("s_suppkey") + 200000).alias("supplier_key"))
    order = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_key"))
    return [
        facts.Lookup(part, {"l_partkey": "p_partkey"}, "part_key", "fk_part"),
        facts.Lookup(supplier, {"l_suppkey": "s_suppkey"}, "supplier_key", "fk_supplier", current=F.col("s_acctbal") >= 0),
        facts.Lookup(order, {"l_orderkey": "o_orderkey"}, "customer_key", "fk_customer"),
    ]


def _fact(t: Tables, unmatched: str) -> DataFrame:
    loaded = t.lineitem.filter("l_shipdate < timestamp_ntz'1998-01-01'")
    return facts.load_fact(
        t.lineitem,
        _fact_lookups(t),
        loaded,
        ["l_orderkey", "l_linenumber"],
        ["l_quantity", "l_extendedprice"],
        unmatched=unmatched,
        as_of=AS_OF,
    )


def _fact_sql(supplier: str, rule: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey + 100000 AS fk_part, {supplier} AS fk_supplier, o_custkey AS fk_customer,
         TIMESTAMP '2024-06-01 12:00:00' AS entry_date
       FROM lineitem a LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
       WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber AND b.l_shipdate < TIMESTAMP '1998-01-01') {rule}"""


@query("d14_load_fact", _fact_sql("s_suppkey + 200000", ""))
def d14(t: Tables) -> DataFrame:
    return _fact(t, "keep")


@query("d14_load_fact_unknown", _fact_sql("COALESCE(s_suppkey + 200000, -1)", ""))
def d14_unknown(t: Tables) -> DataFrame:
    return _fact(t, "unknown")


@query("d14_load_fact_drop", _fact_sql("s_suppkey + 200000", "AND s_suppkey IS NOT NULL"))
def d14_drop(t: Tables) -> DataFrame:
    return _fact(t, "drop")


def _body_sql() -> str:
    from tidemark.functions.text import RICH_TEXT_TOKENS

    out = "html"
    for token, value in RICH_TEXT_TOKENS:
        out = f"replace({out}, '{token}', '{value}')"
    return f"trim({out})"


_TIME = "TIMESTAMP '2024-03-01 09:00:00' + to_days(CAST(page_id // 40 AS INTEGER)) + to_hours(CAST(page_id % 7 AS INTEGER))"


@query(
    "d15_journal_fact",
    f"""WITH p AS (SELECT page_id, {_HOST} AS host, {_STATUS} AS status, {_body_sql()} AS body, {_TIME} AS sent, url, html FROM pages),
             projects AS (SELECT host, row_number() OVER (ORDER BY host) AS id FROM (SELECT DISTINCT host FROM p)),
             statuses AS (SELECT status, row_number() OVER (ORDER BY status) AS id FROM (SELECT DISTINCT status FROM p))
        SELECT DISTINCT body AS updates, sent AS submitted_time,
               'Service ' || p.host || chr(13) || chr(10) || ' -Update ' || html || CASE WHEN status = 'unknown' THEN '' ELSE 'Service Health RAG ' || status END AS updates_rich_text,
               CAST(strftime(sent, '%Y%m%d') AS INTEGER) AS fk_date, projects.id AS fk_project, projects.id AS fk_employee, CAST(ascii(p.host) AS BIGINT) AS fk_viewer, statuses.id AS fk_status
        FROM p JOIN projects ON projects.host = p.host JOIN statuses USING (status)
        WHERE NOT (p.url LIKE '%#%')""",
)
def d15(t: Tables) -> DataFrame:
    staged = facts.journal_rows(_journal(t))
    projects = number_rows(dims.text_dim(staged, F.col("_project"), "project_name"), ["project_name"], "project_id", unique=True)
    statuses = number_rows(dims.text_dim(staged, F.col("_status"), "status_name"), ["status_name"], "status_id", unique=True)
    writers = projects.select(
        F.concat(F.trim("project_name"), F.lit(".writer@example.com")).alias("email"), F.col("project_id").alias("person_id")
    )
    readers = staged.select(F.col("view_email").alias("email"), F.ascii(F.substring("view_email", 7, 1)).cast("bigint").alias("person_id")).distinct()
    first, last = staged.agg(F.min("_date"), F.max("_date")).first()
    days = (last - first).days + 1 if first else 0
    calendar = dims.date_dim(t.spark, first or dt.date(2024, 1, 1), days)
    loaded = staged.join(t.pages.filter(F.contains("url", F.lit("#"))), "page_id", "left_semi").select("_key", "submitted_time")
    return facts.load_journal_fact(staged, calendar, projects, writers.unionByName(readers), statuses, loaded)


_CONFIG = "table_name string, watermark timestamp_ntz"


def _config(t: Tables) -> DataFrame:
    rows = [("orders", dt.datetime(1998, 1, 1)), ("events", dt.datetime(2030, 1, 1)), ("returns", dt.datetime(1999, 1, 1))]
    return t.spark.createDataFrame(rows, _CONFIG)


@query("d16_incremental_extract", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def d16(t: Tables) -> DataFrame:
    return facts.incremental_extract(t.orders, "o_orderdate", dt.datetime(1998, 1, 1))


@query("d16_incremental_strict", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def d16_strict(t: Tables) -> DataFrame:
    return facts.incremental_extract(t.orders, "o_orderdate", dt.datetime(1998, 1, 1), strict=True)


@query(
    "d16_advance_watermark",
    """SELECT 'orders' AS table_name, (SELECT MAX(o_orderdate) FROM orders) AS watermark
       UNION ALL SELECT 'events', TIMESTAMP '2030-01-01' UNION ALL SELECT 'returns', TIMESTAMP '1999-01-01'""",
)
def d16_advance(t: Tables) -> DataFrame:
    observed = facts.observed_watermark("orders", facts.incremental_extract(t.orders, "o_orderdate", dt.datetime(1998, 1, 1)), "o_orderdate")
    observed = observed.unionByName(facts.observed_watermark("events", t.events, "ts"))
    return facts.advance_watermark(_config(t), observed)


def _run_config(t: Tables) -> DataFrame:
    rows = [
        ("orders", "o_orderdate", dt.datetime(1998, 1, 1)),
        ("lineitem", "l_shipdate", dt.datetime(1997, 6, 15)),
        ("events", "ts", dt.datetime(2030, 1, 1)),
        ("returns", "r_date", dt.datetime(1999, 1, 1)),  # no such table: its extract fails
    ]
    return t.spark.createDataFrame(rows, "table_name string, incremental_column string, watermark timestamp_ntz")


@query(
    "d16_run_from_config",
    """WITH n AS (SELECT 'orders' AS table_name, COUNT(*) AS rows_copied, MAX(o_orderdate)::TIMESTAMP AS w, TIMESTAMP '1998-01-01' AS old FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
       UNION ALL SELECT 'lineitem', COUNT(*), MAX(l_shipdate)::TIMESTAMP, TIMESTAMP '1997-06-15' FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-15'
       UNION ALL SELECT 'events', COUNT(*), MAX(ts)::TIMESTAMP, TIMESTAMP '2030-01-01' FROM events WHERE ts >= TIMESTAMP '2030-01-01')
       SELECT table_name, 'Succeeded' AS status, rows_copied, COALESCE(w, old) AS watermark FROM n
       UNION ALL SELECT 'returns', 'Failed', 0, TIMESTAMP '1999-01-01'""",
)
def d16_run(t: Tables) -> DataFrame:
    config, out = _run_config(t), scratch(t.spark, "extracts")
    log = facts.run_extracts(t.spark, config, lambda name: getattr(t, name), out)
    facts.commit_watermarks(config, log, f"{out}-config")
    now = facts.committed_config(t.spark, f"{out}-config").select("table_name", "watermark")
    return log.select("table_name", "status", "rows_copied").join(now, "table_name").select("table_name", "status", "rows_copied", "watermark")


@query(
    "d16_extracted_rows",
    """SELECT o_orderkey AS id, o_orderdate::TIMESTAMP AS at FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def d16_rows(t: Tables) -> DataFrame:
    """The rows that the run wrote for one table, read back."""
    log = facts.run_extracts(t.spark, _run_config(t).filter("table_name = 'orders'"), lambda name: getattr(t, name), scratch(t.spark, "extracts"))
    rows = t.spark.read.schema(t.orders.schema).parquet(log.first()["path"])
    return rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"))


@query(
    "d17_run_from_config",
    """SELECT 'orders' AS table_name, COUNT(*) AS rows_copied FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'
       UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-12-31'""",
)
def d17_run(t: Tables) -> DataFrame:
    rows = [
        ("orders", "o_orderdate", dt.datetime(1996, 3, 1), dt.datetime(1997, 2, 28)),
        ("lineitem", "l_shipdate", dt.datetime(1995, 1, 1), dt.datetime(1995, 12, 31)),
    ]
    config = t.spark.createDataFrame(rows, "table_name string, incremental_column string, range_start timestamp_ntz, range_end timestamp_ntz")
    return facts.run_extracts(t.spark, config, lambda name: getattr(t, name), scratch(t.spark, "extracts")).select("table_name", "rows_copied")


_STAGED_ORDERS = "(SELECT o_custkey AS k, o_orderdate AS d, o_orderkey AS id, o_orderstatus AS s FROM orders)"


@query(
    "d14_staged_duplicates",
    f"""WITH top AS (SELECT *, d = MAX(d) OVER (PARTITION BY k) AS is_top FROM {_STAGED_ORDERS}),
        n AS (SELECT k, COUNT(*) AS n FROM top WHERE is_top GROUP BY k)
        SELECT top.k, id, 'loaded' AS verdict FROM top JOIN n USING (k) WHERE is_top AND n = 1
        UNION ALL SELECT top.k, id, 'rejected' FROM top JOIN n USING (k) WHERE n > 1""",
)
def d14_duplicates(t: Tables) -> DataFrame:
    """Staged orders by customer: the newest loads; where two share the newest day all are rejected."""
    staged = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("d"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"))
    settled, rejected = facts.settle_staged(staged, ["k"], ["d"])
    return settled.select("k", "id", F.lit("loaded").alias("verdict")).unionByName(rejected.select("k", "id", F.lit("rejected").alias("verdict")))


@query("d17_range_extract", "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'")
def d17(t: Tables) -> DataFrame:
    return facts.range_extract(t.orders, "o_orderdate", dt.date(1996, 3, 1), dt.date(1997, 2, 28))


@query(
    "d24_flatten_people",
    """SELECT 'Customer' AS first_name, c_name AS last_name, c_mktsegment || '@x.com' AS email FROM customer WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'Nation', CAST(c_nationkey AS VARCHAR), 'n@x.com' FROM customer""",
)
def d24(t: Tables) -> DataFrame:
    def person(first, last, email):
        return F.struct(first.alias("FirstName"), last.alias("LastName"), email.alias("EmailID"))

    last = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name"))
    a = person(F.lit("Customer"), last, F.concat("c_mktsegment", F.lit("@x.com")))
    b = person(F.lit("Nation"), F.col("c_nationkey").cast("string"), F.lit("n@x.com"))
    key = F.concat(F.lit("rec_"), F.col("c_custkey").cast("string"))
    record = F.create_map(key, F.array(a, b))
    body = F.to_json(F.struct(F.struct(F.array(record).alias("result")).alias("response")))
    return facts.flatten_people(t.customer.select(body.alias("body")))
