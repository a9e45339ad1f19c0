"""Versioned tables, load logs, lineage, query texts, quality checks and marts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.compare import explained, spark_rows
from tidemark.functions import text
from tidemark.operators import joins, lineage, loadlog, projections, quality, querylog, versioned
from tidemark.plans.catalog import queries

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def log(spark):
    base = versioned.convert(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string"), T0)
    changed = versioned.log_update(base, ["id"], F.col("id") == 1, {"v": F.lit("z")}, 1, T0 + dt.timedelta(1))
    return versioned.log_delete(changed, ["id"], F.col("v") == "b", 2, T0 + dt.timedelta(2))


def table(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_old_versions_stay_readable(log):
    assert table(versioned.as_of(log, ["id"])) == {1: "z", 3: None}
    assert table(versioned.as_of(log, ["id"], version=0)) == {1: "a", 2: "b", 3: None}
    assert table(versioned.as_of(log, ["id"], ts=T0 + dt.timedelta(hours=30))) == {1: "z", 2: "b", 3: None}


def test_before_the_first_version_is_an_error(log):
    with pytest.raises(ValueError, match="no version"):
        versioned.as_of(log, ["id"], ts=T0 - dt.timedelta(1))
    with pytest.raises(ValueError, match="no version"):
        versioned.as_of(log, ["id"], version=-1)
    with pytest.raises(ValueError, match="vacuumed"):
        versioned.as_of(log, ["id"], ts=T0, oldest=T0 + dt.timedelta(1))


def test_restore_keeps_history(log):
    back = versioned.restore(log, ["id"], 0, 3, T0 + dt.timedelta(3))
    assert table(versioned.as_of(back, ["id"])) == {1: "a", 2: "b", 3: None}
    assert table(versioned.as_of(back, ["id"], version=2)) == {1: "z", 3: None}
    assert {(r["_version"], r["_op"]): r["n_rows"] for r in versioned.history(back).collect()} == {
        (0, "I"): 3, (1, "U"): 1, (2, "D"): 1, (3, "U"): 1, (3, "I"): 1,
    }


def test_vacuum_keeps_what_is_readable(log):
    now = T0 + dt.timedelta(days=8, hours=12)
    kept = versioned.vacuum(log, ["id"], now)
    gone = versioned.vacuum(log, ["id"], now, dry_run=True)
    assert table(versioned.as_of(kept, ["id"])) == {1: "z", 3: None}
    assert [(r["id"], r["v"]) for r in gone.collect()] == [(1, "a")]
    assert kept.count() + gone.count() == log.count()


def test_delete_keeps_rows_with_a_null_condition(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    assert table(versioned.delete_where(df, F.col("v") == "x")) == {1: None}
    assert versioned.delete_where(df).count() == 0


def test_shared_walks_match_a_walk_for_each_root(spark):
    """Random graphs with cycles through roots, roots with equal views below them, tables, and unknown roots."""
    rng = random.Random(4)
    names = [f"n{k}" for k in range(14)]
    edges = {(rng.choice(names), rng.choice(names), rng.choice(["VIEW", "VIEW", "TABLE"])) for _ in range(30)}
    edges |= {(f"r{k}", child, "VIEW") for k in range(12) for child in (names[:2] if k % 3 else names[2:3])} | {(names[0], "r1", "VIEW"), ("r3", "n1", "TABLE")}
    roots = [f"r{k}" for k in range(12)] + names[:5] + ["absent"]
    want = set()
    for root in roots:
        level, seen, step = 0, {root: 0}, [root]
        while step:
            level += 1
            step = sorted({o for p, o, kind in edges if p in step and kind == "VIEW"} - seen.keys())
            seen |= dict.fromkeys(step, level)
        want |= {(root, p, o, kind, seen[p]) for p, o, kind in edges if p in seen}
    df = spark.createDataFrame(sorted(edges), "parent string, object string, object_type string")
    out = lineage.lineage(df, spark.createDataFrame([(r,) for r in [*roots, "r0"]], "root string")).drop("label").collect()
    assert sorted(map(tuple, out)) == sorted(want)


def test_objects_are_counted_once_for_each_parent(spark):
    rng = random.Random(5)
    names = [f"n{k}" for k in range(12)]
    edges = [(rng.choice(names), rng.choice(names), rng.choice(["VIEW", "VIEW", "TABLE"])) for _ in range(30)]
    edges += [(f"r{k}", child, "VIEW") for k in range(8) for child in (names[:2] if k % 3 else names[2:3])] + [(names[0], "r1", "VIEW"), ("r3", "n1", "TABLE")]
    df = spark.createDataFrame(edges, "parent string, object string, object_type string")
    roots = spark.createDataFrame([(r,) for r in [*(f"r{k}" for k in range(8)), *names[:4], "absent", "r0"]], "root string")
    want = lineage.objects_per_parent(lineage.lineage(df, roots)).collect()
    assert sorted(map(tuple, lineage.lineage_per_parent(df, roots).collect())) == sorted(map(tuple, want))


def test_closure_ends_on_cycles_and_is_deep(spark):
    chain = [(f"v{i}", f"v{i + 1}", "VIEW") for i in range(20)] + [("v20", "v3", "VIEW"), ("v20", "t", "TABLE"), ("x", "v20", "VIEW")]
    edges = spark.createDataFrame(chain + chain[:2], "parent string, object string, object_type string")
    out = lineage.lineage(edges, spark.createDataFrame([("v0",), ("x",), ("lonely",)], "root string"))
    rows = {(r["root"], r["parent"], r["object"]): (r["level"], r["label"]) for r in out.collect()}
    assert rows[("v0", "v0", "v1")] == (0, "DIRECT")
    assert rows[("v0", "v20", "t")] == (20, "NESTED-20")
    assert rows[("x", "v20", "t")] == (1, "NESTED-1")
    assert out.filter("root = 'v0'").count() == 22 and out.filter("root = 'lonely'").count() == 0


def test_key_texts(spark):
    df = spark.createDataFrame(
        [("LINEAR(a, b)", "['B', 'A']"), ("(a,b)", "a, b"), ("No Cluster Key", None), ("a", "b"), ("a,b", "b, c")], "l string, r string"
    )
    out = lineage.compare_keys(df, "l", "r").collect()
    assert [(r["status"], r["order_status"]) for r in out] == [
        ("Exact match", "Matched but in different order"),
        ("Exact match", "Exactly Matched and in Same Order"),
        ("No keys in either", "N/A"),
        ("No common keys", "N/A"),
        ("Partial match", "N/A"),
    ]
    assert (out[4]["in_both"], out[4]["only_left"], out[4]["only_right"]) == ("B", "A", "C")


def test_names_of_one_two_and_three_parts(spark):
    sql = "SELECT * FROM db1.s1.t1 a JOIN s2.t2 b ON a.id = b.id LEFT JOIN t3 c ON b.id = c.id"
    out = querylog.sql_references(spark.createDataFrame([(1, sql)], "query_id int, sql_text string")).collect()
    assert sorted((r["database_name"], r["schema_name"], r["object_name"]) for r in out) == [
        ("", "", "T3"), ("", "S2", "T2"), ("DB1", "S1", "T1"),
    ]


def references(spark, sql):
    out = querylog.sql_references(spark.createDataFrame([(1, sql)], "query_id int, sql_text string")).collect()
    return sorted(".".join(filter(None, (r["database_name"], r["schema_name"], r["object_name"]))) for r in out)


@pytest.mark.parametrize(
    "sql, expected",
    [
        ('select * from "Db"."My Table" join `s`.`T2` on 1 = 1 join [a b].[c.d] x on 1 = 1', ["A B.C.D", "DB.MY TABLE", "S.T2"]),
        ("select 'from lost -- ' as a, 'it''s from here' from kept -- 'join gone", ["KEPT"]),
        ("select * from (select 1 from a) a_very_long_alias_name join b on 1 = 1", ["A", "B"]),
        ("with recent as (select 1 from x), later (n) as materialized (select 2 from recent) select * from sales.recent join later", ["SALES.RECENT", "X"]),
        ("select extract(year from coalesce(t.d, now())), trim(both ' ' from n), substring(a from 2) from t, u", ["T", "U"]),
        ('select "it\'s" from t1 join t2 on a=\'x\'', ["T1", "T2"]),
        ("select a from x, y z, (select b, c from q w, r) v, s where a in (select 1 from t, u) group by a, b", ["Q", "R", "S", "T", "U", "X", "Y"]),
        ("select trim(f(g(x)) from y), overlay(a placing (select m from n) from 2) from (p join q on p.a = q.a), r", ["N", "P", "Q", "R"]),
        ("merge into w using src s on 1 = 1 when matched then update set a = 1", ["SRC"]),
        ("select a from b join c using (id), d order by a, e", ["B", "C", "D"]),
        ("select 'open from x", []),
        ("select * from srv.db.s.t join generate_series(1, 2) g on true join current_date", ["SRV.DB.S.T"]),
        ("create temp table if not exists w.tmp as select * from src; select * from tmp join tmp2", ["SRC", "TMP2"]),
        ("select * from t join T on 1 = 1 /* from c */ where a = 'x' --\n and b in (select c from d)", ["D", "T"]),
    ],
)
def test_names_in_statements(spark, sql, expected):
    assert references(spark, sql) == expected


@pytest.mark.parametrize(
    "sql, expected",
    [
        ("merge into d.w using src s on 1 = 1 when matched then update set a = 1", ["D.W"]),
        ("insert into t select 1 from u for update; update v set a = (select 1 from x)", ["T", "V"]),
        ("insert overwrite table a.b.c (d, e) select 1", []),
        ("select a into n from m", ["N"]),
    ],
)
def test_tables_that_are_written(spark, sql, expected):
    out = querylog.sql_targets(spark.createDataFrame([(1, sql)], "query_id int, sql_text string")).collect()
    got = sorted(".".join(filter(None, (r["database_name"], r["schema_name"], r["object_name"]))) for r in out)
    assert got == (expected or ["A.B.C"])


def test_statements_of_a_megabyte(spark):
    """Long arguments, long lists, deep nesting and many words cost no stack and no more than linear time."""
    inside = "select trim(" + "x" * 30_000 + " " * 30_000 + "y " * 400_000 + " from z) from t1, t2"
    listed = "create or replace " + "word " * 100_000 + "select " + ", ".join(f"f(a{k})" for k in range(60_000)) + " from t1, t2"
    nested = "select " + "(" * 3_000 + "select 1 from t1" + ")" * 3_000 + " from t2"
    for sql in (inside, listed, nested):
        assert references(spark, sql) == ["T1", "T2"]


def test_signatures_compare_whole_statements(spark):
    long = "select " + "x, " * 100
    history = spark.createDataFrame([(long + "a", 1, T0, "OK")], "statement_text string, statement_id int, start_time timestamp_ntz, execution_status string")
    asked = spark.createDataFrame([(1, long.upper() + "  A "), (2, long + "b")], "query_id int, sql_text string")
    found = lambda **o: {r["query_id"]: r["statement_id"] for r in querylog.match_signature(history, asked, **o).collect()}
    assert found() == {1: 1, 2: None} and found(length=150) == {1: 1, 2: 1}


def test_temporary_names_are_found(spark):
    sql = """create or replace temporary table tmp_one as select 1;
    CREATE MULTISET VOLATILE TABLE lab.vt_two AS select 2; -- create temp table not_me
    """
    row = spark.createDataFrame([(sql,)], "q string").select(querylog.temp_tables("q").alias("n")).first()
    assert row["n"] == ["TMP_ONE", "VT_TWO"]


def test_keys_that_are_no_plain_words(spark):
    sql = "select a.id from a join b on a.id = b.id and to_date(b.ts) = a.day where a.idx = 1"
    queries = spark.createDataFrame([(1, sql)], "query_id int, sql_text string")
    keys = spark.createDataFrame([(1, k) for k in ("id", "ID", "idx", "to_date(b.ts)", "b.id", "day")], "query_id int, key string")
    rows = {r["key"]: (r["present"], r["in_join"], r["in_where"], r["in_select"]) for r in querylog.key_usage(queries, keys).collect()}
    assert rows == {
        "ID": (True, True, False, True),
        "IDX": (True, False, True, False),
        "TO_DATE(B.TS)": (False, False, False, False),
        "B.ID": (True, True, False, False),
        "DAY": (True, True, False, False),
    }


def test_signature_ignores_blanks_and_case(spark):
    rows = [("  select\n\t 1  from  t ",), ("SELECT 1 FROM T",)]
    out = spark.createDataFrame(rows, "q string").select(querylog.signature("q").alias("s")).distinct().collect()
    assert [r["s"] for r in out] == ["SELECT 1 FROM T"]


def test_snapshot_registration(spark):
    def entry(day, status):
        return (dt.date(2024, 1, day), T0, T0, T0, T0, status)

    log = spark.createDataFrame([entry(1, "Successful"), entry(2, "Failed"), entry(3, "Successful")], loadlog.SNAPSHOT_LOG)
    out, queued = loadlog.register_snapshot(log, dt.date(2024, 1, 4), T0 + dt.timedelta(9))
    assert [(r["snapshot_date"].day, r["status"]) for r in queued.collect()] == [(2, "Queued"), (3, "Queued"), (4, "Queued")]
    again, _ = loadlog.register_snapshot(out, dt.date(2024, 1, 4), T0 + dt.timedelta(9))
    assert again.count() == out.count() == 4
    running = spark.createDataFrame([entry(4, "Running"), entry(5, "Successful")], loadlog.SNAPSHOT_LOG)
    row = loadlog.register_snapshot(running, dt.date(2024, 1, 4), T0)[0].filter("status = 'Queued'").collect()
    assert [(r["snapshot_date"].day, r["started"], r["ended"]) for r in row] == [(4, None, None)]
    finished = running.withColumn("status", F.lit("Successful"))
    assert loadlog.register_snapshot(finished, dt.date(2024, 1, 4), T0)[1].count() == 0
    done = loadlog.register_snapshot(running, dt.date(2024, 1, 5), T0)[0]
    assert {r["snapshot_date"].day: r["status"] for r in done.collect()} == {4: "Running", 5: "Successful"}


def test_status_events_in_order(spark):
    log = spark.createDataFrame([(1, T0, T0, None, None, "Queued"), (2, T0, T0, None, None, "Queued")], "id int, created timestamp_ntz, updated timestamp_ntz, started timestamp_ntz, ended timestamp_ntz, status string")
    events = [(1, i, T0 + dt.timedelta(hours=i), s) for i, s in enumerate(["Running", "Failed", "Running", "Successful"], 1)]
    out = loadlog.apply_status(log, spark.createDataFrame(events, "id int, event_id int, ts timestamp_ntz, status string"), ["id"])
    rows = {r["id"]: (r["status"], r["started"], r["ended"]) for r in out.collect()}
    assert rows == {1: ("Successful", T0 + dt.timedelta(hours=3), T0 + dt.timedelta(hours=4)), 2: ("Queued", None, None)}


def test_pre_aggregated_mart_is_equal(spark):
    folder = "/root/testdata/sf0.001"
    one = spark_rows(queries()["a1_revenue_mart"](spark, folder))
    other = spark_rows(queries()["a4_revenue_mart_pre_aggregated"](spark, folder))
    assert sorted(map(repr, one[1])) == sorted(map(repr, other[1]))


def test_pre_aggregated_mart_holds_no_groups_beside_its_joins(spark):
    """The wide groups are summed after their shuffle only: rows meet that shuffle straight from the joins."""
    plan = explained(queries()["a4_revenue_mart_pre_aggregated"](spark, "/root/testdata/sf0.001"))
    assert "REPARTITION_BY_COL" in plan


def test_clean_counts_are_observed(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, n int")
    out, before, after = quality.clean(df)
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 0), ("unknown", 2)]
    assert before.get == {"rows": 4, "with_missing": 2} and after.get == {"rows": 3}


def test_schema_map_errors(spark):
    df = spark.createDataFrame([(" 1 ", "x")], "a string, b string")
    assert projections.apply_schema_map(df, ["a", "b"], ["int", "int"]).first() == (1, None)
    for names, types, message in [(["a"], [], "types"), (["c"], ["int"], "not in the data"), (["a"], ["money"], "unknown types")]:
        with pytest.raises(ValueError, match=message):
            projections.apply_schema_map(df, names, types)


def test_text_helpers(spark):
    df = spark.createDataFrame([("Service X -Update <div>a&nbsp;b</div>Service Health RAG ", "a.b.c.d.e")], "t string, d string")
    row = df.select(
        text.text_between("t", "Update", "Service Health RAG").alias("between"),
        text.plain_text(F.lit("<ul><li>one</li></ul>")).alias("plain"),
        text.dotted_part("d", 1).alias("too_many"),
        text.text_before("t", "nowhere").alias("absent"),
        text.initial_capital(F.lit("mARY ann")).alias("cap"),
        text.file_stem(F.lit("/a/b.c/d.tar.gz")).alias("stem"),
    ).first()
    assert row["between"] == " <div>a&nbsp;b</div>"
    assert (row["plain"], row["too_many"], row["absent"]) == ("one", None, None)
    assert (row["cap"], row["stem"]) == ("Mary ann", "d.tar")
