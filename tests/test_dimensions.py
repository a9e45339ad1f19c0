"""Type 1 and 2 dimensions: golden rows, options and properties."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference, spark_rows, sql_rows
from tidemark.operators import dimensions as dims
from tidemark.operators.dimensions import History
from tidemark.operators.loadlog import audit_row
from tidemark.plans.catalog import oracle_sql, queries

DIM = "row_key int, id int, first string, last string, city string, start_date timestamp_ntz, end_date timestamp_ntz"
STG = "id int, first string, last string, city string"
BEGIN, NOW = dt.datetime(2023, 12, 26, 6, 51, 38), dt.datetime(2023, 12, 26, 6, 53, 49)
FAR = dt.datetime(9999, 12, 31)


def dim(spark, rows, end=None):
    return spark.createDataFrame([(*r, BEGIN, end) for r in rows], DIM)


def people(spark):
    return dim(spark, [(1, 101, "a", "b", "c"), (4, 104, "s", "old", "town"), (5, 105, "h", "v", "k")])


def test_changed_key_closes_and_reopens(spark):
    stg = spark.createDataFrame([(104, "s", "new", "city"), (106, "r", "a", "h")], STG)
    out = dims.scd2(people(spark), stg, ["id"], ["last", "city"], NOW)
    rows = {(r["id"], r["last"], r["start_date"], r["end_date"]) for r in out.collect()}
    assert rows == {
        (101, "b", BEGIN, None),
        (104, "old", BEGIN, NOW),
        (104, "new", NOW, None),
        (105, "v", BEGIN, None),
        (106, "a", NOW, None),
    }


def test_surrogates_continue_from_the_largest(spark):
    stg = spark.createDataFrame([(104, "s", "new", "city"), (106, "r", "a", "h")], STG)
    merged = dims.scd2(people(spark), stg, ["id"], ["last"], NOW)
    keyed = dims.fill_surrogates(merged, "row_key", ["id"], dims.next_key(people(spark), "row_key"))
    assert {(r["id"], r["row_key"]) for r in keyed.filter("start_date = timestamp_ntz'2023-12-26 06:53:49'").collect()} == {
        (104, 6),
        (106, 7),
    }
    assert keyed.filter("row_key IS NULL").count() == 0


@pytest.mark.parametrize("open_end", [None, FAR])
@pytest.mark.parametrize("by_hash", [False, True])
def test_second_run_changes_nothing(spark, open_end, by_hash):
    history = History(open_end=open_end)
    start = dim(spark, [(1, 101, "a", "b", None), (2, 102, "c", None, "x")], open_end)
    stg = spark.createDataFrame([(101, "a", None, "y"), (102, "c", None, "x"), (103, "n", None, None)], STG)
    once = dims.scd2(start, stg, ["id"], ["last", "city"], NOW, history=history, by_hash=by_hash)
    twice = dims.scd2_tagged(once, stg, ["id"], ["last", "city"], NOW + dt.timedelta(1), history=history, by_hash=by_hash)
    assert twice.filter("_action <> 'keep'").count() == 0
    assert once.filter(history.is_open()).groupBy("id").count().filter("count > 1").count() == 0
    assert once.count() == 4


def test_null_changes_are_changes(spark):
    start = dim(spark, [(1, 101, "a", None, "x"), (2, 102, "c", "d", "x")])
    stg = spark.createDataFrame([(101, "a", "b", "x"), (102, "c", None, "x")], STG)
    tagged = dims.scd2_tagged(start, stg, ["id"], ["last"], NOW)
    assert sorted(r["_action"] for r in tagged.collect()) == ["close", "close", "insert", "insert"]


def test_static_form_is_equivalent(spark):
    stg = spark.createDataFrame([(101, "a", "b", "moved"), (105, "h", "v", "k"), (107, "n", None, None)], STG)
    closed = dim(spark, [(9, 101, "a", "z", "c")], BEGIN)
    start = people(spark).unionByName(closed)
    one = dims.scd2(start, stg, ["id"], ["last", "city"], NOW)
    other = dims.scd2_static(start, stg, ["id"], ["last", "city"], NOW)
    assert sorted(map(repr, spark_rows(one)[1])) == sorted(map(repr, spark_rows(other)[1]))


def test_a_key_with_only_closed_rows_is_opened_again(spark):
    closed = dim(spark, [(9, 101, "a", "z", "c")], BEGIN)
    stg = spark.createDataFrame([(101, "a", "z", "c")], STG)
    out = dims.scd2(closed, stg, ["id"], ["last"], NOW)
    assert out.filter("end_date IS NULL").count() == 1 and out.count() == 2


def test_several_staged_rows_for_one_key(spark):
    stg = spark.createDataFrame([(101, "a", "x", "1"), (101, "a", "x", "1"), (101, "a", "y", "2")], STG)
    with pytest.raises(Exception, match="several different staged rows"):
        dims.scd1(people(spark).select("id", "first", "last", "city"), stg, ["id"]).collect()
    last = dims.one_per_key(stg, ["id"], ["city"]).collect()
    assert [r["last"] for r in last] == ["y"]
    assert dims.one_per_key(stg.filter("last = 'x'"), ["id"]).count() == 1


def test_scd1_options(spark):
    known = people(spark).select("id", "first", "last", "city")
    stg = spark.createDataFrame([(104, "s", "new", "city"), (106, "r", "a", "h")], STG)

    def names(**options):
        return sorted((r["id"], r["last"]) for r in dims.scd1(known, stg, ["id"], **options).collect())

    assert names() == [(101, "b"), (104, "new"), (105, "v"), (106, "a")]
    assert names(matched="keep_target") == [(101, "b"), (104, "old"), (105, "v"), (106, "a")]
    assert names(unmatched="drop") == [(104, "new"), (106, "a")]


def test_audit_rows_have_a_time_only_when_touched(spark):
    stg = spark.createDataFrame([(201 + i, "n", "n", "n") for i in range(10)], STG)
    first = dims.scd2_tagged(people(spark), stg, ["id"], ["last"], NOW)
    assert audit_row(first, "people", NOW).first().asDict() == {
        "table_name": "people",
        "inserted_count": 10,
        "updated_count": 0,
        "inserted_at": NOW,
        "updated_at": None,
    }


def test_control_rows_must_be_complete(spark):
    schema = "load_type string, source_table string, source_column string, is_key string, is_auto string, target_table string, target_column string, is_tracked string"
    control = spark.createDataFrame([("SCD2", "stg.a", "id", "Y", "", "dim.a", "id", "")], schema)
    assert dims.roles_from_control(control, "DIM.A").keys == ["id"]
    with pytest.raises(ValueError, match="no control rows"):
        dims.roles_from_control(control, "dim.b")
    two = control.unionByName(control.withColumn("source_table", F.lit("stg.b")))
    with pytest.raises(ValueError, match="one source table"):
        dims.roles_from_control(two, "dim.a")


def test_load_type_decides(spark):
    schema = "load_type string, source_table string, source_column string, is_key string, is_auto string, target_table string, target_column string, is_tracked string"
    rows = [(kind, "stg", c, "Y" * (c == "id"), "", table, c, "Y" * (c != "id")) for kind, table in (("SCD1", "one"), ("scd2 ", "two")) for c in ("id", "city")]
    control = spark.createDataFrame(rows, schema)
    old = spark.createDataFrame([(1, "a", BEGIN, None)], "id int, city string, start_date timestamp_ntz, end_date timestamp_ntz")
    new = {"stg": spark.createDataFrame([(1, "b")], "id int, city string")}
    out = dims.load_by_control({"one": old, "two": old}, new, control, NOW)
    assert sorted(r["city"] for r in out["one"].collect()) == ["b"]
    assert sorted(r["city"] for r in out["two"].collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="loaded as SCD2"):
        dims.scd1_from_control(old, new["stg"], control, "two")
    with pytest.raises(ValueError, match="loaded as SCD1"):
        dims.scd2_from_control({"one": old}, new, control, NOW)
    with pytest.raises(ValueError, match="one load type"):
        dims.roles_from_control(control.withColumn("target_table", F.lit("one")), "one")


@pytest.mark.parametrize("by_hash", [False, True])
def test_null_keys_change_nothing_and_null_moves_are_changes(spark, by_hash):
    columns = "id int, a string, b string, start_date timestamp_ntz, end_date timestamp_ntz"
    old = spark.createDataFrame([(1, None, "x", BEGIN, None), (None, "k", "k", BEGIN, None)], columns)
    stg = spark.createDataFrame([(1, "x", None), (None, "p", "q"), (None, "r", "s")], "id int, a string, b string")
    once = dims.scd2(old, stg, ["id"], ["a", "b"], NOW, by_hash=by_hash)
    again = dims.scd2(once, stg, ["id"], ["a", "b"], NOW, by_hash=by_hash)
    for out in (once, again):
        assert {(r["id"], r["a"], r["b"], r["end_date"]) for r in out.collect()} == {(1, None, "x", NOW), (1, "x", None, None), (None, "k", "k", None)}
        assert out.count() == 3
    assert {r["a"] for r in dims.rejected_rows(stg, ["id"]).collect()} == {"p", "r"}
    merged = dims.merge(old, stg, ["id"], update={"a": F.col("s.a")}, insert={"id": F.col("s.id"), "a": F.col("s.a")})
    assert merged.count() == 2 and dims.scd2_static(old, stg, ["id"], ["a", "b"], NOW).count() == 3


def test_rows_are_judged_by_control_rows(spark):
    from tidemark.operators import quality

    control = spark.createDataFrame(
        [("f", "id", "int", "Y", ""), ("f ", "n", "int", "", ""), ("f", "day", "", "", "dd-MM-yyyy"), ("g", "x", "int", "", "")],
        "file_name string, column_name string, data_type string, is_key string, date_format string",
    )
    rules = quality.rules_from_control(control, "f")
    assert (rules.keys, rules.formats, rules.types) == (["id"], {"day": "dd-MM-yyyy"}, {"id": "int", "n": "int"})
    good = ("1", "5", "01-02-2024")
    rows = [good, good, ("1", "6", "01-02-2024"), ("2", "x", "01-02-2024"), ("3", None, "2024-02-01"), (None, "1", "01-02-2024")]
    out = quality.judged(spark.createDataFrame(rows, "id string, n string, day string"), rules).collect()
    found = sorted((r["id"] or "", r["n"] or "", ",".join(r["reasons"])) for r in out)
    assert found == [("", "1", "missing"), ("1", "5", ""), ("1", "5", "duplicate"), ("1", "6", "duplicate"), ("2", "x", "type"), ("3", "", "missing,date")]
    with pytest.raises(ValueError, match="without control rows"):
        quality.judged(spark.createDataFrame([("1", "2")], "id string, extra string"), rules)
    with pytest.raises(ValueError, match="no control rows"):
        quality.rules_from_control(control, "h")


def test_two_current_rows_would_double_facts(spark):
    from tidemark.operators.facts import Lookup, load_fact

    stg = spark.createDataFrame([(1, "a", 5), (2, "z", 6)], "order_id int, code string, amount int")
    rows = [("a", 10, True), ("a", 11, False), (None, 12, True)]
    dim = spark.createDataFrame(rows, "code string, row_key int, is_current boolean")
    load = lambda d, current: load_fact(stg, [Lookup(d, {"code": "code"}, "row_key", "fk", current)], None, ["order_id"], ["amount"])
    assert {(r["order_id"], r["fk"]) for r in load(dim, F.col("is_current")).collect()} == {(1, 10), (2, None)}
    with pytest.raises(Exception, match="several current dimension rows"):
        load(dim, None).collect()


def test_seed_rows_are_added_once(spark):
    start = spark.createDataFrame([("Green", "fine")], "name string, description string")
    seeds = [{"name": "Red", "description": "bad"}, {"name": "Green", "description": "other"}]
    once = dims.ensure_rows(start, seeds, ["name"])
    assert sorted(map(tuple, dims.ensure_rows(once, seeds, ["name"]).collect())) == [("Green", "fine"), ("Red", "bad")]


@pytest.mark.parametrize("shift", [200_000, 0])
def test_journal_dates_are_not_bounded_by_a_calendar(spark, folder, shift):
    """Pages with large numbers are submitted decades later, and none of them is dropped."""
    given = "/root/testdata/sf0.001"
    for name in os.listdir(given):
        if not name.startswith("pages"):
            os.makedirs(folder, exist_ok=True)
            os.symlink(f"{given}/{name}", f"{folder}/{name}")
    pages = spark.read.parquet(f"{given}/pages.parquet").withColumn("page_id", F.col("page_id") + F.when(F.col("page_id") % 2 == 0, shift).otherwise(0))
    pages.toPandas().to_parquet(f"{folder}/pages.parquet")
    result = spark_rows(queries()["d15_journal_fact"](spark, folder))
    assert result[1] and difference(result, sql_rows(connect(folder), oracle_sql()["d15_journal_fact"])) is None
