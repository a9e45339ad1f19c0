"""Extract runs from config rows, committed watermarks, staged duplicates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.compare import explained
from tidemark.operators import facts

T0 = dt.datetime(2024, 1, 1)
CONFIG = "table_name string, incremental_column string, watermark timestamp_ntz"


def day(n):
    return T0 + dt.timedelta(days=n)


@pytest.fixture
def tables(spark):
    a = spark.createDataFrame([(k, day(k)) for k in range(10)], "id int, at timestamp_ntz")
    return {"a": a, "b": a.filter("id < 3"), "empty": a.filter("false")}


def test_watermarks_move_only_with_what_was_written(spark, tables, folder):
    rows = [("a", "at", day(4)), ("b", "at", day(7)), ("empty", "at", day(1)), ("lost", "at", day(2)), ("a_bad", "no_column", day(3))]
    config = spark.createDataFrame(rows, CONFIG)

    def read(name):
        return tables["a"] if name == "a_bad" else tables[name] if name in tables else spark.read.parquet(f"{folder}/{name}")

    log = facts.run_extracts(spark, config, read, f"{folder}/out")
    got = {r["table_name"]: (r["status"], r["rows_copied"], r["watermark"]) for r in log.collect()}
    assert got == {"a": ("Succeeded", 6, day(9)), "b": ("Succeeded", 0, None), "empty": ("Succeeded", 0, None), "lost": ("Failed", 0, None), "a_bad": ("Failed", 0, None)}
    store = f"{folder}/config"
    facts.commit_watermarks(config, log, store)
    now = facts.committed_config(spark, store)
    assert {r["table_name"]: r["watermark"] for r in now.collect()} == {"a": day(9), "b": day(7), "empty": day(1), "lost": day(2), "a_bad": day(3)}
    # The next run starts there, and again from the same bound writes the same rows once.
    for _ in range(2):
        log = facts.run_extracts(spark, now.filter("table_name = 'a'"), read, f"{folder}/out")
        assert [r["id"] for r in spark.read.parquet(log.first()["path"]).collect()] == [9]
    facts.commit_watermarks(now, log, store)
    assert spark.read.parquet(store).select("version").distinct().count() == 2


def test_a_failed_commit_leaves_the_old_watermarks(spark, tables, folder):
    config = spark.createDataFrame([("a", "at", day(4))], CONFIG)
    store = f"{folder}/config"
    log = facts.run_extracts(spark, config, tables.__getitem__, f"{folder}/out")
    facts.commit_watermarks(config, log, store)
    broken = log.withColumn("watermark", F.raise_error(F.lit("lost")).cast("timestamp_ntz"))
    with pytest.raises(Exception, match="lost"):
        facts.commit_watermarks(config, broken, store)
    assert facts.committed_config(spark, store).first()["watermark"] == day(9)


def test_bounds_reach_the_scan(spark, tables, folder):
    tables["a"].write.parquet(f"{folder}/a")
    plan = explained(facts.incremental_extract(spark.read.parquet(f"{folder}/a"), "at", day(4)))
    assert "GreaterThanOrEqual(at," in plan


def test_staged_rows_are_settled(spark):
    rows = [(1, 5, "a"), (1, 6, "b"), (2, 5, "a"), (2, 5, "b"), (2, 4, "c"), (3, 1, "x"), (3, 1, "x"), (None, 1, "p"), (None, None, "q"), (4, None, "r"), (4, None, "s")]
    rows += [(9, k, "hot") for k in range(500)]
    stg = spark.createDataFrame(rows, "k int, rank int, v string")
    settled, rejected = facts.settle_staged(stg, ["k"], ["rank"])
    assert sorted((r["k"] or 0, r["v"], r["rank"]) for r in settled.collect()) == [(0, "p", 1), (1, "b", 6), (3, "x", 1), (9, "hot", 499)]
    assert sorted((r["k"], r["v"]) for r in rejected.collect()) == [(2, "a"), (2, "b"), (2, "c"), (4, "r"), (4, "s")]
    without, torn = facts.settle_staged(stg.filter("k < 9"), ["k"])
    assert [r["k"] for r in without.collect()] == [3] and torn.count() == 7


def test_no_key_loads_twice(spark):
    stg = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, 1, "c"), (2, 1, "d"), (3, 1, "e")], "k int, rank int, v string")
    fact = spark.createDataFrame([(3,)], "k int")
    loaded = facts.load_fact(stg, [], fact, ["k"], ["v"], winner=["rank"]).collect()
    assert [(r["k"], r["v"]) for r in loaded] == [(1, "b")]
