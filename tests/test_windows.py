"""Numbering, filling and deduplication against brute force, with hot keys and many exact copies."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.compare import explained
from tidemark.operators import aggregates, layout, windows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    hot = [("hot", rng.randint(0, 40), None if rng.random() < 0.5 else rng.randint(0, 9)) for _ in range(400)]
    copies = [("hot", 7, 3)] * 300
    rest = [(f"k{rng.randint(0, 60)}", rng.randint(0, 40), None if rng.random() < 0.5 else rng.randint(0, 9)) for _ in range(500)]
    return hot + copies + rest


@pytest.fixture
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, o int, v int").repartition(7)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    """Force the chunked ways that only very large groups would take."""
    monkeypatch.setattr(windows, "COPY_CHUNK", 32)


def null_first(value):
    return (value is not None, value if value is not None else 0)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1], r[0], null_first(r[2])))


def test_number_rows_is_dense_and_sorted(df, rows):
    got = sorted((r["n"], r["k"], r["o"], r["v"]) for r in windows.number_rows(df, ["o", "k"], "n").collect())
    assert [(n, k, o, v) for n, (k, o, v) in enumerate(ordered(rows), 1)] == got


def test_number_rows_within_a_hot_partition(df, rows):
    got = {}
    for r in windows.number_rows(df, ["o"], "n", partition=["k"]).collect():
        got.setdefault(r["k"], []).append((r["n"], r["o"]))
    for k, pairs in got.items():
        mine = sorted(o for key, o, _ in rows if key == k)
        assert sorted(pairs) == list(enumerate(mine, 1))


def test_number_rows_starts_where_told(spark):
    out = windows.number_rows(spark.range(50).toDF("id"), ["id"], "n", start=1000, unique=True)
    assert sorted((r["id"], r["n"]) for r in out.collect()) == [(i, 1000 + i) for i in range(50)]


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "k string, o int")
    assert windows.number_rows(empty, ["o"], "n").count() == 0
    assert windows.number_rows(empty, ["o"], "n", partition=["k"], unique=True).count() == 0


def test_copies_are_numbered(df, rows):
    out = windows.number_copies(df, "c").groupBy("k", "o", "v").agg(F.max("c").alias("m"), F.count("*").alias("n"), F.count_distinct("c").alias("d"))
    assert all(r["m"] == r["n"] == r["d"] for r in out.collect())
    assert windows.number_copies(df, "c").count() == len(rows)


def test_multiset_minus(spark):
    a = spark.createDataFrame([("x",)] * 200 + [("y",)] * 3, "v string")
    b = spark.createDataFrame([("x",)] * 50 + [("z",)], "v string")
    assert {r["v"]: r["count"] for r in windows.multiset_minus(a, b).groupBy("v").count().collect()} == {"x": 150, "y": 3}


def test_dedup_keeps_the_first_and_reports_all_others(df, rows):
    kept, removed = windows.dedup_by_key(df, ["k"], ["o"])
    best = {}
    for r in rows:
        rank = (r[1], r[0], null_first(r[2]))
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((b[1] for b in best.values()), key=repr)
    both = sorted(map(tuple, kept.unionByName(removed).collect()), key=repr)
    assert both == sorted(rows, key=repr)


def test_forward_fill_matches_a_loop(df, rows):
    wanted, last = [], {}
    for k, o, v in sorted(rows, key=lambda r: (r[0], r[1], null_first(r[2]))):
        last[k] = v if v is not None else last.get(k)
        wanted.append((k, o, last[k]))
    got = windows.forward_fill(df, "v", ["o", "v"], ["k"]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_forward_fill_of_categories(spark):
    data = [(1, "fruit", "a"), (2, None, "b"), (3, None, "c"), (4, "drink", "d"), (5, None, "e")]
    out = windows.forward_fill(spark.createDataFrame(data, "id int, category string, brand string"), "category", ["id"])
    assert [r["category"] for r in out.orderBy("id").collect()] == ["fruit", "fruit", "fruit", "drink", "drink"]


def test_running_count_matches_a_loop(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "b"]), rng.choice([None, 1])) for i in range(300)]
    counts, wanted = {}, {}
    for i, k, v in data:
        counts[k] = counts.get(k, 0) + (v is not None)
        wanted[i] = counts[k]
    out = windows.running_count(spark.createDataFrame(data, "id int, k string, v int"), "v", ["id"], "n", ["k"])
    assert {r["id"]: r["n"] for r in out.collect()} == wanted


def test_grid_places_every_value_once(spark):
    names = [f"n{i:02d}" for i in range(11)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, id int")
    out = aggregates.grid(df, "name", 3, ["id"], ["name"]).orderBy("row_no").collect()
    cells = [[names[i] for i in range(11) if (i + 1) % 3 == b] for b in range(3)]
    for row in out:
        assert [row[f"col_{b}"] for b in range(3)] == [c[row["row_no"] - 1] if row["row_no"] <= len(c) else None for c in cells]


def test_groups_of_any_size_become_texts(spark):
    from tidemark.operators.aggregates import string_agg, string_parts

    df = spark.range(30_000).selectExpr("id % 2 AS k", "lpad(id, 6, '0') AS v")
    whole = {r["k"]: r["items"] for r in string_agg(df, ["k"], "v").collect()}
    parts = string_parts(df, ["k"], "v", items=4_000).collect()
    assert {r["k"]: r["items"] for r in string_agg(df.unionAll(df), ["k"], "v").collect()} == whole
    for k in (0, 1):
        texts = [r["items"] for r in sorted(parts, key=lambda r: r["part"]) if r["k"] == k]
        assert len(texts) == 4 and ",".join(texts) == whole[k]


def brute_depth(intervals):
    out = {}
    for f, lo, hi in intervals:
        overlaps = sum(1 for g, a, b in intervals if g != f and a <= hi and b >= lo)
        depth = max(sum(1 for _, a, b in intervals if a <= s <= b) for _, s, _ in intervals if lo <= s <= hi)
        out[f] = (overlaps, depth)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_interval_depth_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    intervals = []
    for i in range(rng.choice([1, 5, 40, 90])):
        lo = rng.randint(0, 60)
        intervals.append((f"f{i}", lo, lo + rng.choice([0, 0, 1, 5, 30])))
    out = layout.interval_depth(spark.createDataFrame(intervals, "file string, lo int, hi int"))
    assert {r["file"]: (r["n_overlaps"], r["depth"]) for r in out.collect()} == brute_depth(intervals)


@pytest.mark.parametrize("partition", [None, ["g"]])
def test_scans_over_three_levels_of_blocks(spark, monkeypatch, partition):
    """Blocks of two rows in groups of two, and their groups in groups, against a loop; NULL and repeated keys among them."""
    monkeypatch.setattr(windows, "COPY_CHUNK", 2)
    monkeypatch.setattr(windows, "FAN", 2)
    rows = [(k, [None, "a", "b"][k % 3] if partition else "x", k if k % 7 == 0 and k > 9 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, g string, v int")
    filled = {r["k"]: r["v"] for r in windows.forward_fill(df, "v", ["k"], partition, unique=True).collect()}
    counted = {r["k"]: r["n"] for r in windows.running_count(df, "v", ["k"], "n", partition, unique=True).collect()}
    last, seen = {}, {}
    for k, g, v in rows:
        last[g] = v if v is not None else last.get(g)
        seen[g] = seen.get(g, 0) + (v is not None)
        assert (filled[k], counted[k]) == (last[g], seen[g]), k


def test_removed_rows_are_found_by_number(spark):
    """Every row is either kept or removed, copies and NULL keys too; no plan groups or shuffles by all columns."""
    rows = [(1, "a", 1.0)] * 3 + [(None, "b", 2.0)] * 2 + [(2, None, None), (2, "c", 0.5)]
    df = spark.createDataFrame(rows, "k int, t string, x double")
    kept, removed = windows.dedup_by_key(df, ["k"], ["x"])
    assert Counter(map(tuple, kept.collect())) + Counter(map(tuple, removed.collect())) == Counter(rows)
    assert sorted((r["k"] or 0, r["x"] or 0) for r in kept.collect()) == [(0, 2.0), (1, 1.0), (2, 0)]
    assert not re.search(r"hashpartitioning\(k#\d+, t#", explained(removed))


def test_buckets_by_binary_search(spark):
    """Against counting, for every number of bounds up to a few bits, with NULL, NaN and equal values."""
    values = [None, float("nan"), -1.0, 0.0, 0.5, 1.0, 2.0, 6.5, 7.0, 99.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (0, 1, 2, 3, 4, 7, 8):
        bounds = [float(k) for k in range(n)]
        got = [r["b"] for r in df.select(layout._bucket(F.col("x"), bounds).alias("b")).collect()]
        assert got == [0 if v is None else n if v != v else sum(b <= v for b in bounds) for v in values], n
