"""Readers, sinks and streams: idempotence, schema enforcement, errors."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import layout, versioned
from tidemark.sources import readers, writers
from tidemark.streaming import ingest
from tests.compare import explained

COUNTRIES = "Country string, Citizens int"


def land(spark, folder, rows, schema=COUNTRIES):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("header", True).csv(folder)


@pytest.fixture
def table(spark, folder):
    name = f"tidemark_{folder.rsplit('-', 1)[1]}"
    ingest.create_target(spark, name, COUNTRIES, f"{folder}/table")
    return name


def test_files_are_loaded_once(spark, folder, table):
    src, log = f"{folder}/in", f"{folder}/log"
    land(spark, src, [("A", 1), ("B", 2)])
    assert ingest.copy_into(spark, src, table, log, COUNTRIES, "csv") == 2
    assert ingest.copy_into(spark, src, table, log, COUNTRIES, "csv") == 0
    land(spark, src, [("C", 3)])
    assert ingest.copy_into(spark, src, table, log, COUNTRIES, "csv") == 1
    assert sorted(r["Country"] for r in spark.table(table).collect()) == ["A", "B", "C"]


def test_new_columns_need_schema_merge(spark, folder, table):
    src, log = f"{folder}/in", f"{folder}/log"
    land(spark, src, [("A", 1)])
    ingest.copy_into(spark, src, table, log, COUNTRIES, "csv")
    wide = f"{COUNTRIES}, Year int"
    land(spark, src, [("B", 2, 2020)], wide)
    with pytest.raises(ValueError, match="Year"):
        ingest.copy_into(spark, src, table, log, wide, "csv", enforceSchema="false")
    ingest.copy_into(spark, src, table, log, wide, "csv", merge_schema=True, enforceSchema="false")
    assert {r["Country"]: r["Year"] for r in spark.table(table).collect()} == {"A": None, "B": 2020}


def test_a_stream_needs_a_folder(spark, folder):
    land(spark, f"{folder}/one.csv", [("A", 1)])  # a folder, whatever it is called
    assert ingest.stream_files(spark, f"{folder}/one.csv", COUNTRIES).isStreaming
    file = readers.list_files(spark, f"{folder}/one.csv").filter("name LIKE 'part-%'").first()["path"]
    with pytest.raises(ValueError, match="folder"):
        ingest.stream_files(spark, file, COUNTRIES)


def test_sources_with_odd_folder_names(spark, folder):
    """Blanks, plus, hash and percent signs; a folder in a folder; a name that begins like another."""
    names = ["plain", "plain two", "a+b", "a#b", "100%25", "ü"]
    sources = {n: f"{folder}/in/{n}" for n in names} | {"inner": f"{folder}/in/plain/inner"}
    for n, path in sources.items():
        land(spark, path, [(n, 1)])
    rows = [r for df in readers.read_sources(spark, sources) for r in df.collect()]
    assert {r["source"]: r["Country"] for r in rows} == {n: n for n in sources}


def test_headers_are_read_without_jobs(spark, folder):
    sources = {f"s{k}": f"{folder}/in/s{k}" for k in range(6)}
    for k, path in enumerate(sources.values()):
        land(spark, path, [("A, b", k)], COUNTRIES if k % 2 else "`Land, \"x\"` string, Citizens int")
    spark.sparkContext.setJobGroup("headers", "headers")
    layouts = readers.read_sources(spark, sources)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    assert {tuple(df.columns) for df in layouts} == {("Country", "Citizens", "source"), ('Land, "x"', "Citizens", "source")}
    assert sum(df.count() for df in layouts) == 6


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tidemark.session import shared_dir

    def session(folder):
        context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)

    assert shared_dir(session("hdfs://shared/")) == "hdfs://shared"
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(session(None))


def test_a_stream_cannot_be_shown(spark, folder):
    land(spark, folder, [("A", 1)])
    stream = ingest.stream_files(spark, folder, COUNTRIES)
    assert stream.isStreaming
    with pytest.raises(Exception, match="writeStream"):
        stream.show()


def test_reprocess_starts_again(spark, folder):
    land(spark, f"{folder}/in", [("A", 1), ("A", 1)])
    for run in range(2):
        out = ingest.reprocess(spark, f"{folder}/in", f"{folder}/out{run}", f"{folder}/log{run}", COUNTRIES)
        assert out.count() == 2


def test_append_rejects_extra_columns_and_changed_types(spark):
    target = spark.createDataFrame([("A", 1)], COUNTRIES)
    extra = spark.createDataFrame([("B", 2, 3)], f"{COUNTRIES}, Year int")
    with pytest.raises(ValueError, match="Year"):
        writers.append_enforced(target, extra)
    assert writers.append_enforced(target, extra, merge_schema=True).columns == ["Country", "Citizens", "Year"]
    with pytest.raises(ValueError, match="does not match"):
        writers.append_enforced(target, spark.createDataFrame([("B", "2")], "Country string, Citizens string"))
    short = writers.append_enforced(target, spark.createDataFrame([("C",)], "Country string"))
    assert {r["Country"]: r["Citizens"] for r in short.collect()} == {"A": 1, "C": None}


def test_sources_keep_their_own_headers(spark, folder):
    land(spark, f"{folder}/in/a", [("A", 1)])
    land(spark, f"{folder}/in/ab", [("B", 2)])
    land(spark, f"{folder}/in/c", [(3, "C")], "Citizens int, Country string")
    sources = {n: f"{folder}/in/{n}" for n in ("a", "ab", "c")}
    writers.land_to_bronze(spark, sources, f"{folder}/out", dt.date(2024, 3, 1))
    got = {n: writers.read_layer(spark, f"{folder}/out", n).select("Country", "Citizens").collect() for n in sources}
    assert {n: tuple(r[0]) for n, r in got.items()} == {"a": ("A", "1"), "ab": ("B", "2"), "c": ("C", "3")}
    land(spark, f"{folder}/in/a", [(9, "Z")], "Citizens int, Country string")
    with pytest.raises(Exception, match="header"):
        writers.land_to_bronze(spark, sources, f"{folder}/out2", dt.date(2024, 3, 1))


def test_one_day_of_a_layer_is_overwritten(spark, folder):
    day = spark.createDataFrame([("A", 1), ("B", 2)], COUNTRIES)
    writers.write_layer(day, folder, dt.date(2024, 3, 1))
    writers.write_layer(day, folder, dt.date(2024, 3, 2))
    out = writers.write_layer(day.limit(1), folder, dt.date(2024, 3, 1))
    assert {r["day"]: r["count"] for r in out.groupBy("day").count().collect()} == {1: 1, 2: 2}


def test_partition_filters_prune_files(spark, folder):
    df = spark.range(100).selectExpr("id", "id % 4 AS year", "id % 3 AS month")
    writers.write_partitioned(df, folder, ["year", "month"])
    read = readers.read_partitioned(spark, folder).filter("year = 1 AND month = 2")
    plan = explained(read)
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan.split("PartitionFilters")[1]
    assert read.count() == df.filter("year = 1 AND month = 2").count()


def test_hot_partitions_are_split(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(200_000).selectExpr("id", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('k', id % 30) END AS source", "uuid() AS u")
        writers.write_partitioned(hot.repartition(8), folder, ["source"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = readers.list_files(spark, folder).filter("startswith(name, 'part-') AND path LIKE '%source=hot%'")
    assert files.count() > 1


def test_good_and_bad_make_the_whole(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "id int, ok boolean")
    good, bad = writers.split_good_bad(df, F.col("ok"))
    assert [r["id"] for r in good.collect()] == [2]
    assert sorted(r["id"] for r in bad.collect()) == [1, 3]


def test_jdbc_options_split_the_read():
    options = readers.jdbc_options("jdbc:x", "t", "id", 0, 100, 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    assert readers.jdbc_options("jdbc:x", "t", None, 0, 1, 8) == {"url": "jdbc:x", "dbtable": "t"}


def test_rewrite_refuses_its_own_path(spark, folder):
    with pytest.raises(ValueError, match="differ"):
        versioned.rewrite(spark, folder, lambda df: df, f"{folder}/")


def test_compaction_keeps_rows(spark, folder):
    writers.write_files(spark.range(1000).toDF("id"), f"{folder}/a", files=20)
    assert layout.compact(spark, f"{folder}/a", f"{folder}/b") == 1
    assert spark.read.parquet(f"{folder}/b").count() == 1000


def test_a_given_number_of_files_takes_whole_splits(spark, folder, monkeypatch):
    """Even splits are joined without a shuffle; few or uneven ones are dealt out by rows."""
    shuffled = []
    deal = type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda df, *by: shuffled.append(by) or deal(df, *by))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # no two of the written parts share a split
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        ids = spark.range(0, 1000, 1, 20).toDF("id")
        for label, rows, dealt in [("even", ids, []), ("few", ids.coalesce(2), [(5,)]), ("uneven", ids.filter("id < 400 OR id % 50 = 0"), [(5,)]), ("none", ids.filter("id < 0"), [(5,)])]:
            shuffled.clear()
            writers.write_files(rows, f"{folder}/{label}", files=5)
            assert shuffled == dealt, label
            read = spark.read.parquet(f"{folder}/{label}")
            assert sorted(r["id"] for r in read.collect()) == sorted(r["id"] for r in rows.collect())
            files = readers.with_source_file(read).groupBy("source_file").count().collect()
            assert len(files) == (0 if label == "none" else 5)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_layout_depth_of_files(spark, folder):
    rows = spark.range(4000).selectExpr("id", "hash(id) AS h")
    rows.repartitionByRange(8, "id").write.parquet(f"{folder}/sorted")
    rows.repartition(8, "h").write.parquet(f"{folder}/mixed")
    tidy = layout.layout_depth(spark.read.parquet(f"{folder}/sorted"), "id").first()
    mixed = layout.layout_depth(spark.read.parquet(f"{folder}/mixed"), "id").first()
    assert (tidy["n_files"], tidy["avg_overlaps"], tidy["avg_depth"]) == (8, 0.0, 1.0)
    assert (mixed["n_files"], mixed["avg_overlaps"], mixed["avg_depth"]) == (8, 7.0, 8.0)


def test_zorder_splits_a_hot_cell(spark):
    hot = spark.range(4000).selectExpr("CASE WHEN id % 3 < 2 THEN 5 ELSE id END AS a", "5 AS b", "id AS c")
    sizes = writers.partition_sizes(layout.zorder(hot, ["a", "b"], files=8)).collect()
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 1400
    copies = spark.range(4000).selectExpr("5 AS a", "5 AS b", "id AS row_no")
    spread = layout.zorder(copies, ["a", "b"], files=8, spread=F.col("row_no"))
    assert max(r["count"] for r in writers.partition_sizes(spread).collect()) < 1400
