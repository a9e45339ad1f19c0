"""Sharding and mixing: their laws, hot keys, odd rows."""

from collections import Counter
from math import ceil, floor
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, queries
from tidemark.llm.sharding import histogram_shards

FOLDER = "/root/testdata/sf0.001"


def check_shards(rows, shards=16):
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_query_covers_every_row(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_histogram_shards"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        body = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, crc32(body), "bytes", None)
    check_shards(rows)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    bytes_of = Counter()
    for r in rows:
        bytes_of[r["shard"]] += r["size"]
    assert all(abs(bytes_of[s] - total / 16) <= largest for s in range(16))


def test_a_hot_text_is_cut_between_its_rows(docs_of):
    docs = docs_of([(k, "same text" if k % 3 == 0 else f"text {k:05d}"[:9]) for k in range(3000)])
    rows = histogram_shards(docs).collect()
    assert len(rows) == 3000
    check_shards(rows)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 2


def test_equal_texts_stand_together(docs_of):
    rows = histogram_shards(docs_of([(k, f"text {k % 300}") for k in range(1200)])).collect()
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in by_text.values()) <= 15


def test_shards_of_odd_rows(odd_docs, no_docs, docs_of):
    rows = histogram_shards(odd_docs.withColumn("shard", F.lit("mine"))).collect()
    assert len(rows) == 10 and {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    check_shards(rows)
    assert histogram_shards(no_docs).count() == 0
    check_shards(histogram_shards(docs_of([(1, "same")] * 500)).collect())


def test_windows_and_deviation(spark):
    rows = queries.QUERIES["op5_pfair_mixing"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 700, "b": 1, "c": 299}, {"a": 1, "b": 1, "c": 1}])
def test_no_source_is_a_block_off_its_share(docs_of, weights):
    docs = docs_of([(k, "t", "abc"[k % 3]) for k in range(1500)])
    rows = mixing.mix(docs, weights=weights, block_rows=5).collect()
    share = {r["source"]: r["target_weight"] for r in rows}
    assert sum(share.values()) == pytest.approx(1)
    blocks = {(r["source"], r["block"]): r["slot"] for r in rows}
    assert len(set(blocks.values())) == len(blocks) == 300
    ends = min(max(slot for (s, _), slot in blocks.items() if s == source) for source in share)
    at = {slot: s for (s, _), slot in blocks.items()}
    done = Counter()
    for slot in range(ends + 1):
        done[at.get(slot)] += 1
        assert all(abs(done[s] - share[s] * (slot + 1)) < 1 for s in share)


def test_slots_are_the_plain_schedule(spark):
    """The fold over one cycle against a loop."""
    parts = {"+a": 5, "+b": 3, "+c": 8}
    rows = mixing.cycle_schedule(spark.createDataFrame(list(parts.items()), "__key string, __parts long")).collect()
    cycle, done, expected = 16, Counter(), []
    for t in range(cycle):
        free = [(ceil((done[k] + 1) * cycle / p), k) for k, p in sorted(parts.items()) if floor(done[k] * cycle / p) <= t]
        expected.append(min(free)[1])
        done[min(free)[1]] += 1
    assert [r["__key"] for r in sorted(rows, key=lambda r: r["at"])] == expected


def test_mixing_odd_rows(odd_docs, no_docs):
    clash = odd_docs.withColumnRenamed("lang", "slot")
    rows = mixing.mix(clash).collect()
    assert len(rows) == 10 and {r["source"] for r in rows} == {"s", None}
    ordered = mixing.mixed_order(clash)
    assert ordered.columns == clash.columns and ordered.count() == 10
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_order(no_docs).count() == 0


def test_shards_of_text_ids(docs_of):
    docs = docs_of([(k, f"text {k % 50}") for k in range(200)]).withColumn("doc_id", F.concat(F.lit("doc-"), "doc_id"))
    rows = histogram_shards(docs).collect()
    assert len({r["doc_id"] for r in rows}) == 200
    check_shards(rows)
