"""Near copies of whole texts against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_copies import folded, prose
from tidemark.llm import near_copies
from tidemark.llm.components import components
from tidemark.session import cut


def shingles(text):
    words = folded(text).split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= Fraction(4, 5):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def edited(rng, count):
    """Texts of which every third one is an earlier text with a few words changed."""
    rows = []
    for k in range(count):
        words = rows[rng.randrange(k)][1].split() if k % 3 == 2 else prose(rng, rng.randint(40, 300))
        if k % 3 == 2:
            for _ in range(rng.randint(1, max(1, len(words) // 30))):
                words[rng.randrange(len(words))] = f"changed{rng.random()}"
        rows.append((k, " ".join(words)))
    return rows


def test_the_stage_drops_what_is_similar(spark, docs_of):
    rows = edited(random.Random(12), 300)
    groups = brute(rows)
    docs = docs_of(rows)
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_components(docs, tile=4).collect()}
    assert found == groups and sum(i != g for i, g in groups.items()) > 40
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, g in groups.items() if i == g)


def test_near_copies_of_odd_rows(odd_docs, no_docs):
    kept = near_copies.near_dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [None, 1, 2, 3, 4, 7, 8, 9]
    assert near_copies.near_dedup(no_docs).count() == 0


def test_columns_of_any_name(docs_of):
    rows = edited(random.Random(2), 30)
    clash = docs_of(rows).withColumnRenamed("lang", "__gone").withColumnRenamed("source", "gone")
    kept = near_copies.near_dedup(clash)
    groups = brute(rows)
    assert kept.columns == clash.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, g in groups.items() if i == g)


def test_many_near_copies_of_one_text_are_linear(spark, docs_of, monkeypatch):
    """Copies that only their original links: each is similar to it, few to each other."""
    rng = random.Random(7)
    base = prose(rng, 200)
    rows = []
    for k in range(400):
        words = list(base)
        for place in rng.sample(range(10, 190), 0 if k == 50 else 3):
            words[place] = f"changed{rng.random()}"
        rows.append((k, " ".join(words)))
    asked = []
    compared = near_copies._compared
    monkeypatch.setattr(near_copies, "_compared", lambda groups, sets, least: asked.append(groups.distinct().selectExpr("sum(size(left) + size(right))").first()[0] or 0) or compared(groups, sets, least))
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_components(docs_of(rows), tile=16).collect()}
    assert found == brute(rows) and set(found.values()) == {0}
    assert sum(asked) < 32 * len(rows), asked  # a leader of each band at most, instead of the pairs of tiles of each band


@pytest.mark.parametrize("left, right, pairs", [([0, 1, 2, 3], [], {(0, 3), (1, 2)}), ([0, 1], [2, 3], {(0, 3), (1, 2)}), ([3], [0, 1, 2], {(0, 3)}), ([0, 2], [1, 3], {(0, 3), (1, 2)}), ([0, 1], [1, 2], {(1, 2)})])
def test_every_pair_of_a_group_is_compared(spark, left, right, pairs):
    """Similar sets in any place of either list are linked, and none that stand in one list of two."""
    sets = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 500, 501, 1)]  # 0 and 3, 1 and 2 are similar
    table = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "u long, shingles binary")
    groups = spark.createDataFrame([(left, right)], "left array<long>, right array<long>")
    found = {tuple(sorted((r["a"], r["b"]))) for r in near_copies._compared(groups, table, 0.8).collect()}
    assert {p for p in found if p[0] != p[1]} == pairs


@pytest.mark.parametrize("text", ["w9296838 w5808286 w9203799 w5634447 w3678096 w7660241 w1409219 w1744566 w1352131", "w8518567 w4468337 w5003041 w2865863 w9525692 w8008861 w1229141 w6186552 w4504306"])
def test_a_pair_that_shares_no_band_is_linked(spark, docs_of, text):
    """Four of five shingles are the same, which is the threshold."""
    pair = [(1, text), (2, text.rsplit(" ", 1)[0])]
    one, two = near_copies.band_keys(near_copies.shingle_sets([t for _, t in pair]))
    assert not (one == two).any()
    rng = random.Random(3)
    rows = pair + [(k, " ".join(prose(rng, 60))) for k in range(3, 30)]
    found = {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_components(docs_of(rows)).collect()}
    assert found == brute(rows) and found[2] == 1
    kept = corpus_pipeline.drop_near_copies(spark, docs_of(rows), "")
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [1, *range(3, 30)]


def test_all_links_are_found_without_bands(docs_of):
    """Prefixes lose no pair, also where texts are short and many shingles are frequent."""
    rng = random.Random(8)
    rows = edited(rng, 150)
    common = prose(rng, 400)
    for k in range(150, 400):
        at, size = rng.randrange(20), rng.randint(6, 60)
        rows.append((k, " ".join(common[at : at + size] + prose(rng, k % 4))))
    docs = docs_of(rows).selectExpr("doc_id AS __id", "text AS __text")
    sets = near_copies._banded(docs, "bigint", 0.8).groupBy("whole").agg(*[F.first(c).alias(c) for c in ("size", "prefix", "bits")], F.min("__id").alias("low"))
    sets = cut(sets.withColumn("u", F.col("low")))
    found = {i: i for i in (r["u"] for r in sets.collect())}
    none = sets.selectExpr("u AS a", "u AS b").limit(0)
    links = near_copies._prefix_links(docs, sets, none, 0.8, 4)
    found |= {r["node"]: r["root"] for r in components(links).collect()}
    groups = brute(rows)
    assert found == {i: groups[i] for i in found} and set(found) >= set(groups.values())


def test_prefixes_and_parities_keep_similar_sets():
    rng = np.random.default_rng(4)
    for least in (0.8, 0.6, 0.3):
        sets = []
        for _ in range(60):
            base = np.unique(rng.integers(0, 2**64, rng.choice([1, 4, 5, 9, 40, 63, 300]), dtype=np.uint64))
            sets.append(base)
            for share in rng.uniform(0.1, 0.6, 3):
                left = base[rng.random(len(base)) > share / 2]
                sets.append(np.unique(np.append(left, rng.integers(0, 2**64, int(share / 2 * len(base)), dtype=np.uint64))))
        sets = [s for s in sets if len(s)]
        often = np.unique(rng.choice(np.concatenate(sets), 500))
        heads = near_copies.prefixes(sets, often, rng.integers(1, 50, len(often)), least)
        assert not any(np.isin(h[: len(np.setdiff1d(s, often))], often).any() for h, s in zip(heads, sets))
        sizes, roots = np.array(list(map(len, sets))), np.arange(len(sets))
        bits = [near_copies.parities(s) for s in sets]
        split = len(sets) // 3
        able = [{tuple(sorted(p)) for p in zip(*map(list, near_copies.not_unlike(bits, sizes, roots, at, least)))} for at in (0, split)]
        pairs = 0
        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                shared = len(np.intersect1d(sets[i], sets[j]))
                if shared >= least * (len(sets[i]) + len(sets[j]) - shared):
                    pairs += 1
                    assert len(np.intersect1d(heads[i], heads[j]))
                    assert (i, j) in able[0] and ((i, j) in able[1]) == (i < split <= j)
        assert pairs > 20 and len(able[0]) < len(sets) ** 2 / 8
        assert not len(near_copies.not_unlike(bits, sizes, np.zeros(len(sets), int), 0, least)[0])  # linked already
