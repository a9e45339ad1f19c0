"""Exact copies, near copies and repeated passages against brute force."""

import random
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import passages, queries, simhash
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import exact_dedup, exact_groups

FOLDER = "/root/testdata/sf0.001"


def folded(text):
    return (text or "").encode().lower()


def test_exact_groups_of_odd_rows(odd_docs, no_docs):
    rows = exact_groups(odd_docs.withColumn("kept", F.lit("mine"))).collect()
    by_text = {1: 2, 2: 2, 3: 3, 4: 5, 5: 5, None: 5, 7: 7, 8: 8, 9: 9}
    assert len(rows) == 10 and all(r["keep_id"] == by_text[r["doc_id"]] for r in rows)
    assert {r["doc_id"] for r in rows if r["kept"]} == {2, 3, 5, 7, 8, 9}
    assert {r["group_size"] for r in rows if r["doc_id"] == 5} == {4}
    kept = exact_dedup(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 7, 8, 9]
    assert exact_groups(no_docs).count() == 0 and exact_dedup(no_docs).count() == 0


def test_same_length_and_beginning_is_not_equal(docs_of):
    start = "x" * 200
    rows = exact_groups(docs_of([(1, start + "a"), (2, start + "b"), (3, start + "A"), (4, "É"), (5, "é")])).collect()
    assert {r["doc_id"]: r["keep_id"] for r in rows} == {1: 3, 2: 2, 3: 3, 4: 4, 5: 5}


def test_a_hot_group_stays_whole(docs_of):
    rows = exact_groups(docs_of([(k, "same" if k % 3 == 0 else f"t{k}") for k in range(900)])).collect()
    hot = [r for r in rows if r["doc_id"] % 3 == 0]
    assert {r["keep_id"] for r in hot} == {897} and {r["group_size"] for r in hot} == {300} and sum(r["kept"] for r in hot) == 1


def brute_fingerprint(text):
    words = folded(text).split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.nonzero(np.bitwise_count(values[i] ^ values) <= radius)[0]:
            parent[find(i)] = find(int(j))
    low = {}
    for k, i in enumerate(ids):
        low[find(k)] = min(low.get(find(k), i), i)
    return {i: low[find(k)] for k, i in enumerate(ids)}


def test_simhash_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    ids, prints = [d["doc_id"] for d in docs], [brute_fingerprint(d["text"]) for d in docs]
    expected = brute_components(ids, prints, 2)
    rows = queries.QUERIES["op6_simhash_tiles"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{p:016x}", expected[i]) for i, p in zip(ids, prints)
    }


def test_links_of_crowded_tiles(spark):
    """Many fingerprints around few centres, in tiles of four."""
    rng = np.random.default_rng(8)
    values = set()
    for centre in rng.integers(0, 2**63, 6):
        for _ in range(40):
            value = int(centre)
            for bit in rng.integers(0, 63, 2):
                value ^= 1 << int(bit)
            values.add(value)
    ordered = sorted(values)
    found = components(simhash.links(spark.createDataFrame([(v,) for v in ordered], "fp long"), 2, 4))
    roots = {r["node"]: r["root"] for r in found.collect()}
    expected = brute_components(ordered, ordered, 2)
    assert {v: roots.get(v, v) for v in ordered} == expected


def test_simhash_of_odd_rows(odd_docs, no_docs):
    rows = simhash.simhash_components(odd_docs).collect()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5, None)} == {4}
    kept = simhash.simhash_dedup(odd_docs)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 4, None, 7, 8, 9}
    assert simhash.simhash_components(no_docs).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in rows} == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def prose(rng, words):
    out = []
    while len(out) < words:
        sentence = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(3, 12))]
        out += [sentence[0].capitalize(), *sentence[1:-1], sentence[-1] + "."]
    return out


def test_planted_passages_are_caught_and_clean_texts_left_alone(docs_of):
    rng = random.Random(6)
    rows, planted = [], set()
    shared = [prose(rng, rng.randint(55, 90)) for _ in range(12)]
    for k in range(200):
        words = prose(rng, rng.randint(60, 400))
        if k % 4 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = shared[k // 4 % 12]
            planted.add(k)
        rows.append((k, " ".join(words)))
    found = passages.repeated_passages(docs_of(rows)).collect()
    assert {r["doc_id"] for r in found} == planted
    texts = dict(rows)
    for r in found:
        span = texts[r["doc_id"]].lower().split()[r["first_word"] : r["end_word"]]
        first = texts[r["component_id"]].lower().split()
        kept = {tuple(first[k : k + 3]) for k in range(len(first))}
        same = [tuple(span[k : k + 3]) in kept for k in range(len(span) - 2)]
        assert sum(same) >= 0.85 * len(same)  # words at the edges may differ
    # the first document of a passage keeps it whole, all others lose it, but for words at its edges
    assert {r["doc_id"] for r in found if r["removed"]} == planted - {4 * k for k in range(12)}


def test_similar_paragraphs_are_linked(docs_of):
    """One changed word at the edge leaves a similarity above the threshold."""
    rng = random.Random(9)
    passage = prose(rng, 24)[:24]
    other = [*passage[:-1], "changed."]
    words = np.array([[hash(w) & 0xFFFFFFFF for w in p] for p in (passage, other, prose(rng, 30)[:24])], np.uint64)
    ids = passages.shingle_ids(words)
    left, right = passages.pairs_within(np.array([3]), np.array([0]))
    assert list(zip(left.tolist(), right.tolist(), passages.similar_pairs(*ids, left, right).tolist())) == [(0, 1, True), (0, 2, False), (1, 2, False)]
    left, right = passages.pairs_within(np.array([2, 3]), np.array([1, 2]))
    assert list(zip(left.tolist(), right.tolist())) == [(0, 1), (2, 4), (3, 4)]


@pytest.mark.parametrize("small", [32, 1])
def test_links_of_paragraphs_equal_brute_force(spark, monkeypatch, small):
    """Paragraphs that share a band and are similar are connected, in bands of any size and with or without leaders."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**32, (12, passages.LENGTH), dtype=np.uint64)
    words = np.repeat(base, [60, 40, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10], axis=0)
    for row in words:
        row[rng.choice([0, 1, 22, 23], rng.integers(0, 3))] = rng.integers(0, 2**32)
    words = np.unique(words, axis=0)
    keys = passages.band_keys((words << np.uint64(32)).ravel(), np.arange(len(words)) * passages.LENGTH)
    left, right = np.triu_indices(len(words), 1)
    share = (keys[left] == keys[right]).any(axis=1)
    links = share & passages.similar_pairs(*passages.shingle_ids(words), left, right)
    expected = simhash.forest(len(words), left[links], right[links])
    monkeypatch.setattr(passages, "SMALL", small)
    monkeypatch.setattr(passages, "TILE", 8)
    hits = spark.createDataFrame([(k, bytearray(w.astype("<u4").tobytes())) for k, w in enumerate(words)], "whole long, words binary")
    roots = {r["node"]: r["root"] for r in passages.components(passages._near_links(hits)).collect()}
    assert [roots.get(k, k) for k in range(len(words))] == expected.tolist() and links.sum() > 300


def test_only_paragraphs_that_share_a_band_are_sent_to_comparisons(spark, monkeypatch):
    """Words of single paragraphs stay; leaders and tiles get those of larger bands alone."""
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**32, (340, passages.LENGTH), dtype=np.uint64)
    words[300:] = words[300]
    words[300:, 0] = rng.integers(0, 2**32, 40)
    words[298, 1:] = words[299, 1:]
    sent = []
    compared = passages._compared
    monkeypatch.setattr(passages, "_compared", lambda groups, table: sent.append({r["u"] for r in table.select("u").collect()}) or compared(groups, table))
    hits = spark.createDataFrame([(k, bytearray(w.astype("<u4").tobytes())) for k, w in enumerate(words)], "whole long, words binary")
    roots = {r["node"]: r["root"] for r in passages.components(passages._near_links(hits)).collect()}
    assert roots == {298: 298, 299: 298} | {k: 300 for k in range(300, 340)}
    assert sent[0] == {298, 299, *range(300, 340)} and len(sent) == 4 and all(s == {*range(300, 340)} for s in sent[1:])


def test_the_bit_table_follows_the_number_of_repeated_keys(docs_of):
    """All repeated keys are found in it, and hardly another one, whatever their number."""
    rng = random.Random(8)
    for count in (1, 50):
        texts = [" ".join(prose(rng, 300)) for _ in range(count)]
        table = passages._bit_table(docs_of([(k, t) for k, t in enumerate(texts * 2)]).selectExpr("text AS __text"))
        keys = []
        for text in texts:
            hashes, begins, offsets = passages.word_hashes([text])
            keys += set(passages.band_keys(hashes, passages.paragraph_starts(hashes, begins, offsets)).ravel().tolist())
        assert passages._in_table(table, np.array(keys)).all()
        assert len(set(keys)) * passages.KEY_BITS <= len(table) * 8 < max(passages.PAGE + 1, 2 * len(set(keys)) * passages.KEY_BITS)
        others = np.random.default_rng(count).integers(-(2**63), 2**63 - 1, 100_000)
        assert passages._in_table(table, others).mean() < 0.01


def test_similarity_is_of_sets(docs_of):
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, (60, 24)).astype("<u4")
    left, right = np.triu_indices(60, 1)
    found = passages.similar_pairs(*passages.shingle_ids(words), left, right, 0.5)
    sets = [set(zip(*(w[k : k + 20] for k in range(5)))) for w in words.tolist()]
    assert found.tolist() == [len(sets[i] & sets[j]) >= 0.5 * len(sets[i] | sets[j]) for i, j in zip(left, right)]


def test_bands_are_tuned_for_recall():
    assert passages.tune_bands(0.8, 0.98, 2) == 4


def test_passages_of_odd_rows(odd_docs, no_docs):
    rows = passages.repeated_passages(odd_docs).collect()
    assert rows == [] and passages.repeated_passages(no_docs).count() == 0


def test_passages_within_one_document_are_its_own(docs_of):
    text = " ".join(prose(random.Random(3), 60))
    assert passages.repeated_passages(docs_of([(1, text + " " + text), (2, "short")])).count() == 0
    assert {r["doc_id"] for r in passages.repeated_passages(docs_of([(1, text), (2, text)])).collect()} == {1, 2}


@pytest.mark.parametrize("name", ["op7_exact_dedup"])
def test_digest_is_of_the_folded_text(spark, name):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES[name](spark, FOLDER).collect()
    assert all(r["text_sha256"] == sha256(folded(texts[r["doc_id"]])).hexdigest() for r in rows)


@pytest.mark.parametrize("words", [48, 51, 60])
def test_every_copied_run_shares_a_paragraph(words):
    """Without any punctuation, in other surroundings: a run of a window and a paragraph is never missed."""
    rng = random.Random(words)
    for _ in range(300):
        passage = [f"w{rng.randrange(5000)}" for _ in range(words)]
        texts = [" ".join([f"x{rng.randrange(5000)}" for _ in range(rng.randint(0, 60))] + passage + [f"y{rng.randrange(5000)}" for _ in range(rng.randint(0, 60))]) for _ in range(2)]
        found = []
        for text in texts:
            hashes, begins, offsets = passages.word_hashes([text])
            starts = passages.paragraph_starts(hashes, begins, offsets)
            found.append({tuple(hashes[s : s + passages.LENGTH].tolist()) for s in starts})
        assert found[0] & found[1]
