"""The language model against sums over all paths, and its contract against plain counting."""

from itertools import product
from math import log10
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hmm, queries


@pytest.fixture
def model():
    rng = np.random.default_rng(4)
    draw = lambda *shape: rng.gamma(1.0, 1.0, shape)
    start, inner, moves, emit = draw(3), draw(3), draw(3, 3), draw(7, 3)
    return hmm.Model(start / start.sum(), inner / inner.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(0))


def by_paths(model, ids, start=None):
    start = model.start if start is None else start
    total = 0.0
    for path in product(range(3), repeat=len(ids)):
        p = start[path[0]] * model.emit[ids[0], path[0]]
        for t in range(1, len(ids)):
            p *= model.moves[path[t - 1], path[t]] * model.emit[ids[t], path[t]]
        total += p
    return total


def test_likelihood_is_the_sum_over_paths(model):
    texts = [[0, 3, 2, 6], [1], [5, 5, 4, 3, 2, 1, 0]]
    ids = np.array(sum(texts, []))
    offsets = np.cumsum([0, *map(len, texts)])
    got = hmm.log_likelihood(model, ids, offsets)
    assert got == pytest.approx([log10(by_paths(model, t)) for t in texts])


def test_long_texts_score_as_step_by_step(model, monkeypatch):
    rng = np.random.default_rng(1)
    offsets = np.cumsum([0, 3 * hmm.BLOCK + 11, 7, 2 * hmm.BLOCK + 1, 5 * hmm.BLOCK + 1])
    ids = rng.integers(0, 7, offsets[-1])
    in_blocks = hmm.log_likelihood(model, ids, offsets)
    monkeypatch.setattr(hmm, "BLOCK", 10**6)
    assert in_blocks == pytest.approx(hmm.log_likelihood(model, ids, offsets))


def test_expected_counts_are_the_posterior(model):
    ids = np.array([0, 3, 2, 5, 1])
    weights, moves, first, inner = hmm.expected_counts(model, ids, np.array([0, 3]), np.array([3, 2]), np.array([True, False]))
    assert weights.sum() == pytest.approx(5) and moves.sum() == pytest.approx(3)
    total = by_paths(model, ids[:3])
    for state in range(3):
        kept = np.zeros(3)
        kept[state] = model.start[state]
        assert first[state] == pytest.approx(by_paths(model, ids[:3], kept) / total)


def test_rounds_raise_the_likelihood(spark, docs_of):
    rng = np.random.default_rng(2)
    kinds = ["abcdef", "ghijkl"]
    texts = [" ".join(rng.choice(list(kinds[k % 2]), 60)) for k in range(80)]
    out = hmm.hmm_scores(docs_of(list(enumerate(texts))), F.col("doc_id") % 10 == 0, states=2)
    rows = out.collect()
    assert len(rows) == 80
    assert sum(r["score"] for r in rows if r["held_out"]) > 0.85 * sum(r["base_score"] for r in rows if r["held_out"])


def test_contract_by_plain_counting(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in queries.QUERIES["op1_hidden_markov"](spark, folder).collect()}
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    counts = {}
    for i, words in texts.items():
        if crc32(str(i).encode()) % 10:
            for w in [*words, b""]:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    assert rows.keys() == texts.keys()
    for i, words in texts.items():
        tokens = [*words, b""]
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(w in counts for w in tokens), total)
        assert r["held_out"] == (crc32(str(i).encode()) % 10 == 0)
        base = sum(log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        assert r["base_score"] == pytest.approx(base)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_outside_the_head_meet_their_counts(docs_of):
    texts = [(k, f"common rare{k % 7} common") for k in range(30)]
    small = {r["doc_id"]: r for r in hmm.hmm_scores(docs_of(texts), F.lit(False), head=2).collect()}
    large = {r["doc_id"]: r for r in hmm.hmm_scores(docs_of(texts), F.lit(False)).collect()}
    for k in small:
        assert small[k]["base_score"] == pytest.approx(large[k]["base_score"]) and small[k]["n_known"] == large[k]["n_known"] == 4


def test_odd_rows(odd_docs, no_docs):
    out = hmm.hmm_scores(odd_docs.withColumn("row", F.lit("x")), F.lit(False)).collect()
    assert len(out) == odd_docs.count()
    assert {r["n_tokens"] for r in out if r["doc_id"] in (1, 2, 3)} == {1}
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in out)
    assert hmm.hmm_scores(no_docs, F.lit(False)).count() == 0
    assert all(r["n_known"] == 0 for r in hmm.hmm_scores(odd_docs, F.lit(True)).collect())


def test_three_texts_keep_their_states_and_layout_does_not_matter(docs_of):
    """No round counts a part of the texts only: few texts train different states, however the rows are laid out."""
    texts = ["a b a b c", "x y z x y", "a b x y"]
    docs = docs_of([(k, t) for k, t in enumerate(texts)])
    scores = [{r["doc_id"]: r["score"] for r in hmm.hmm_scores(docs.repartition(n), F.lit(False)).collect()} for n in (1, 7)]
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)
    models = []
    run = hmm.baum_welch_round
    try:
        hmm.baum_welch_round = lambda *a: models.append(run(*a)) or models[-1]
        hmm.hmm_scores(docs, F.lit(False)).count()
    finally:
        hmm.baum_welch_round = run
    assert len(models) == hmm.ROUNDS and np.ptp(models[-1].emit, axis=1).max() > 1e-6


def test_a_round_without_tokens_changes_nothing(spark, docs_of):
    vocab = hmm.vocabulary(hmm.word_counts(docs_of([(1, "a b c")]), "text"), 8)
    model = hmm.initial_model(vocab.base, 2)
    empty = spark.createDataFrame([], "row long, ids array<int>")
    assert hmm.baum_welch_round(empty, model, vocab) is model
