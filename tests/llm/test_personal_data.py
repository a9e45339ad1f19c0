"""Personal data: base forms against the plain patterns, the tagger's gradients, held-out recall, odd rows."""

import re
from random import Random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii, queries, tagger

FOLDER = "/root/testdata/sf0.001"
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def passes(kind, piece):
    digits = [int(c) for c in piece if c.isdigit()]
    if kind == 1:
        return all(int(p) <= 255 for p in piece.split("."))
    if kind == 2:
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def brute(text):
    found = [(*m.span(), k) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(k, m.group())]
    return sorted(found, key=lambda s: (s[0], s[2]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ09._%+-@( )é\n1", max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999", ".", "@", "7", " ", "-", "x_", "\n", "300.1.1.1"]), max_size=14))
def test_base_spans_of_touching_values(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute(text)


def test_base_spans_are_linear():
    assert pii.base_spans("a" * 400_000) == [] == pii.base_spans("1" * 400_000)
    assert len(pii.base_spans("a.b@c.de " * 20_000)) == 20_000


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v + 0.1 * rng.standard_normal(v.shape) for k, v in tagger.new_weights(2, rng, np.float64).items()}
    codes = rng.integers(0, 9, (3, 7))
    tags = np.stack([tagger.tags_of(7, s) for s in ([(1, 3, 0), (4, 7, 1)], [], [(0, 2, 1)])])
    _, grad = tagger.loss_and_gradient(w, codes, tags, 2)
    for name, values in w.items():
        for _ in range(3):
            at = tuple(int(rng.integers(0, 9 if name == "embed" and k == 0 else n)) for k, n in enumerate(values.shape))
            sides = []
            for step in (1e-5, -1e-5):
                values[at] += step
                sides.append(tagger.loss_and_gradient(w, codes, tags, 2)[0])
                values[at] -= step
            assert grad[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6), name


def test_decoding_is_the_best_path():
    """Against all paths, for texts of several lengths decoded together."""
    rng = np.random.default_rng(3)
    w = tagger.new_weights(1, rng)
    w["moves"] = rng.standard_normal(w["moves"].shape).astype(np.float32)
    texts = ["a1@b", "x", "77"]
    moves = w["moves"] + tagger.barred(1)
    for text, (tags, _) in zip(texts, tagger.decode(w, texts, 1)):
        scores = tagger.emissions(w, tagger.characters(text)[None], np.array([len(text)]))[0]
        paths = {}
        for path in np.ndindex(*[3] * len(text)):
            paths[path] = moves[-1][path[0]] + sum(scores[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
        assert tuple(tags.tolist()) == max(paths, key=paths.get)


def test_spans_and_tags_are_inverse():
    spans = [(0, 2, 1), (2, 3, 1), (5, 9, 3)]
    assert tagger.spans_of(tagger.tags_of(9, spans)) == spans


def test_windows_cover_every_trigger():
    rng = Random(1)
    for _ in range(50):
        text = "".join(rng.choice("ab c" * 12 + "0@") for _ in range(rng.randint(0, 600)))
        windows = pii.windows_of(text)
        for m in re.finditer("[0-9@]", text):
            inside = [w for w in windows if w[0] <= m.start() < w[1]]
            assert inside and any(w[0] <= max(0, m.start() - 32) and min(len(text), m.start() + 32) <= w[1] for w in inside)
        assert all(b - a <= pii.WINDOW for a, b, _, _ in windows)


def test_reconciling_pieces():
    text = "call 212-555-0100 or 212-555-0199 or 212-555-0111"
    a, b, c = (m.span() for m in re.finditer(r"\d{3}-\d{3}-\d{4}", text))
    whole = [(*a, 3, 5.0, False, False), (b[0], b[0] + 6, 3, 2.0, False, True), (b[0] + 3, b[1], 3, 2.0, True, False)]
    assert pii.reconciled(text, whole, []) == [(*a, 3), (*b, 3)]  # the cut halves are one
    assert pii.reconciled(text, whole, [(*a, 3)]) == [(*b, 3)]  # base spans stay alone
    assert pii.reconciled(text, [(a[0], a[0] + 8, 3, 9.0, False, False)], []) == []  # cuts a number
    assert pii.reconciled("ids 4111111111111112 x", [(4, 20, 2, 9.0, False, False)], []) == []  # check digit


@pytest.fixture(scope="module")
def trained(spark):
    return pii.train_tagger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_recall_and_clean_texts(spark, trained):
    rows = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id BETWEEN 5000 AND 5600").collect()]
    texts, spans = pii.labelled([t[len(t) // 2 : len(t) // 2 + pii.WIDTH] for t in rows], seed=99)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: set(r["spans"].split(",")) - {""} for r in pii.find_pii(docs, trained).collect()}
    whole = [{f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in s if pii.accepted(t, a, b, k)} for t, s in zip(texts, spans)]
    caught, planted = sum(len(w & got[i]) for i, w in enumerate(whole)), sum(map(len, whole))
    assert planted > 500 and caught / planted > 0.9
    assert caught / sum(map(len, got.values())) > 0.9
    clean = spark.createDataFrame([(i, re.sub("[0-9@+]", "", t)) for i, t in enumerate(rows)], "doc_id long, text string")
    assert pii.find_pii(clean, trained).filter("spans <> ''").count() == 0


def test_query_matches_brute_force_and_keeps_base(spark):
    import hashlib

    rows = {r["doc_id"]: r for r in queries.QUERIES["op11_personal_data"](spark, FOLDER).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = brute(text)
        names = [f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == n for s in base) for n in range(4)]
        all_spans = [s for s in rows[i]["spans"].split(",") if s]
        assert set(names) <= set(all_spans) and len(all_spans) == len(names) + rows[i]["n_added"]


def test_odd_rows(spark, odd_docs, no_docs, trained):
    clash = odd_docs.withColumnRenamed("lang", "spans").withColumnRenamed("source", "n_card")
    found = pii.find_pii(clash, trained)
    assert found.count() == 10 and len(found.columns) == len(set(found.columns))
    assert {r["n_email"] for r in found.collect()} == {0}
    assert pii.find_pii(no_docs, trained).count() == 0 and pii.train_tagger(no_docs) == {}
    assert pii.train_tagger(odd_docs).keys() == trained.keys()
    values = spark.createDataFrame([(1, "mail a.b@c.de now"), (1, "mail a.b@c.de now"), (2, None)], "doc_id long, text string")
    assert sorted(r["spans"] for r in pii.find_pii(values, {}).collect()) == ["", "email:5:13", "email:5:13"]
