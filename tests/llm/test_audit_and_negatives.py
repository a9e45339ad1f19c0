"""Filter interaction audit and hard negatives against plain Python, and on odd tables."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import explained
from tidemark.llm import filter_audit, hard_negatives, queries
from tidemark.llm.hard_negatives import PackedTree, exact_type, integers, search


def brute_masks(rows):
    out = []
    for doc_id, text, *_ in rows:
        body = text or ""
        words = [w for w in body.replace("\x0b", " ").replace("\f", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
        copy = any(o is not None and doc_id is not None and o < doc_id and (t or "") == body for o, t, *_ in rows)
        capitals = sum("A" <= c <= "Z" for c in body)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * len(body), any(c in "#$%&*|" for c in body), copy]
        out.append({x for x, f in zip("ABCDE", fails) if f})
    return out


def brute_audit(rows, good, toxic):
    """``rows`` are ``(doc_id, text, part)``."""
    masks = brute_masks(rows)
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], m) for r, m in zip(rows, masks) if (r[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = list(mine)
            for step, letter in enumerate(order, 1):
                removed = [(i, m) for i, m in alive if letter in m]
                gone = [m for i, m in mine if letter in m]
                alive = [(i, m) for i, m in alive if letter not in m]
                total[letter] += len(removed)
                out[part, "".join(order), step] = [
                    len(alive), len(removed), len(gone) - len(removed), sum(m == {letter} for m in gone),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed), letter,
                ]
        for key, value in out.items():
            if key[0] == part:
                value[6] = total[key[1][key[2] - 1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    rows = filter_audit.audit(filter_audit.mask_cells(docs, labels)).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[m] for m in (*filter_audit.METRICS, "shapley")) for r in rows}


def test_audit_matches_all_orders(spark):
    long_text = " ".join(f"w{k}" for k in range(220))
    rows = [
        (1, long_text, "en"), (2, long_text, "de"), (3, "# few", "en"), (4, "A B C", "en"), (4, "A B C", "en"), (5, "a a a " * 80, None),
        (6, None, "en"), (7, "", "en"), (None, long_text, "de"), (8, long_text + " | X", ""), (9, "x " * 900_00, "fr"), (2, "# few", "fr"), (10, long_text, "de"),
    ]
    docs = spark.createDataFrame([(a, b, c, "s", 1, True) for a, b, c in rows], "doc_id long, text string, lang string, __part string, mask int, good boolean")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert audited(docs, labels) == brute_audit(rows, {1, 2, 4}, {2, 4})
    assert audited(docs.filter("false"), labels) == {}
    assert len(audited(docs, labels.filter("false"))) == 600 * 4


def test_audit_recursion_is_small_and_plan_is_native(spark):
    steps = filter_audit.filter_steps(spark)
    assert steps.count() == 32 * (5 + 20 + 60 + 120 + 120)
    cells = filter_audit.mask_cells(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    plan = explained(cells)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def brute_negatives(rows, k=5):
    out = []
    for i, label, v in rows:
        if i % 100:
            continue
        scores = sorted((-max(-(2**63), min(2**63 - 1, sum(map(int.__mul__, v, w)))), j, m) for j, m, w in rows if j != i)
        for s, p, _ in [x for x in scores if x[2] == label][:k]:
            fits = [x for x in scores if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(i, p, rank, j, -s, -n) for rank, (n, j, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, m, [float(x) for x in v], "x") for i, m, v in rows], "vec_id long, label int, vector array<double>, rank string")
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **options).collect()))


@pytest.mark.parametrize("largest", [2, 300, 1 << 20, 1 << 40])
def test_negatives_match_brute_force(spark, monkeypatch, largest):
    """Ties, many equal vectors, several blocks and leaves, and numbers beyond each float type."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", (100, 100))
    rng = np.random.default_rng(largest)
    rows = [(int(i), int(rng.integers(0, 3)), [int(x) for x in rng.integers(-largest, largest + 1, 4)]) for i in range(0, 1000, 2)]
    for k in range(0, 150):
        rows[k] = (rows[k][0], rows[k][1], rows[200][2])
    want = brute_negatives(rows)
    assert mined(spark, rows) == want and want


def test_tree_bounds_and_pruning():
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (6, 12))
    labels = rng.integers(0, 6, 4000)
    matrix = (centres[labels] + rng.integers(-9, 10, (4000, 12))).astype(float)
    tree = PackedTree(np.arange(4000), labels, matrix, leaf=64, fanout=4)
    anchor = matrix[17]
    tree.typed(12, exact_type(tree.largest, 12, np.abs(anchor).max()))
    low, high = tree.intervals(integers(anchor[None], tree.form[1]))
    for (a, b), least, most in zip(tree.spans, low[0], high[0]):
        scores = tree.rows[a:b] @ anchor
        assert least <= scores.min() and scores.max() <= most
    assert sorted(tree.ids.tolist()) == list(range(4000)) and max(b - a for a, b in tree.spans) <= 64
    scores = matrix @ anchor
    opened = []
    spans = tree.spans
    tree.spans = type("Counted", (list,), {"__getitem__": lambda s, k: opened.append(k) or list.__getitem__(s, k)})(spans)
    found = search(tree, anchor, 17, int(labels[17]), low[0], high[0], [(-math.inf, math.inf)], 5, True)[0]
    mine = [i for i in np.lexsort((np.arange(4000), -scores)) if labels[i] == labels[17] and i != 17][:5]
    assert [i for _, i in found] == mine and len(opened) < len(spans) / 3


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [2.0, 2.0]), (1, 1, [2.0, 2.0]), (2, 2, [2.0, 1.5]), (3, None, [9.0, 9.0]), (4, 2, None), (5, 2, [nan, 1.0]), (6, 1, [inf, 1.0]),
        (None, 2, [2.0, 2.0]), (7, 2, [None, 1.0]), (8, 2, [3.0]), (9, 2, []), (100, 3, []), (200, 4, [5.0, 5.0, 5.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    got = sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()))
    assert got == [(0, 1, 1, 2, 6, 5)]
    assert hard_negatives.hard_negatives(df.filter("false"), F.lit(True)).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_query_floors_and_shifts_labels(spark, folder):
    rows = [(0, [0.011, -0.001], 9), (7, [0.02, 0.0], 9), (14, [0.5, 0.25], 0), (3, [0.02, 0.004], 5), (100, [-1.0, 0.0], 5)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    got = sorted(map(tuple, queries.QUERIES["op13_hard_negatives"](spark, folder).collect()))
    moved = [(i, (m + 1) % 10 if i % 7 == 0 else m, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, m in rows]
    assert got == brute_negatives(moved) and got
