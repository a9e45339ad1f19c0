"""The mixture in the rows that the pipeline returns."""

from collections import Counter

import corpus_pipeline
from tidemark.llm.mixing import BLOCK_ROWS
from tidemark.session import cut

FOLDER = "/root/testdata/sf0.01"


def test_the_result_realises_the_target_weights(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = cut(corpus_pipeline.encode_tokens(spark, cut(docs.repartition(7)), FOLDER)).drop("ids").collect()
    assert len(rows) == docs.count() and len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    sizes = Counter(r["source"] for r in rows)
    total = sum(n**0.5 for n in sizes.values())
    at = {r["slot"]: r["source"] for r in rows}
    last = {s: max(slot for slot, other in at.items() if other == s) for s in sizes}
    full = min(last.values())
    assert full > len(sizes)
    done = Counter()
    for slot in range(full + 1):
        done[at.get(slot)] += 1
        assert all(abs(done[s] - sizes[s] ** 0.5 / total * (slot + 1)) < 1.1 for s in sizes)
    assert all(n <= BLOCK_ROWS for n in Counter(r["slot"] for r in rows).values())


def test_run_returns_the_mixture(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").drop("ids").collect()
    assert rows and all(r["slot"] >= 0 and 0 <= r["place"] < BLOCK_ROWS for r in rows)
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
