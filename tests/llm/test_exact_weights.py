"""Mixing against the weights as they were given, over many slots."""

from collections import Counter
from fractions import Fraction

import pytest

from tidemark.llm import mixing


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.7, "b": 0.2999, "c": 0.0001}])
def test_no_source_is_a_block_off_its_given_weight(docs_of, weights):
    sources = [s for s, w in weights.items() for _ in range(round(w * 20_000))]
    rows = mixing.mix(docs_of([(k, "t", s) for k, s in enumerate(sources)]), weights=weights, block_rows=1).collect()
    total = sum(map(Fraction, weights.values()))
    share = {s: Fraction(w) / total for s, w in weights.items()}
    assert all(r["target_weight"] == float(share[r["source"]]) and r["release"] <= r["slot"] < r["deadline"] for r in rows)
    at = {r["slot"]: r["source"] for r in rows}
    assert len(at) == len(rows) == 20_000
    ends = min(max(slot for slot, s in at.items() if s == source) for source in share)
    assert ends > 10_000
    done = Counter()
    for slot in range(ends + 1):
        done[at.get(slot)] += 1
        assert all(abs(done[s] - w * (slot + 1)) < 1 for s, w in share.items())


def test_sources_without_weight_follow_after_the_others(docs_of):
    rows = mixing.mix(docs_of([(k, "t", "abc"[k % 3]) for k in range(300)]), weights={"a": 1, "b": 0}, block_rows=5).collect()
    slots = {s: [r["slot"] for r in rows if r["source"] == s] for s in "abc"}
    assert len(rows) == 300 and max(slots["a"]) < min(slots["b"] + slots["c"])
    assert {r["target_weight"] for r in rows if r["source"] != "a"} == {0.0}


@pytest.mark.parametrize("frame", [3, 16])
def test_frames_that_disagree_are_played_again(spark, monkeypatch, frame):
    """Many light sources and short frames: the schedule is valid and one at any length of the frames."""
    monkeypatch.setattr(mixing, "FRAME", frame)
    played = []
    play = mixing._played
    monkeypatch.setattr(mixing, "_played", lambda frames: played.append(frames.select("frame", "back").collect()) or play(frames))
    parts = {f"+{k:02d}": p for k, p in enumerate([1, 1, 2, 3, 5, 8, 13, 97, 210, 331, 333])}
    blocks = {k: p * 400 // 1004 + 1 for k, p in parts.items()}
    shares = spark.createDataFrame([(k, p, blocks[k]) for k, p in parts.items()], "__key string, parts long, blocks long")
    rows = mixing.block_schedule(shares.selectExpr("__key", "CAST(parts AS DECIMAL(25,0)) AS parts", "blocks")).collect()
    assert sorted((r["__key"], r["block"]) for r in rows) == sorted((k, i) for k, n in blocks.items() for i in range(n))
    assert len({r["at"] for r in rows}) == len(rows) and all(r["release"] <= r["at"] < r["deadline"] for r in rows)
    assert all(r["release"] == r["block"] * 1004 // parts[r["__key"]] and r["deadline"] == -(-(r["block"] + 1) * 1004 // parts[r["__key"]]) for r in rows)
    assert frame > 3 or len(played) > 1 and all(r["back"] > 1 for again in played[1:] for r in again)
