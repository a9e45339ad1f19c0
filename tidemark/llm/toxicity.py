"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other training texts are unlabelled, whatever their label
says. With the class prior ``p`` the risk of a classifier is estimated as

    p * loss(positives, +1) + max(0, loss(unlabelled, -1) - p * loss(positives, -1)).

Where the second part falls below zero, the classifier has begun to fit the unlabelled texts that are in
fact toxic, and its step goes back up. Several linear models over words and word beginnings are trained in
tasks of their own, each on its part of a bounded sample, and their logits are averaged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches, without
from tidemark.session import cut

POSITIVES = 8_000  # confirmed toxic texts in the sample, about, at most
UNLABELLED = 24_000  # other texts in the sample, about, at most
MODELS = 3  # each leaves out another third of the sample
FEATURES = 20_000  # at most
STEMS = (4, 5)  # letters of the word beginnings
RARE = 3  # confirmed texts that a feature must occur in
LIFT, DEVIATIONS = 2.0, 1.64  # a feature's rate among the positives is surely this many times the unlabelled rate
STEPS = 400
RATE = 0.1
DECAY = 1e-4
EDGES = ".,;:!?\"'()[]{}<>*#|%&$-_/\\"


def features(text: str | None) -> set[str]:
    """Words without their edges' punctuation, and the beginnings of longer words."""
    words = {w.strip(EDGES) for w in (text or "").lower().split()}
    found = set(words)
    for size in STEMS:
        found.update(w[:size] + "-" for w in words if len(w) >= size)
    found.discard("")
    return found


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int) -> np.ndarray:
    """Weights of one model by full-batch steps on the risk, the bias last. Texts are arrays of feature numbers."""

    def matrix(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        rows = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        return rows, np.concatenate(texts).astype(np.int64), len(texts)

    parts = [matrix(x) for x in (positives, unlabelled)]
    weights, bias = np.zeros(size), math.log(prior / (1 - prior))
    moment, spread = np.zeros(size + 1), np.zeros(size + 1)

    def logits(part) -> np.ndarray:
        rows, columns, n = part
        return np.bincount(rows, weights[columns], n) + bias

    def slope(part, by_text: np.ndarray) -> np.ndarray:
        """The gradient over weights and bias from the derivative by text."""
        rows, columns, n = part
        return np.append(np.bincount(columns, by_text[rows], size), by_text.sum()) / n

    for step in range(1, STEPS + 1):
        p, u = logits(parts[0]), logits(parts[1])
        as_toxic = slope(parts[0], -1 / (1 + np.exp(p)))
        clean_p = slope(parts[0], 1 / (1 + np.exp(-p)))
        clean_u = slope(parts[1], 1 / (1 + np.exp(-u)))
        negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        gradient = prior * as_toxic + (clean_u - prior * clean_p) if negative >= 0 else prior * clean_p - clean_u
        gradient += DECAY * np.append(weights, 0.0)
        moment = 0.9 * moment + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], float(bias - move[-1])
    return np.append(weights, bias)


def _share(df: DataFrame, wanted: int) -> float:
    n = df.count()
    return min(1.0, wanted / n) if n else 0.0


def _drawn(key: Column, salt: str, share: float) -> Column:
    """Whether a row is in a sample of this share: a fixed part of the hashes of its id."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "toxic"
) -> dict[str, float]:
    """Averaged weights by feature, from ``docs`` and the rows of ``labels`` that confirm toxic texts.

    The prior is the share of toxic rows among ``labels``. Labels without a text and NULL labels count for
    nothing but the prior; without a confirmed text there is no model: the result is empty.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    stated = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("int")).alias("toxic")).first()
    if not stated["toxic"]:
        return {}
    prior = min(0.5, stated["toxic"] / stated["n"])
    confirmed = known.filter(F.col(label) == 1).select(F.col(id_column).alias("__id")).distinct()
    chosen = confirmed.filter(_drawn(F.col("__id"), "positive", _share(confirmed, POSITIVES)))
    rows = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("text"))
    in_sample = _drawn(F.col("__id"), "unlabelled", _share(rows.select("__id"), UNLABELLED)).cast("boolean")
    sample = cut(
        rows.join(F.broadcast(chosen.withColumn("positive", F.lit(True))), "__id", "left")  # about POSITIVES ids
        .select("__id", "text", F.coalesce("positive", F.lit(False)).alias("positive"), in_sample.alias("unlabelled"))
        .filter("positive OR unlabelled")
    )
    names = _select(sample)
    index = {name: k for k, name in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(index)  # FEATURES at most

    def number(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [sorted(known[f] for f in features(v.as_py()) & known.keys()) for v in batch.column(1)]
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(found, pa.list_(pa.int32()))]
            yield pa.record_batch(columns, names=["__id", "positive", "unlabelled", "found"])

    kind = sample.schema["__id"].dataType.simpleString()
    numbered = map_batches(sample, number, f"__id {kind}, positive boolean, unlabelled boolean, found array<int>")
    third = F.pmod(F.xxhash64("__id"), F.lit(MODELS))
    dealt = numbered.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(MODELS - 1)))).filter(F.col("model") != third)

    def train(table: pa.Table) -> pa.Table:
        found = [np.array(v.as_py(), np.int64) for v in table["found"]]
        sides = [[x for x, inside in zip(found, table[side].to_pylist()) if inside] for side in ("positive", "unlabelled")]
        weights = fit(*sides, prior, len(index)) if all(sides) else np.zeros(0)
        return pa.table({"at": pa.array(np.arange(len(weights))), "weight": pa.array(weights, pa.float64())})

    trained = dealt.groupBy("model").applyInArrow(train, "at long, weight double")
    means = trained.groupBy("at").agg(F.avg("weight").alias("weight")).collect()  # FEATURES + 1 at most
    return {(names[r["at"]] if r["at"] < len(names) else ""): r["weight"] for r in means}


def _select(sample: DataFrame) -> list[str]:
    """The features that mark positives: texts are counted by feature in every task, then summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, positive, unlabelled in zip(batch.column(0), batch.column(1), batch.column(2)):
                found = features(text.as_py())
                if positive.as_py():
                    seen[True].update(found)
                if unlabelled.as_py():
                    seen[False].update(found)
        both = [*seen[True], *(f for f in seen[False] if f not in seen[True])]
        counts = [pa.array([seen[side][f] for f in both], pa.int64()) for side in (True, False)]
        yield pa.record_batch([pa.array(both, pa.string()), *counts], names=["feature", "p", "u"])

    sizes = sample.agg(F.count_if("positive"), F.count_if("unlabelled")).first()
    counted = map_batches(sample.select("text", "positive", "unlabelled"), count, "feature string, p long, u long")
    summed = counted.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).filter(F.col("p") >= RARE)
    lift = F.log(F.col("p") / F.lit(float(sizes[0]))) - F.log((F.col("u") + 0.5) / F.lit(sizes[1] + 1.0))
    surely = lift - DEVIATIONS * F.sqrt(1 / F.col("p") + 1 / (F.col("u") + 0.5)) >= math.log(LIFT)
    return [r["feature"] for r in summed.filter(surely).orderBy(F.desc("p"), "feature").limit(FEATURES).collect()]


def toxicity_scores(docs: DataFrame, weights: dict[str, float], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for the whole text of each row.

    NULL and empty texts have the score of a text without any feature. Without a model all scores are 0.
    An empty table gives an empty result; a column of ``docs`` that is called as the result is replaced.
    """
    source = without(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # FEATURES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        known = shared.value
        names = known.keys()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sums = np.array([math.fsum(known[f] for f in features(v.as_py()) & names) for v in column], np.float64)
            scores = 1 / (1 + np.exp(-np.clip(sums + known[""], -50, 50))) if known else np.zeros(len(column))
            yield batch.append_column(out, pa.array(scores, pa.float64()))

    return map_batches(source, run, T.StructType([*source.schema.fields, T.StructField(out, T.DoubleType())]))
