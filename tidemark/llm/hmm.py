"""A hidden Markov language model, trained by Baum-Welch counts that Spark sums over all partitions.

Symbols are the most frequent words, about ``head``, the end of a text, and classes of all other words by their
last bytes; within a class a word follows its count in the corpus. So the model's tables are bounded by
parameters, while word counts cover every training text and stay distributed: words outside the head meet
their counts in a join, never on the driver.

Training reads texts as segments of bounded length. In each round every task runs the forward and backward
recursions over its segments, the expected counts are summed by symbol in Spark, and the driver turns the
sums (bounded tables) into the next model. Scoring runs the scaled forward recursion over whole texts; long
texts are cut into blocks whose transfer matrices are multiplied, which gives the same likelihood.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.session import cut

HEAD = 65_536
CLASSES = 256
STATES = 8
ROUNDS = 4  # each over all training texts
PULL = 2.0  # pseudo-counts for each symbol, spread like the corpus, in the emissions of each state
SEGMENT = 256  # tokens of a training segment
GROUP = 2_048  # segments at a time
BLOCK = 512  # tokens of a block of a long text
TOGETHER = 4  # partitions that share a table of counts
FLUSH = 1 << 20  # distinct words a task holds before it hands its counts on
ADDED = 0.1
LEVEL = 1.02  # ratio of the count ranges from which the head is found
END = b""


def words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z folded; of bytes, ``split`` cuts at ASCII white space only."""
    return (text or "").encode().lower().split()


def tail_class(word: bytes) -> int:
    return crc32(word[-3:]) % CLASSES


@dataclass(frozen=True)
class Model:
    """Start in a text, start of an inner segment, transitions (from, to), emissions (symbol, state)."""

    start: np.ndarray
    inner: np.ndarray
    moves: np.ndarray
    emit: np.ndarray

    @property
    def states(self) -> int:
        return len(self.start)


def initial_model(base: np.ndarray, states: int) -> Model:
    """Emissions of each state: the corpus distribution, disturbed by a fixed pseudo-random factor; sticky moves."""
    noise = np.random.default_rng(7).gamma(0.5, 2.0, (len(base), states)) + 0.05
    emit = base[:, None] * noise
    even = np.full(states, 1 / states)
    moves = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(moves, 0.95 if states > 1 else 1.0)
    return Model(even, even, moves, emit / emit.sum(axis=0))


def _active(lengths: np.ndarray) -> np.ndarray:
    """For lengths in falling order: how many are longer than each step."""
    steps = np.arange(lengths[0])
    return len(lengths) - np.searchsorted(lengths[::-1], steps, side="right")


def expected_counts(model: Model, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, is_first: np.ndarray):
    """Forward and backward over segments: (emission weights by token, moves, first starts, inner starts)."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, is_first = starts[order], lengths[order], is_first[order]
    n = _active(lengths)
    k = model.states
    alpha = np.zeros((len(n), len(starts), k))
    scale = np.ones((len(n), len(starts)))
    for t, rows in enumerate(n):
        b = model.emit[ids[starts[:rows] + t]]
        a = np.where(is_first[:rows, None], model.start, model.inner) * b if t == 0 else (alpha[t - 1, :rows] @ model.moves) * b
        scale[t, :rows] = a.sum(axis=1)
        alpha[t, :rows] = a / scale[t, :rows, None]
    weights = np.zeros((len(ids), k))
    moves = np.zeros((k, k))
    beta = np.ones((len(starts), k))
    for t in range(len(n) - 1, -1, -1):
        rows = n[t]
        if t + 1 < len(n) and n[t + 1]:
            later = n[t + 1]
            ahead = model.emit[ids[starts[:later] + t + 1]] * beta[:later] / scale[t + 1, :later, None]
            moves += alpha[t, :later].T @ ahead
            beta[:later] = ahead @ model.moves.T
        gamma = alpha[t, :rows] * beta[:rows]
        weights[starts[:rows] + t] = gamma
    first = weights[starts[is_first]].sum(axis=0)
    inner = weights[starts[~is_first]].sum(axis=0)
    return weights, moves * model.moves, first, inner


def segments(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, given by their offsets, as segments of bounded length: start, length, whether it begins a text."""
    size = np.diff(offsets)
    per = -(-size // SEGMENT)
    text = np.repeat(np.arange(len(size)), per)
    part = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    return offsets[text] + part * SEGMENT, np.minimum(SEGMENT, size[text] - part * SEGMENT), part == 0


def log_likelihood(model: Model, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Log10 probability of each text's symbols, by the scaled forward recursion over the whole text."""
    size = np.diff(offsets)
    out = np.zeros(len(size))
    short = np.nonzero((size > 0) & (size <= 2 * BLOCK))[0]
    for k in range(0, len(short), GROUP):
        chosen = short[k : k + GROUP]
        chosen = chosen[np.argsort(-size[chosen], kind="stable")]
        starts = offsets[chosen]
        a = np.zeros((len(chosen), model.states))
        total = np.zeros(len(chosen))
        for t, rows in enumerate(_active(size[chosen])):
            b = model.emit[ids[starts[:rows] + t]]
            a[:rows] = model.start * b if t == 0 else (a[:rows] @ model.moves) * b
            norm = a[:rows].sum(axis=1)
            a[:rows] /= norm[:, None]
            total[:rows] += np.log10(norm)
        out[chosen] = total
    long = np.nonzero(size > 2 * BLOCK)[0]
    for k in range(0, len(long), GROUP):
        out[long[k : k + GROUP]] = _long_likelihoods(model, ids, offsets[long[k : k + GROUP]], size[long[k : k + GROUP]])
    return out


def _long_likelihoods(model: Model, ids: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Long texts: the transfer matrices of all their blocks, side by side, then multiplied in order by text."""
    states = model.states
    a = model.start * model.emit[ids[starts]]
    total = np.log10(a.sum(axis=1))
    a /= a.sum(axis=1, keepdims=True)
    per = -(-(size - 1) // BLOCK)  # blocks after the first symbol
    part = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    begin = np.repeat(starts + 1, per) + part * BLOCK
    length = np.minimum(BLOCK, np.repeat(size - 1, per) - part * BLOCK)
    matrices = np.empty((len(begin), states, states))
    logs = np.zeros(len(begin))
    order = np.argsort(-length, kind="stable")
    for k in range(0, len(order), BLOCK):
        chosen = order[k : k + BLOCK]
        matrix = np.repeat(np.eye(states)[None], len(chosen), axis=0)
        log = np.zeros(len(chosen))
        for t, rows in enumerate(_active(length[chosen])):
            moved = (matrix[:rows] @ model.moves) * model.emit[ids[begin[chosen[:rows]] + t]][:, None, :]
            norm = moved.max(axis=(1, 2))
            matrix[:rows] = moved / norm[:, None, None]
            log[:rows] += np.log10(norm)
        matrices[chosen], logs[chosen] = matrix, log
    first = np.cumsum(per) - per
    for step in range(per.max()):
        going = np.nonzero(per > step)[0]
        block = first[going] + step
        moved = np.einsum("ni,nij->nj", a[going], matrices[block])
        norm = moved.sum(axis=1)
        a[going] = moved / norm[:, None]
        total[going] += logs[block] + np.log10(norm)
    return total


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``(word, n)`` over all texts, with one end for each; a task's counts are merged before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

        seen: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(words(value.as_py()))
                seen[END] += 1
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    return map_batches(docs.select(F.col(f"`{text}`").cast("string")), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The bounded tables that every task needs: head words with their counts, and sums by tail class."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int, tails: dict[int, tuple[int, int]]) -> None:
        counted = dict(head)
        ends = counted.pop(END, 0)
        self.index = {END: 0} | {w: k + 1 for k, w in enumerate(counted)}
        self.counts = np.array([ends, *counted.values()], np.float64)
        self.total, self.distinct = total, distinct
        self.norm = total + ADDED * (distinct + 1)
        self.class_weight = np.array([tails.get(c, (0, 0))[0] + ADDED * (tails.get(c, (0, 0))[1] + 1) for c in range(CLASSES)])
        weights = np.concatenate([self.counts + ADDED, self.class_weight])
        self.base = weights / weights.sum()
        self.head_score = np.log10((self.counts + ADDED) / self.norm)

    @property
    def first_class(self) -> int:
        return len(self.counts)


def vocabulary(counts: DataFrame, head: int) -> Vocabulary:
    """Read the head and ``CLASSES`` sums to the driver; both are bounded by parameters, whatever the corpus.

    The head is the words of at least the smallest count that leaves ``head`` words or fewer. It is found
    from how many words there are in each of about 1,500 geometric ranges of counts.
    """
    level = F.floor(F.log("n") / F.lit(np.log(LEVEL))).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect()
    least, room = np.iinfo(np.int64).max, head
    for row in sorted(levels, reverse=True):
        room -= row["words"]
        if room < 0:
            break
        least = row["n"]
    is_head = (F.col("n") >= F.lit(int(least))) | (F.octet_length("word") == 0)
    rows = sorted(((bytes(r["word"]), r["n"]) for r in counts.filter(is_head).collect()), key=lambda r: (-r[1], r[0]))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    group = F.pmod(F.crc32(F.expr("substring(word, -3, 3)")), F.lit(CLASSES)).cast("int").alias("class")
    sums = counts.filter(~is_head).groupBy(group).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    return Vocabulary(rows, totals[0], totals[1], {r["class"]: (r["n"], r["v"]) for r in sums})


def encode(docs: DataFrame, vocab, text: str) -> DataFrame:
    """``docs`` without the text, with ``ids`` (symbols of the whole text and its end) and ``tail`` (words outside the head)."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        index, first = vocab.value.index, vocab.value.first_class
        for batch in batches:
            ids: list[int] = []
            tail: list[bytes] = []
            id_ends, tail_ends = [0], [0]
            for value in batch.column(batch.schema.get_field_index(text)):
                found = words(value.as_py())
                for word in found:
                    known = index.get(word)
                    if known is None:
                        tail.append(word)
                        known = first + tail_class(word)
                    ids.append(known)
                ids.append(0)
                id_ends.append(len(ids))
                tail_ends.append(len(tail))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns.append(pa.ListArray.from_arrays(pa.array(id_ends, pa.int32()), pa.array(ids, pa.int32())))
            columns.append(pa.ListArray.from_arrays(pa.array(tail_ends, pa.int32()), pa.array(tail, pa.binary())))
            yield pa.record_batch(columns, names=[*kept, "ids", "tail"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(docs, run, f"{kinds}, ids array<int>, tail array<binary>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column, however its batch was sliced."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def baum_welch_round(encoded: DataFrame, model: Model, vocab: Vocabulary) -> Model:
    """One round: counts of every task, summed by symbol, and the model that they give."""
    context = encoded.sparkSession.sparkContext
    shared = context.broadcast(model)  # bounded by head, classes and states
    names = [f"s{k}" for k in range(model.states)]
    size = len(vocab.base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        now = shared.value
        emit = np.zeros((size, now.states))
        moves = np.zeros((now.states, now.states))
        first, inner = np.zeros(now.states), np.zeros(now.states)
        for batch in batches:
            ids, offsets = _flat(batch.column(0))
            starts, lengths, is_first = segments(offsets)
            order = np.argsort(lengths, kind="stable")
            for k in range(0, len(order), GROUP):
                chosen = order[k : k + GROUP]
                at = np.repeat(starts[chosen] - np.cumsum(lengths[chosen]) + lengths[chosen], lengths[chosen]) + np.arange(lengths[chosen].sum())
                local = ids[at]
                begin = np.cumsum(lengths[chosen]) - lengths[chosen]
                weights, m, f, i = expected_counts(now, local, begin, lengths[chosen], is_first[chosen])
                for s in range(now.states):
                    emit[:, s] += np.bincount(local, weights[:, s], size)
                moves, first, inner = moves + m, first + f, inner + i
        seen = np.nonzero(emit.any(axis=1))[0]
        rows = np.concatenate([emit[seen], moves, first[None], inner[None]])
        keys = np.concatenate([seen, -1 - np.arange(now.states + 2)])
        yield pa.record_batch([pa.array(keys.astype(np.int32)), *[pa.array(rows[:, k]) for k in range(now.states)]], names=["symbol", *names])

    # Each task hands on one table of counts, so a task takes some partitions; tasks still follow the input.
    parts = len(encoded.inputFiles())
    tasks = encoded.select("ids").coalesce(max(2 * context.defaultParallelism, parts // TOGETHER, 1))
    counted = map_batches(tasks, run, ", ".join(["symbol int", *[f"{n} double" for n in names]]))
    summed = counted.groupBy("symbol").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    keys = summed.column(0).to_numpy()
    rows = np.stack([summed.column(n).to_numpy() for n in names], axis=1)
    shared.unpersist()
    emit = np.zeros((size, model.states))
    emit[keys[keys >= 0]] = rows[keys >= 0]
    if not emit.any():
        return model  # nothing was counted, nothing is learnt
    special = np.zeros((model.states + 2, model.states))
    special[-1 - keys[keys < 0]] = rows[keys < 0]
    emit = emit + PULL * size * vocab.base[:, None]
    moves = special[: model.states] + 1.0
    start, inner = special[model.states] + 1.0, special[model.states + 1] + 1.0
    return Model(start / start.sum(), inner / inner.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def train(encoded: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over ``encoded (row, ids)``: every round counts all texts."""
    model = initial_model(vocab.base, states)
    if encoded.isEmpty():
        return replace(model, emit=np.repeat(vocab.base[:, None], states, axis=1))
    for _ in range(rounds):
        model = baum_welch_round(encoded, model, vocab)
    return model


def hmm_scores(
    docs: DataFrame,
    held_out,
    text: str = "text",
    id_column: str = "doc_id",
    head: int = HEAD,
    states: int = STATES,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    ``held_out`` is a boolean column: rows where it is true (or NULL) are scored and never learnt from.
    NULL and empty texts consist of their end. Words that no training text has share the smoothing mass.
    Repeated rows are learnt and scored as often as they stand there; without any training text the
    model is uniform over its symbols; an empty table gives an empty result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_column}`").alias("__id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        F.col(f"`{text}`").cast("string").alias("__text"),
    )
    counts = cut(word_counts(rows.filter(~F.col("held_out")), "__text"))
    vocab = vocabulary(counts, head)
    context = docs.sparkSession.sparkContext
    shared_vocab = context.broadcast(vocab)
    encoded = cut(encode(rows, shared_vocab, "__text"))
    model = train(encoded.filter(~F.col("held_out")).select("row", "ids"), vocab, states)
    shared_model = context.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        now, known = shared_model.value, shared_vocab.value
        base = np.concatenate([known.head_score, np.zeros(CLASSES)])
        seen = np.concatenate([known.counts > 0, np.zeros(CLASSES, bool)]).astype(np.int64)
        for batch in batches:
            ids, offsets = _flat(batch.column(3))
            known_here, base_here = (np.add.reduceat(table[ids], offsets[:-1]) for table in (seen, base))
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(np.diff(offsets)), pa.array(known_here), pa.array(base_here), pa.array(log_likelihood(now, ids, offsets))],
                names=["row", "__id", "held_out", "n_tokens", "head_known", "head_base", "head_score"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    scored = map_batches(encoded.select("row", "__id", "held_out", "ids"), 
        score, f"row long, __id {kind}, held_out boolean, n_tokens long, head_known long, head_base double, head_score double"
    )
    n = F.coalesce("n", F.lit(0)) + F.lit(ADDED)
    group = F.pmod(F.crc32(F.expr("substring(word, -3, 3)")), F.lit(CLASSES)).cast("int")
    in_class = F.element_at(F.array(*[F.lit(float(w)) for w in vocab.class_weight]), group + 1)
    tails = (
        encoded.select("row", F.explode("tail").alias("word"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("tail_known"),
            F.sum(F.log10(n / F.lit(float(vocab.norm)))).alias("tail_base"),
            F.sum(F.log10(n / in_class)).alias("tail_score"),
        )
    )
    zero = F.lit(0.0)
    return scored.join(tails, "row", "left").select(
        F.col("__id").alias(id_column),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(int(vocab.total)).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", zero)).alias("score"),
    )
