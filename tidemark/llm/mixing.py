"""Mixing sources to target weights by Pfair scheduling.

The rows of a source form blocks. Block ``i`` (from 0) of a source with weight ``w`` is released at slot
``floor(i / w)`` and due at ``ceil((i + 1) / w)``; of the released blocks the one with the earliest deadline
takes the next slot. Weights are exact fractions that sum to one, so a block is always waiting, no source is ever a whole
block ahead of or behind its share, and the slots of a source that has run out stay free.

The schedule is made in frames, one row for each, so Spark spreads them. A frame does not know what the one before it
did. It begins some frames earlier, from a state that any schedule could go on from (all that is due is done, and of what
is released the earliest deadlines), and plays on to its own slots; earliest-deadline-first soon forgets where it
began. Where a frame's first state is not the last state of the one before it, both are played again from twice as far
back, at the latest from slot 0, until all states agree: then the frames are one schedule.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import inf, lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import without
from tidemark.session import cut

BLOCK_ROWS = 16
TEMPERATURE = 0.5  # weights follow the row counts to this power where none are given
BUCKETS = 1_024  # per source; rows are numbered bucket by bucket, so a hot source has as many tasks
FRAME = 512  # slots
FINEST = 1 << 40  # a weight below this part of the sum counts as this part
ROOT_SCALE = 1 << 32  # parts of a row count's power, which is irrational
OWN = ("__key", "__hash", "__bucket", "__place", "__offset")


def _keyed(docs: DataFrame, source: str, id_column: str) -> DataFrame:
    """The source as a key that tells NULL from the empty string, and the bucket of each row."""
    name = F.col(f"`{source}`").cast("string")
    hashed = F.xxhash64(F.col(f"`{id_column}`"))
    return without(docs, *OWN).withColumns(
        {
            "__key": F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), name)),
            "__hash": hashed,
            "__bucket": F.pmod(hashed, F.lit(BUCKETS)).cast("int"),
        }
    )


def exact_parts(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in the ratio of the weights: exact, unless a weight is finer than one part in ``FINEST``."""
    if not all(0 <= v < inf for v in weights.values()):
        raise ValueError("weights must be finite and not negative")
    exact = {k: Fraction(v) for k, v in weights.items()}
    unit = lcm(*[x.denominator for x in exact.values()]) if exact else 1
    parts = {k: int(x * unit) for k, x in exact.items()}
    total = sum(parts.values())
    if total >= FINEST**2:
        parts = {k: -(-p * FINEST**2 // total) for k, p in parts.items()}
    return {k: max(p, sum(parts.values()) // FINEST) if p else 0 for k, p in parts.items()}


def _shares(counts: DataFrame, weights: Mapping[str | None, float] | None, temperature: float, block_rows: int) -> DataFrame:
    """``(key, parts, blocks)``: the weight in whole parts of their sum, and the number of blocks of each source."""
    sizes = counts.groupBy("__key").agg(F.sum("n").alias("rows"))
    if weights is None:
        parts = F.greatest(F.pow(F.col("rows").cast("double"), F.lit(float(temperature))) * ROOT_SCALE, F.lit(1.0)).cast("decimal(25,0)")
    else:
        given = exact_parts({("-" if k is None else f"+{k}"): float(v) for k, v in weights.items()})
        named = F.create_map(*[F.lit(x) for k, v in given.items() for x in (k, str(v))]) if given else F.create_map().cast("map<string,string>")
        parts = F.coalesce(named[F.col("__key")], F.lit("0")).cast("decimal(25,0)")
    return sizes.select("__key", parts.alias("parts"), F.ceil(F.col("rows") / block_rows).cast("bigint").alias("blocks"))


# A source in a state: number, parts, next block, its release and deadline.
_SOURCE = "named_struct('k', {k}, 'p', {p}, 'i', {i}, 'r', (({i}) * cycle) div {p}, 'd', (({i} + 1) * cycle + {p} - 1) div {p})"
_NEXT = _SOURCE.format(k="x.k", p="x.p", i="x.i + 1")
#: The released source with the earliest deadline; ties go to the earlier source.
_CHOSEN = "array_min(transform(filter({state}, x -> x.r <= t), x -> named_struct('d', x.d, 'k', x.k, 'i', x.i, 'r', x.r)))"
_MOVED = "transform({state}, x -> if(x.k = b.k, " + _NEXT + ", x))"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _played(frames: DataFrame) -> DataFrame:
    """``(frame, back, first, last, placed)`` for ``(frame, back, sources, cycle)``: fingerprints of the states at both ends
    of the frame, and what takes each of its slots. Play begins ``back`` frames earlier."""
    start = f"greatest(frame - back, 0L) * {FRAME}L"
    at = frames.withColumn("start", F.expr(start)).withColumn("due", F.expr(f"transform(sources, s -> {_SOURCE.format(k='s.k', p='s.p', i='(start * s.p) div cycle')})"))
    # Blocks that are due by then are done. Of the others that are released the earliest deadlines are done too,
    # as many as slots are left.
    open_ = "filter(due, x -> (start * x.p) % cycle > 0)"
    at = at.withColumn("extra", F.expr("start - aggregate(due, 0L, (n, x) -> n + x.i)")).withColumn("open", F.expr(f"array_sort(transform({open_}, x -> named_struct('d', x.d, 'k', x.k)))"))
    at = at.withColumn("done", F.expr("transform(slice(open, 1, CAST(extra AS INT)), x -> x.k)"))
    at = at.withColumn("state", F.expr(f"transform(due, x -> if(array_contains(done, x.k), {_NEXT}, x))"))
    warm = _let("b", _CHOSEN.format(state="now"), _MOVED.format(state="now"))
    earlier = f"slice(sequence(start, frame * {FRAME}L), 1, CAST(frame * {FRAME}L - start AS INT))"  # without its end
    at = at.withColumn("entered", F.expr(f"aggregate({earlier}, state, (now, t) -> {warm})"))
    placing = _let("b", _CHOSEN.format(state="now.s"), f"named_struct('s', {_MOVED.format(state='now.s')}, 'placed', array_append(now.placed, named_struct('k', b.k, 'i', b.i, 'r', b.r, 'd', b.d, 't', t)))")
    nothing = "CAST(array() AS ARRAY<STRUCT<k: INT, i: BIGINT, r: BIGINT, d: BIGINT, t: BIGINT>>)"
    own = f"sequence(frame * {FRAME}L, frame * {FRAME}L + {FRAME - 1}L)"
    at = at.withColumn("left", F.expr(f"aggregate({own}, named_struct('s', entered, 'placed', {nothing}), (now, t) -> {placing})"))
    print_of = "xxhash64(transform({0}, x -> x.i))"
    return at.select("frame", "back", F.expr(print_of.format("entered")).alias("first"), F.expr(print_of.format("left.s")).alias("last"), "left.placed")


def _frames(sources: DataFrame) -> DataFrame:
    """All frames up to the slot at which a single source remains, as one consistent schedule: ``(frame, placed)``."""
    cores = sources.sparkSession.sparkContext.defaultParallelism
    # Deadline of a source's last block; only the largest of them lies beyond the frames.
    ends = F.expr("sort_array(transform(sources, s -> (s.n * cycle + s.p - 1) div s.p), false)")
    frames = sources.withColumn("until", F.coalesce(F.get(ends, F.lit(1)), F.lit(0)).cast("bigint")).filter("until > 0")
    frames = frames.select("sources", "cycle", F.explode(F.expr(f"sequence(0L, (until - 1) div {FRAME}L)")).alias("frame")).withColumn("back", F.lit(1).cast("bigint"))
    made = cut(_played(frames.repartition(2 * cores, "frame")))
    while True:
        # A few numbers for each frame. The states at a border come from both of its sides.
        ends_at = made.select((F.col("frame") + 1).alias("border"), F.col("last").alias("l"), F.col("back").alias("b0"), F.lit(None).cast("bigint").alias("f"), F.lit(None).cast("bigint").alias("b1"))
        begins_at = made.select(F.col("frame").alias("border"), F.lit(None).cast("bigint").alias("l"), F.lit(None).cast("bigint").alias("b0"), F.col("first").alias("f"), F.col("back").alias("b1"))
        borders = ends_at.unionByName(begins_at).groupBy("border").agg(*[F.max(c).alias(c) for c in ("l", "b0", "f", "b1")])
        torn = cut(borders.filter("l <> f").select("border", (2 * F.greatest("b0", "b1")).alias("wider")))
        if torn.isEmpty():
            return made.select("frame", "placed")
        sides = torn.select(F.explode(F.array("border", F.col("border") - 1)).alias("frame"), "wider").groupBy("frame").agg(F.max("wider").alias("wider"))
        again = frames.join(sides, "frame").select("frame", F.col("wider").alias("back"), "sources", "cycle")
        made = cut(made.join(sides, "frame", "left_anti").unionByName(_played(again.repartition(2 * cores, "frame"))))


def block_schedule(shares: DataFrame) -> DataFrame:
    """``(key, target_weight, block, release, deadline, at)``, a row for each block of ``(key, parts, blocks)``.

    A source that is left alone takes the last slot of each of its windows. Sources with 0 parts follow after all
    others, by key. If no source has a part all weigh the same.
    """
    any_part = "exists(all, s -> s.parts > 0)"
    gathered = (
        shares.agg(F.array_sort(F.collect_list(F.struct("__key", "parts", "blocks"))).alias("all"))  # control data: a row for each source
        .filter("size(all) > 0")
        .withColumn("all", F.expr(f"if({any_part}, all, transform(all, s -> named_struct('__key', s.__key, 'parts', CAST(1 AS DECIMAL(25,0)), 'blocks', s.blocks)))"))
        .withColumn("cycle", F.expr("aggregate(all, CAST(0 AS DECIMAL(25,0)), (n, s) -> CAST(n + s.parts AS DECIMAL(25,0)))"))
        .withColumn("sources", F.expr("filter(transform(all, (s, k) -> named_struct('k', k, 'key', s.__key, 'p', s.parts, 'n', s.blocks)), s -> s.p > 0)"))
    )
    gathered = cut(gathered)
    placed = cut(_frames(gathered).select(F.explode("placed").alias("x")).select("x.*"))
    listed = gathered.select("cycle", F.posexplode("all").alias("k", "s")).select("k", "s.*", "cycle")
    known = placed.join(listed, "k").filter("i < blocks")
    # What lies beyond the frames: the one source that remains.
    reached = placed.groupBy("k").agg((F.max("i") + 1).alias("reached"))
    rest = listed.filter("parts > 0").join(reached, "k", "left").withColumn("reached", F.coalesce("reached", F.lit(0).cast("bigint"))).filter("reached < blocks")
    alone = rest.withColumn("i", F.explode(F.expr("sequence(reached, blocks - 1)"))).selectExpr(
        "k", "i", "(i * cycle) div parts AS r", "((i + 1) * cycle + parts - 1) div parts AS d", "((i + 1) * cycle + parts - 1) div parts - 1 AS t", "__key", "parts", "blocks", "cycle"
    )
    timed = known.select("k", "i", "r", "d", "t", "__key", "parts", "blocks", "cycle").unionByName(alone)
    end = F.lit(timed.agg(F.coalesce(F.max("t") + 1, F.lit(0))).first()[0])
    idle = listed.filter("parts = 0").withColumn("before", F.sum("blocks").over(Window.partitionBy("cycle").orderBy("k")) - F.col("blocks"))
    idle = idle.withColumn("end", end.cast("bigint")).withColumn("i", F.explode(F.expr("sequence(0L, blocks - 1)"))).selectExpr("k", "i", "end + before + i AS r", "end + before + i + 1 AS d", "end + before + i AS t", "__key", "parts", "blocks", "cycle")
    weight = (F.col("parts").cast("double") / F.col("cycle").cast("double")).alias("target_weight")
    return timed.unionByName(idle).select("__key", weight, F.col("i").alias("block"), F.col("r").alias("release"), F.col("d").alias("deadline"), F.col("t").alias("at"))


def cycle_schedule(parts: DataFrame) -> DataFrame:
    """One cycle of the schedule for weights that are whole ``(key, parts)``: as many slots as parts."""
    return block_schedule(parts.select("__key", F.col("__parts").cast("decimal(25,0)").alias("parts"), F.col("__parts").alias("blocks")))


def mix(
    docs: DataFrame,
    source: str = "source",
    id_column: str = "doc_id",
    weights: Mapping[str | None, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Every row of ``docs`` with ``target_weight, block, place, release, deadline, slot``.

    ``slot`` orders the blocks of the mixture, ``place`` the rows of a block. Without ``weights`` a source
    weighs its row count to the power ``temperature``; with them a source that is not named weighs 0, and
    the blocks of sources that weigh 0 follow after all others. Within a source rows follow a hash of their id. No row is dropped or repeated: the slots of
    a source that has run out stay free, and the others keep their shares among themselves. A NULL source
    is a source of its own; NULL or repeated ids stand next to each other; an empty table gives an empty result.
    Columns of ``docs`` that are called as the results are replaced.
    """
    results = ("target_weight", "block", "place", "release", "deadline", "slot")
    keyed = _keyed(without(docs, *results), source, id_column)
    narrow = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([source, id_column])])
    counts = cut(_keyed(narrow, source, id_column).groupBy("__key", "__bucket").agg(F.count(F.lit(1)).alias("n")))
    schedule = cut(block_schedule(_shares(counts, weights, temperature, int(block_rows))))
    before = F.sum("n").over(Window.partitionBy("__key").orderBy("__bucket")) - F.col("n")
    offsets = counts.select("__key", "__bucket", before.alias("__offset"))
    in_bucket = Window.partitionBy("__key", "__bucket").orderBy("__hash", F.col(f"`{id_column}`"))
    placed = keyed.withColumn("__place", F.row_number().over(in_bucket) - 1).join(offsets, ["__key", "__bucket"])
    placed = placed.withColumn("__place", F.col("__place") + F.col("__offset"))
    placed = placed.withColumn("block", F.expr(f"__place div {int(block_rows)}"))
    timed = placed.join(schedule, ["__key", "block"])
    kept = [F.col(f"`{c}`") for c in without(docs, *results).columns]
    place = F.pmod("__place", F.lit(block_rows)).cast("int").alias("place")
    return timed.select(*kept, "target_weight", "block", place, "release", "deadline", F.col("at").alias("slot"))


def mixed_order(docs: DataFrame, source: str = "source", id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, with its columns, in the order of the mixture: a range sort by slot and place."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(f"`{source}`").alias("__source"),
        F.col(f"`{id_column}`").alias("__id"),
    )
    return mix(packed, "__source", "__id", **options).orderBy("slot", "place").select("__row.*")
