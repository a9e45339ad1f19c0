"""Near copies of whole texts: MinHash bands and prefixes find candidates, the exact Jaccard similarity decides.

A text is the set of its shingles of five words. A pair that shares a band is checked on its whole sets, unless it is linked
already by other pairs. Equal sets (by 128 bits) are one set.

A band of near copies may hold very many sets, so its pairs are not listed. First every member is compared with a leader of its
band, the member that shares most bands with others, and then with a second leader from what the first did not reach: work
in proportion to the members. That links nearly all near copies. Left are members of one band that no link
connects; only tiles of such members meet each other, never two tiles of one component. Each comparison is a group of two
short lists of set numbers, and sets are sent once to each group.

Bands miss a pair at the threshold some times in a million. So what they have not connected meets again by prefixes, which
lose no pair: in one order for all, two similar sets have one of their first shingles in common, if as many are taken as a set
may have alone, and one more. Any order will do; here frequent shingles come last, so that few unlike texts meet. Of the sets
that meet, parities of their shingles prove most to be unlike, and only what is left is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.components import components
from tidemark.llm.passages import _ODD, _mixed, sided, word_hashes
from tidemark.llm.simhash import forest
from tidemark.session import cut

WORDS = 5
SIMILAR = 0.8
BAND_ROWS = 5
BANDS = 32  # a pair at 0.8 shares none with a probability of (1 - 0.8 ** 5) ** 32 = 3e-6
TILE = 128  # sets that are compared with others at a time, on average at most
TILE_SHINGLES = 1 << 20  # and their shingles, on average at most
COLUMNS = 1 << 13  # different shingles that are counted at a time
ROWS = 128  # texts that a worker takes at a time
PIECE = 1 << 20  # shingles that are counted together, about; those of two texts at most are not taken for frequent
OFTEN = 1 << 18  # frequent shingles that a worker knows, at most: 4 MB
CLASSES = 64  # classes of parities, at least
_SEEDS = np.random.default_rng(23).integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """For each text its different shingles as sorted 64-bit numbers; a shorter text is one shingle."""
    hashes, _, offsets = word_hashes(texts)
    padded = np.append(hashes, np.zeros(words - 1, np.uint64))
    shingles = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        shingles = _mixed(shingles * _ODD + padded[k : k + len(hashes)])
    out = []
    for start, end in zip(offsets[:-1], offsets[1:]):
        if 0 < end - start < words:
            out.append(np.array([xxhash.xxh64_intdigest(hashes[start:end].tobytes())], np.uint64))
        else:
            out.append(np.unique(shingles[start : max(start, end - words + 1)]))
    return out


def set_hash(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """For each of the sets, none of them empty, a key for each band, as signed longs."""
    together = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for k, seed in enumerate(_SEEDS):
        lowest = np.minimum.reduceat((together ^ seed) * seed >> np.uint64(32), starts)
        band = k // BAND_ROWS
        keys[:, band] = _mixed(keys[:, band] * _ODD + lowest + np.uint64(band + 1))
    return keys.view(np.int64)


def prefixes(sets: list[np.ndarray], often: np.ndarray, counts: np.ndarray, least: float = SIMILAR) -> list[np.ndarray]:
    """The first shingles of each set, those of ``often`` (sorted) last, by their counts.

    A set has a share of ``least`` of its shingles, or more, in common with each similar one. Of one more than the others
    one is shared, so both prefixes have the first shared one.
    """
    sizes = np.array(list(map(len, sets)), dtype=np.int64)
    rank = np.zeros(sizes.sum(), np.int64)
    if len(often) and len(rank):
        together = np.concatenate(sets)
        place = np.minimum(np.searchsorted(often, together), len(often) - 1)
        rank = np.where(often[place] == together, counts[place], 0)
    out = []
    for shingles, ranks in zip(sets, np.split(rank, np.cumsum(sizes)[:-1])):
        ordered = shingles[np.argsort(ranks, kind="stable")] if ranks.any() else shingles
        out.append(ordered[: len(shingles) - math.ceil(least * len(shingles) - 1e-9) + 1])
    return out


def parities(shingles: np.ndarray) -> bytes:
    """Bits that tell in which classes the number of shingles is odd. The classes are a power of two, two for each shingle or more."""
    classes = max(CLASSES, 1 << (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(classes - 1)).astype(np.int64), minlength=classes)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """Parities of fewer classes, ``width`` bytes of them."""
    out = np.frombuffer(bits, np.uint64)
    while out.nbytes > width:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def not_unlike(bits: list[bytes], sizes: np.ndarray, roots: np.ndarray, split: int, least: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of different roots that sizes and parities do not prove to be unlike; with a split above 0 only pairs across it.

    Each class whose parities differ has a shingle that one of the two sets has alone.
    """
    width = np.array(list(map(len, bits)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for wide in np.unique(width).tolist():
        rows = np.nonzero((width >= wide) & (least * width <= 2 * wide))[0]
        signs = np.stack([folded(bits[k], wide) for k in rows])
        for at in np.nonzero(width[rows] == wide)[0]:
            k = rows[at]
            able = ((width[rows] > wide) | (rows > k)) & (roots[rows] != roots[k])
            able &= (sizes[rows] >= least * sizes[k] - 1e-6) & (sizes[k] >= least * sizes[rows] - 1e-6)
            if split:
                able &= (rows < split) != (k < split)
            others = np.nonzero(able)[0]
            alone = np.bitwise_count(signs[others] ^ signs[at]).sum(axis=1, dtype=np.int64)
            near = rows[others[alone <= (sizes[rows[others]] + sizes[k]) * (1 - least) / (1 + least) + 1e-6]]
            left.append(np.full(len(near), k))
            right.append(near)
    return np.concatenate(left), np.concatenate(right)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each sorted set of ``left`` shares with each of ``right``."""
    names = np.unique(np.concatenate(left))
    sides = []
    for sets in (left, right):
        values = np.concatenate(sets)
        place = np.minimum(np.searchsorted(names, values), len(names) - 1)
        hit = names[place] == values
        sides.append((np.repeat(np.arange(len(sets)), list(map(len, sets)))[hit], place[hit]))
    used = np.bincount(sides[1][1], minlength=len(names)) > (left is right)  # what one set alone holds, is not shared
    column = np.cumsum(used) - 1
    out = np.zeros((len(left), len(right)))
    for first in range(0, int(used.sum()), COLUMNS):
        marks = []
        for sets, (row, place) in zip((left, right), sides):
            block = used[place] & (column[place] >= first) & (column[place] < first + COLUMNS)
            marks.append(np.zeros((len(sets), COLUMNS), np.float32))
            marks[-1][row[block], column[place[block]] - first] = 1
        out += marks[0] @ marks[1].T
    return out


def linked(sets: list[np.ndarray], split: int, least: float = SIMILAR) -> np.ndarray:
    """For each set the smallest one that links reach; with a split above 0 only pairs across it are compared."""
    left, right = (sets[:split], sets[split:]) if split else (sets, sets)
    sizes = np.array(list(map(len, sets)))
    shared = shared_counts(left, right)
    a, b = np.nonzero(shared >= least * (sizes[: len(left), None] + sizes[None, split:] - shared) - 1e-9)
    return forest(len(sets), a, b + split)


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first in range(0, len(column), ROWS):
        yield first, shingle_sets([v.as_py() or "" for v in column[first : first + ROWS]])


def _often(source: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and about how many texts have them.

    Only the order of prefixes follows them: what is not among them costs time, and no pair.
    """

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        shingles, n = np.unique(np.concatenate(sets), return_counts=True)
        again = n > 2
        return pa.record_batch({"shingle": pa.array(shingles[again].view(np.int64)), "n": pa.array(n[again])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, sets in _chunks(batch.column(0)):
                held += sets
                size += sum(map(len, sets))
                if size >= PIECE:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    rows = cut(map_batches(source.select("__text"), run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n"))
    most, known = 63, 0
    for found in sorted(rows.groupBy(level.alias("level")).count().collect(), reverse=True):  # a row for each power of two
        known += found["count"]
        if known > OFTEN:
            break
        most = found["level"]
    table = rows.filter(level >= most).toArrow()
    shingles, counts = table["shingle"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], counts[order]


def _banded(source: DataFrame, kind: str, least: float) -> DataFrame:
    """``(__id, whole, size, keys, prefix, bits)`` of each text that has a word: hash and size of its set, its band keys, its prefix and
    its parities."""
    often, counts = _often(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _chunks(batch.column(1)):
                rows = [k for k, s in enumerate(sets) if len(s)]
                if rows:
                    keys = band_keys([sets[k] for k in rows])
                    ends = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
                    whole = pa.array([set_hash(sets[k]) for k in rows], pa.binary())
                    size = pa.array([len(sets[k]) for k in rows], pa.int64())
                    ids = batch.column(0).take(pa.array([first + k for k in rows]))
                    heads = prefixes([sets[k] for k in rows], often, counts, least)
                    borders = pa.array(np.cumsum([0, *map(len, heads)]), pa.int32())
                    prefix = pa.ListArray.from_arrays(borders, pa.array(np.concatenate(heads).view(np.int64)))
                    bits = pa.array([parities(sets[k]) for k in rows], pa.binary())
                    columns = [ids, whole, size, pa.ListArray.from_arrays(ends, pa.array(keys.ravel())), prefix, bits]
                    yield pa.record_batch(columns, names=["__id", "whole", "size", "keys", "prefix", "bits"])

    return map_batches(source, run, f"__id {kind}, whole binary, size long, keys array<long>, prefix array<long>, bits binary")


def _sets(source: DataFrame) -> DataFrame:
    """``(whole, shingles)`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _chunks(batch.column(0)):
                whole = pa.array([set_hash(s) for s in sets], pa.binary())
                yield pa.record_batch({"whole": whole, "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    return map_batches(source, run, "whole binary, shingles binary")


def _sets_of(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(u, shingles)`` of some of the different sets."""
    texts = source.join(wanted.select(F.col("low").alias("__low")).distinct(), F.col("__id").eqNullSafe(F.col("__low")), "left_semi").select("__text")
    return cut(_sets(texts).dropDuplicates(["whole"]).join(wanted.select("whole", "u"), "whole").select("u", "shingles"))


def _gathered(groups: DataFrame, table: DataFrame) -> DataFrame:
    """For each group ``(left, right)`` of set numbers one row: its members, the list that each is in, and what ``table`` has of them."""
    groups = cut(groups.distinct().withColumn("group", F.monotonically_increasing_id()))
    members = groups.select("group", F.explode(sided(F.lit(0), F.lit(1))).alias("m")).select("group", "m.second", "m.u")
    return members.join(table, "u").groupBy("group").agg(F.collect_list(F.struct("second", *table.columns)).alias("rows")).select("rows")


def _compared(groups: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links in each group ``(left, right)`` of set numbers: between the two lists, or within
    ``left`` where ``right`` is empty."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                inner = rows.values
                side, u = inner.field("second").to_numpy(), inner.field("u").to_numpy()
                order = np.lexsort([u, side])
                shingles = inner.field("shingles")
                sets = [np.frombuffer(shingles[int(k)].as_buffer(), np.uint64) for k in order]
                split = int((side == 0).sum())
                label = linked(sets, split if split < len(sets) else 0, least)
                moved = np.nonzero(label != np.arange(len(sets)))[0]
                if len(moved):
                    u = u[order]
                    yield pa.record_batch({"a": pa.array(u[moved]), "b": pa.array(u[label[moved]])})

    return map_batches(_gathered(groups, sets), compare, "a long, b long")


def _not_unlike(groups: DataFrame, signs: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` in groups of set numbers that may be similar, by the sizes, parities and roots in ``signs``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                inner = rows.values
                side, u, size, root = (inner.field(c).to_numpy() for c in ("second", "u", "size", "root"))
                order = np.argsort(side, kind="stable")
                bits = inner.field("bits").take(pa.array(order)).to_pylist()
                split = int((side == 0).sum())
                left, right = not_unlike(bits, size[order], root[order], split if split < len(bits) else 0, least)
                if len(left):
                    left, right = u[order][left], u[order][right]
                    yield pa.record_batch({"a": pa.array(np.minimum(left, right)), "b": pa.array(np.maximum(left, right))})

    return map_batches(_gathered(groups, signs), compare, "a long, b long").distinct()


def _rooted(keyed: DataFrame, links: DataFrame | None) -> DataFrame:
    """The members of bands that links do not connect yet, each with the component that links give it."""
    if links is None:
        found = keyed.withColumn("root", F.col("u"))
    else:
        roots = components(links).withColumnRenamed("node", "u")
        found = keyed.join(roots, "u", "left").withColumn("root", F.coalesce("root", "u"))
    torn = found.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("two")).filter("one <> two").select("key")
    return cut(found.join(torn, "key"))


def _tiles(size: str, count: str, tile: int) -> Column:
    """How many tiles so many sets with so many shingles make."""
    return F.greatest(F.ceil(F.col(count) / tile), F.ceil(F.col(size) / TILE_SHINGLES)).cast("int")


def _led(members: DataFrame, skip: DataFrame | None, tile: int) -> tuple[DataFrame, DataFrame]:
    """Groups of a leader and some members of its band that it is not connected to; and the leaders ``(key, led)``.

    ``skip`` names a component for each band from which no leader comes.
    """
    able = members if skip is None else members.join(skip.select("key", F.col("led").alias("past")), "key").filter("root <> past")
    leaders = cut(able.groupBy("key").agg(F.max(F.struct("shared", "u", "root")).alias("l")).select("key", F.col("l.u").alias("leader"), F.col("l.root").alias("led")))
    pairs = members.join(leaders, "key").filter("root <> led").select("leader", "u", "size").distinct()
    return _dealt(pairs, tile), leaders


def _dealt(pairs: DataFrame, tile: int) -> DataFrame:
    """Groups of one ``leader`` and some of the ``u`` that it is paired with."""
    counts = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("sum"))
    dealt = pairs.join(counts, "leader").withColumn("tile", F.pmod(F.xxhash64("u"), _tiles("sum", "n", tile)))
    groups = dealt.groupBy("leader", "tile").agg(F.sort_array(F.collect_list("u")).alias("right"))
    return groups.select(F.array("leader").alias("left"), "right")


def _left_over(members: DataFrame, tile: int) -> DataFrame:
    """Groups in which all pairs of a band meet whose components differ."""
    by_root = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("sum"))
    # A component with tiles of its own keeps them to itself; small ones of a band share tiles.
    shared = F.when((F.col("n") >= tile) | (F.col("sum") >= TILE_SHINGLES), F.col("root"))
    bins = by_root.withColumn("own", shared).groupBy("key", "own").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    bins = bins.withColumn("bins", _tiles("sum", "n", tile)).select("key", "own", "bins")
    placed = members.join(by_root.select("key", "root", shared.alias("own")), ["key", "root"])
    placed = placed.join(bins.withColumnRenamed("key", "k2").withColumnRenamed("own", "o2"), (F.col("key") == F.col("k2")) & F.col("own").eqNullSafe(F.col("o2")))
    placed = placed.select("key", "u", F.struct("own", F.pmod(F.xxhash64("u"), F.col("bins")).cast("int").alias("bin")).alias("tile"))
    tiles = bins.select("key", F.col("own").alias("other_own"), F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("other_bin"))
    sides = placed.join(tiles, "key").filter("tile.own IS NULL OR other_own IS NULL OR tile.own <> other_own")
    sides = sides.select("key", "u", "tile", F.struct(F.col("other_own").alias("own"), F.col("other_bin").alias("bin")).alias("other"))
    second = F.col("tile") > F.col("other")
    one, two = F.when(second, F.col("other")).otherwise(F.col("tile")), F.when(second, F.col("tile")).otherwise(F.col("other"))
    return (
        sides.groupBy("key", one.alias("one"), two.alias("two"))
        .agg(
            F.sort_array(F.collect_list(F.when(~second, F.col("u")))).alias("left"),
            F.sort_array(F.collect_list(F.when(second, F.col("u")))).alias("right"),
        )
        .filter("IF(one = two, size(left) > 1, size(left) > 0 AND size(right) > 0)")
        .select("left", "right")
    )


def _band_links(source: DataFrame, distinct: DataFrame, least: float, tile: int) -> DataFrame:
    """Links ``(a, b)`` between different sets that connect all similar sets which share a band."""
    keyed = distinct.select("u", "size", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    crowded = cut(keyed.join(sizes, "key"))
    sharing = cut(crowded.groupBy("u").agg(F.sum("n").alias("shared")))
    sets = _sets_of(source, distinct.join(sharing, "u", "left_semi"))
    members = _rooted(crowded.join(sharing, "u").select("key", "u", "size", "shared"), None)
    groups, leaders = _led(members, None, tile)
    links = cut(_compared(groups, sets, least))
    members = _rooted(members.drop("root"), links)
    groups, _ = _led(members, leaders.join(members.select("u", F.col("root").alias("now")).distinct(), F.col("leader") == F.col("u")).select("key", F.col("now").alias("led")), tile)
    links = cut(links.unionByName(_compared(groups, sets, least)))
    members = _rooted(members.drop("root"), links)
    return links.unionByName(_compared(_left_over(members, tile), sets, least))


def _prefix_links(source: DataFrame, distinct: DataFrame, links: DataFrame, least: float, tile: int) -> DataFrame:
    """Links ``(a, b)`` that connect, with the given ones, all similar sets."""
    keyed = distinct.select("u", "size", F.explode("prefix").alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"))
    members = _rooted(cut(keyed.join(shared, "key")), links)
    signs = distinct.select("u", "size", "bits").join(members.select("u", "root").distinct(), "u")
    pairs = cut(_not_unlike(_left_over(members, tile), signs, least))
    ends = pairs.select(F.col("a").alias("u")).unionByName(pairs.select(F.col("b").alias("u"))).distinct()
    sets = _sets_of(source, distinct.join(ends, "u", "left_semi"))
    sized = pairs.select(F.col("a").alias("leader"), F.col("b").alias("u")).join(distinct.select("u", "size"), "u")
    return _compared(_dealt(sized, tile), sets, least)


def _links(source: DataFrame, distinct: DataFrame, least: float, tile: int) -> DataFrame:
    """Links ``(a, b)`` between different sets that connect all similar sets."""
    links = cut(_band_links(source, distinct, least, tile))
    return links.unionByName(_prefix_links(source, distinct, links, least, tile))


def near_copy_components(docs: DataFrame, text: str = "text", id_column: str = "doc_id", least: float = SIMILAR, tile: int = TILE) -> DataFrame:
    """``(id, component_id)`` for every text that has a word; ``component_id`` is the smallest id of its group.

    Texts whose shingle sets have a Jaccard similarity of ``least`` or more are linked. Texts without a word have
    no similarity and are left out, NULL texts too; an empty table gives an empty result. NULL ids are passed over as
    ``component_id`` unless a group has no other. Other columns are ignored.
    """
    source = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    rows = cut(_banded(source, docs.schema[id_column].dataType.simpleString(), least))
    distinct = rows.groupBy("whole").agg(F.min("__id").alias("low"), *[F.first(c).alias(c) for c in ("size", "keys", "prefix", "bits")])
    distinct = cut(distinct.withColumn("u", F.monotonically_increasing_id()))  # a short number for each set
    roots = components(_links(source, distinct, least, tile)).withColumnRenamed("node", "u")
    grouped = cut(distinct.select("whole", "u", "low").join(roots, "u", "left").withColumn("root", F.coalesce("root", "u")))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = grouped.join(lowest, "root").select("whole", "component_id")
    return rows.select("__id", "whole").join(named, "whole").select(F.col("__id").alias(id_column), "component_id")


def near_dedup(docs: DataFrame, text: str = "text", id_column: str = "doc_id", least: float = SIMILAR) -> DataFrame:
    """``docs`` without the near copies: of each group the row with the smallest id stays.

    Rows with a NULL id, rows that repeat the id that stays, and texts without a word (NULL ones too) stay. An empty table
    gives an empty result. Columns may have any name.
    """
    found = near_copy_components(docs, text, id_column, least)
    copies = cut(found.filter(F.col(f"`{id_column}`") != F.col("component_id")).select(F.col(f"`{id_column}`").alias("gone")).distinct()).alias("copies")
    return docs.alias("docs").join(copies, F.col(f"docs.`{id_column}`") == F.col("copies.gone"), "left_anti")
