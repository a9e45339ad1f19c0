"""Substring deduplication: MinHash bands over rolling paragraphs, exact check, components of removals.

A passage that was copied into a text keeps its sentences, not its place in a line. So the paragraphs that are
compared roll: in each window of ``WINDOW`` words one of ``LENGTH`` words begins, at the sentence start, or at
another place that the words there mark, with the smallest hash; where a window has no such place, at the place
with the smallest hash. So every copied run of words that holds a full window and a paragraph after it (``WINDOW + LENGTH``
words, 48) gives the same paragraph in both texts.

The first pass counts only band keys. Keys that occur twice or more are entered in a table of bits that is as large as
their number asks for, and the second pass hands on only the paragraphs that have such a key: what is unique stays in
its task, but for the few whose bits others have set. Equal paragraphs are merged, and the different ones of a band are
compared, with leaders of the band first, by the exact Jaccard similarity of their word shingles; a group of comparisons
returns a spanning forest of its links. Words are sent only of paragraphs that share a band.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.components import components
from tidemark.llm.simhash import forest
from tidemark.session import cut

LENGTH = 24  # words of a rolling paragraph
WINDOW = 24  # words in which one place is chosen
SHINGLE = 5
SIMILAR = 0.8
RECALL = 0.98  # share of pairs at the similarity that some band must join
BAND_ROWS = 2
LEAST = LENGTH  # words of a span that is reported
ANCHOR = 12  # besides sentence starts, one pair of words in so many is preferred as the beginning of a paragraph
PAGE = 32_768  # bits of a page of the bit table
PAGES = 32_768  # pages of the bit table at most: 128 MB
KEY_BITS = 16  # bits of the table for each repeated key at least, while it has fewer pages than that
MARKS = 3  # bits that a key sets, all in one page
ROWS = 256  # texts that a worker takes at a time
PAIRS = 1 << 12  # pairs that are compared at a time
SMALL = 32  # members of a band that are all compared at once
TILE = 256  # different paragraphs of a band that are compared at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(2**64 - 1)
_UNMARKED = np.uint64(2**63)  # added to the order of a place that comes after all marked ones


def tune_bands(similar: float = SIMILAR, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """The fewest bands of ``rows`` hashes that join pairs of this similarity with this probability."""
    bands = 1
    while 1 - (1 - similar**rows) ** bands < recall:
        bands += 1
    return bands


BANDS = tune_bands()
_SEEDS = np.random.default_rng(11).integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(pick, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of the last axis, by windows of doubled width."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[..., :-step], x[..., step:])
        have += step
    return x


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words (A-Z folded), whether each begins a sentence or line, and the texts' offsets."""
    words: list[bytes] = []
    lines: list[int] = []
    offsets = [0]
    for text in texts:
        for line in text.encode().lower().split(b"\n"):
            lines.append(len(words))
            words += line.split()
        offsets.append(len(words))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(0)), np.uint64, len(words))
    begins = np.zeros(len(words) + 1, bool)
    begins[1:] = np.fromiter((w[-1] in b".!?" for w in words), bool, len(words))
    begins[lines] = True
    return hashes, begins[:-1], np.array(offsets)


def paragraph_starts(hashes: np.ndarray, begins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The places where rolling paragraphs begin: in each full window of a text those with the smallest hash.

    The last words of a text begin no paragraph, so a window cannot reach from one text into the next.
    """
    size = np.diff(offsets)
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], size)
    last = np.repeat(size - LENGTH, size)  # the last place of the text that holds a paragraph
    pairs = _mixed(hashes + np.append(hashes[1:], np.uint64(0)) * _ODD)
    marked = begins | (pairs % np.uint64(ANCHOR) == 0)
    free = place <= last
    order = np.where(free, (pairs >> np.uint64(2)) + np.uint64(1) + np.where(marked, np.uint64(0), _UNMARKED), _LAST)
    lowest = _sliding(np.minimum, np.append(order, np.full(WINDOW - 1, _LAST)), WINDOW)
    lowest[place > np.maximum(0, last - WINDOW + 1)] = 0  # not a full window
    around = _sliding(np.maximum, np.append(np.zeros(WINDOW - 1, np.uint64), lowest), WINDOW)
    return np.nonzero(free & (order == around))[0]


def band_keys(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each paragraph a key for each band, as signed longs; of a word the upper 32 bits count, as in ``same_words``."""
    hashes = hashes >> np.uint64(32)
    width = LENGTH - SHINGLE + 1
    shingles = np.zeros(len(hashes) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        shingles = shingles * _ODD + hashes[k : k + len(shingles)]
    shingles = _mixed(shingles)
    keys = np.zeros((len(starts), BANDS), np.uint64)
    for k, seed in enumerate(_SEEDS):
        lowest = _sliding(np.minimum, ((shingles * seed) >> np.uint64(32)).astype(np.uint32), width)[starts]
        band = k // BAND_ROWS
        keys[:, band] = _mixed(keys[:, band] * _ODD + lowest + np.uint64(band + 1))
    return keys.view(np.int64)


def same_words(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each paragraph as 32-bit numbers, and a hash of all of them."""
    words = np.lib.stride_tricks.sliding_window_view(hashes, LENGTH)[starts]
    whole = np.zeros(len(starts), np.uint64)
    for k in range(LENGTH):
        whole = _mixed(whole * _ODD + words[:, k])
    return (words >> np.uint64(32)).astype("<u4"), whole.view(np.int64)


def shingle_ids(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word shingles of each paragraph as 64-bit numbers, and which of them are not repeats within it."""
    width = LENGTH - SHINGLE + 1
    ids = np.zeros((len(words), width), np.uint64)
    for k in range(SHINGLE):
        ids = _mixed(ids * _ODD + words[:, k : k + width])
    again = np.zeros(ids.shape, bool)
    for k in range(1, width):
        again[:, k] = (ids[:, :k] == ids[:, k : k + 1]).any(axis=1)
    return ids, ~again


def similar_pairs(ids: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray, similar: float = SIMILAR) -> np.ndarray:
    """Whether the exact Jaccard similarity of the shingle sets of ``left`` and ``right`` reaches the threshold."""
    out = np.zeros(len(left), bool)
    size = first.sum(axis=1)
    for k in range(0, len(left), PAIRS):
        a, b = left[k : k + PAIRS], right[k : k + PAIRS]
        same = (ids[a][:, :, None] == ids[b][:, None, :]).any(axis=2)
        shared = (same & first[a]).sum(axis=1)
        out[k : k + PAIRS] = shared >= similar * (size[a] + size[b] - shared)
    return out


def pairs_within(sizes: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places inside consecutive groups; with a split above 0, of one place before and one after it."""
    left, right = [], []
    start = 0
    for size, split in zip(sizes.tolist(), splits.tolist()):
        if split:
            i, j = np.divmod(np.arange(split * (size - split)), size - split)
            j += split
        else:
            i, j = np.triu_indices(size, 1)
        left.append(i + start)
        right.append(j + start)
        start += size
    return np.concatenate(left), np.concatenate(right)


def _paragraphs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts: first row, word hashes, starts, row of each start, its place in the text, its keys."""
    for first in range(0, len(column), ROWS):
        hashes, begins, offsets = word_hashes([v.as_py() or "" for v in column[first : first + ROWS]])
        starts = paragraph_starts(hashes, begins, offsets) if len(hashes) else np.zeros(0, np.int64)
        if len(starts):
            row = np.searchsorted(offsets, starts, side="right") - 1
            yield first, hashes, starts, row, starts - offsets[row], band_keys(hashes, starts)


def _bit_table(docs: DataFrame) -> np.ndarray:
    """A Bloom filter of the keys that occur in at least two rows, in pages; its size follows the number of these keys.

    A row counts once for a key: paragraphs of one text overlap and often share keys.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, row, _, found in _paragraphs(batch.column(0)):
                pairs = np.stack([np.repeat(row, BANDS), found.ravel()])
                order = np.lexsort(pairs)
                pairs = pairs[:, order]
                fresh = np.append(True, (np.diff(pairs) != 0).any(axis=0))
                yield pa.record_batch({"key": pa.array(pairs[1, fresh])})

    counted = map_batches(docs.select("__text"), keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    repeated = cut(counted.filter("n > 1").select("key"))
    pages = 1
    least = repeated.count() * KEY_BITS
    while pages < PAGES and pages * PAGE < least:
        pages *= 2
    # Keys are dealt by page before bits are set, so no task sends pages on that others fill too.
    dealt = repeated.withColumn("page", F.shiftright("key", 15 * MARKS).bitwiseAND(F.lit(pages - 1))).repartition("page")
    marks = F.array(*[F.shiftright("key", 15 * k).bitwiseAND(F.lit(PAGE - 1)) for k in range(MARKS)])
    filled = dealt.select("page", F.explode(marks).alias("mark")).groupBy("page").agg(F.expr("bitmap_construct_agg(mark)").alias("bits"))
    table = np.zeros(pages * PAGE // 8, np.uint8)
    for r in filled.toLocalIterator():
        table[r["page"] * PAGE // 8 : (r["page"] + 1) * PAGE // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return table


def _in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of each key are set; they are for all that were entered, and for few others."""
    page = ((keys >> np.int64(15 * MARKS)) & np.int64(len(table) * 8 // PAGE - 1)) * PAGE
    found = np.ones(keys.shape, bool)
    for k in range(MARKS):
        slots = page + ((keys >> np.int64(15 * k)) & np.int64(PAGE - 1))
        found &= (table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)
    return found


def sided(left: Column, right: Column) -> Column:
    """The members of the lists ``left`` and ``right`` as ``(second, u)``, with the given mark of their list.

    The functions take one argument: of two, Spark would give the second one the place in the list.
    """
    one = F.transform("left", lambda x: F.struct(left.alias("second"), x.alias("u")))
    two = F.transform("right", lambda x: F.struct(right.alias("second"), x.alias("u")))
    return F.concat(one, two)


def _compared(groups: DataFrame, distinct: DataFrame) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links in each group ``(left, right)``: between the two lists, or within ``left`` where
    ``right`` is empty."""
    groups = cut(groups.distinct().withColumn("group", F.monotonically_increasing_id()))
    members = groups.select("group", F.explode(sided(F.lit(False), F.lit(True))).alias("m")).select("group", "m.second", "m.u")
    tasks = members.join(distinct.select("u", "words"), "u").groupBy("group").agg(F.collect_list(F.struct("second", "u", "words")).alias("rows")).select("rows")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, ROWS):
                rows = whole_batch.slice(start, ROWS).column(0)
                offsets = rows.offsets.to_numpy()
                inner = rows.values.slice(offsets[0], offsets[-1] - offsets[0])
                sizes = np.diff(offsets)
                group = np.repeat(np.arange(len(sizes)), sizes)
                second = inner.field("second").to_numpy(zero_copy_only=False)
                u = inner.field("u").to_numpy()
                words = np.frombuffer(b"".join(inner.field("words").to_pylist()), "<u4").reshape(-1, LENGTH)
                order = np.lexsort([u, second, group])
                u, words = u[order], words[order]
                firsts = np.bincount(group, ~second, len(sizes)).astype(np.int64)
                left, right = pairs_within(sizes, np.where(firsts < sizes, firsts, 0))
                found = similar_pairs(*shingle_ids(words), left, right)
                label = forest(len(u), left[found], right[found])
                moved = label != np.arange(len(u))
                if moved.any():
                    yield pa.record_batch({"a": pa.array(u[moved]), "b": pa.array(u[label[moved]])})

    return map_batches(tasks, compare, "a long, b long")


def _keyed(distinct: DataFrame) -> DataFrame:
    """``(u, key)`` for the different band keys of each paragraph, computed again from its words, which are kept anyway."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            words = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").astype(np.uint64) << np.uint64(32)
            if len(words):
                keys = np.sort(band_keys(words, np.arange(0, len(words), LENGTH)), axis=1)
                fresh = np.ones(keys.shape, bool)
                fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
                u = np.repeat(batch.column(0).to_numpy(), fresh.sum(axis=1))
                yield pa.record_batch({"u": pa.array(u), "key": pa.array(keys[fresh])})

    return map_batches(distinct.select("u", "words"), run, "u long, key long")


def _near_links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all similar ones of the different paragraphs ``(whole, words)`` which share a band.

    Words are sent on only of paragraphs that share a band, and to leaders and tiles only of those in larger bands. In a band of up to ``SMALL`` members all meet at once. In a larger one two leaders meet the members, work in
    proportion to these; then only tiles of members that no link connects meet each other.
    """
    from tidemark.llm.near_copies import _led, _left_over, _rooted  # that module reads words by this one

    distinct = distinct.select(F.col("whole").alias("u"), "words")
    keyed = cut(_keyed(distinct))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = cut(keyed.join(sizes, "key"))
    worded = cut(distinct.join(crowded.groupBy("u").agg(F.max("n").alias("most")), "u"))
    small = crowded.filter(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("u")).alias("left"))
    inside = cut(_compared(small.select("left", F.array().cast("array<bigint>").alias("right")), worded))
    large = crowded.filter(F.col("n") > SMALL)
    worded = worded.filter(F.col("most") > SMALL)
    sharing = large.groupBy("u").agg(F.sum("n").alias("shared"))
    size = F.lit(LENGTH).cast("bigint").alias("size")
    members = _rooted(large.join(sharing, "u").select("key", "u", size, "shared"), None)
    groups, leaders = _led(members, None, TILE)
    links = cut(_compared(groups, worded))
    members = _rooted(members.drop("root"), links)
    roots = members.select(F.col("u").alias("leader"), F.col("root").alias("now")).distinct()
    groups, _ = _led(members, leaders.join(roots, "leader").select("key", F.col("now").alias("led")), TILE)
    links = cut(links.unionByName(_compared(groups, worded)))
    members = _rooted(members.drop("root"), links)
    return inside.unionByName(links).unionByName(_compared(_left_over(members, TILE), worded))


def repeated_passages(docs: DataFrame, text: str = "text", id_column: str = "doc_id", least: int = LEAST) -> DataFrame:
    """Spans of words that other documents repeat: ``(id, first_word, end_word, n_words, component_id, removed)``.

    Paragraphs that are equal or similar form a component. The document with its smallest id keeps it; from
    all others it is to be removed. Overlapping paragraphs of a document with the same fate are one span, and its
    ``component_id`` is the smallest id that holds a part of it. Words are counted from 0 over the whole text,
    ``end_word`` is past the span. Paragraphs that only one document repeats, and spans of fewer than ``least``
    words, are not reported.

    NULL and empty texts, texts shorter than a paragraph and rows with a NULL id have no spans; rows that repeat an
    id count as one document; an empty table gives an empty result.
    """
    source = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    source = source.filter(F.col("__id").isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast(_bit_table(source))
    kind = docs.schema[id_column].dataType.simpleString()

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for first, hashes, starts, row, place, keys in _paragraphs(batch.column(1)):
                marked = _in_table(table, keys).any(axis=1)
                if marked.any():
                    words, whole = same_words(hashes, starts[marked])
                    columns = [
                        batch.column(0).take(pa.array(first + row[marked])),
                        pa.array(place[marked]),
                        pa.array([w.tobytes() for w in words], pa.binary()),
                        pa.array(whole),
                    ]
                    yield pa.record_batch(columns, names=["__id", "at", "words", "whole"])

    found = cut(map_batches(source, hits, f"__id {kind}, at long, words binary, whole long"))
    distinct = found.groupBy("whole").agg(F.first("words").alias("words"), F.min("__id").alias("low"), F.max("__id").alias("high"))
    distinct = cut(distinct)
    roots = components(_near_links(distinct))
    # A paragraph without links has a class only with its equals, and only if they have several ids.
    named = distinct.select("whole", "low", "high").join(roots, F.col("whole") == F.col("node"), "left")
    named = cut(named.filter("root IS NOT NULL OR low < high").select("whole", "low", "high", "root"))
    linked = named.filter("root IS NOT NULL")
    classes = linked.groupBy("root").agg(F.min("low").alias("keeper"), F.max("high").alias("last")).filter("keeper < last")
    alone = named.filter("root IS NULL").select("whole", F.col("low").alias("keeper"))
    keepers = cut(linked.join(classes, "root").select("whole", "keeper").unionByName(alone))
    members = found.select("__id", "at", "whole").join(keepers, "whole")
    members = members.select("__id", "at", "keeper", (F.col("__id") != F.col("keeper")).alias("removed"))
    return _spans(members, least).withColumnRenamed("__id", id_column)


def _spans(members: DataFrame, least: int) -> DataFrame:
    """Overlapping paragraphs of a document as one span; a document holds few, so a window by document is small."""
    in_order = Window.partitionBy("__id", "removed").orderBy("at")
    touches = F.col("at") <= F.lag("at").over(in_order) + LENGTH
    grouped = members.withColumn("fresh", F.when(touches, 0).otherwise(1)).withColumn("span", F.sum("fresh").over(in_order))
    spans = grouped.groupBy("__id", "removed", "span").agg(
        F.min("at").alias("first_word"), (F.max("at") + LENGTH).alias("end_word"), F.min("keeper").alias("component_id")
    )
    size = F.col("end_word") - F.col("first_word")
    return spans.filter(size >= least).select("__id", "first_word", "end_word", size.alias("n_words"), "component_id", "removed")
