"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

The first read takes only the length and a hash of the beginning of each text and counts them as one
key (a unique length is a group of one and leaves here). Keys that occur twice or more are entered in
a bit table of fixed size. The second read computes the full digest only where the bit of a row is
set; all other rows are proven unique. The bit table is broadcast: its size is a constant, whatever
the input (``2 ** bits / 8`` bytes), and a wrongly set bit only costs one digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, text_of, without
from tidemark.session import cut

PREFIX = 64  # characters in the prefix hash
BITS = 24  # the bit table has 2 ** BITS bits, 2 MB
PAGE = 32_768  # bits in one value of Spark's bitmap functions
OWN = ("__page", "__bit", "__bitmap", "__digest", "__best", "__size")


def _prefix_key(text: Column) -> Column:
    """Length and hash of the beginning. The A-Z folding does not change lengths."""
    return F.xxhash64(F.octet_length(text), ascii_lower(F.substring(text, 1, PREFIX)))


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """Page and bit of a key in the bit table."""
    slot = key.bitwiseAND(F.lit(2**bits - 1))
    return F.shiftright(slot, 15), slot.bitwiseAND(F.lit(PAGE - 1))


def _repeated_keys(docs: DataFrame, text: str, bits: int) -> DataFrame:
    """The bit table of the (length, prefix hash) keys that occur at least twice: (page, bitmap)."""
    counted = (
        docs.select(F.octet_length(text_of(text)).alias("n"), _prefix_key(text_of(text)).alias("key"))
        .groupBy("n", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )
    page, bit = _place(F.col("key"), bits)
    return (
        counted.select(page.alias("__page"), bit.cast("bigint").alias("bit"))
        .groupBy("__page")
        .agg(F.expr("bitmap_construct_agg(bit)").alias("__bitmap"))
    )


def digested(docs: DataFrame, text: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with ``__digest``: the SHA-256 of a text that may have a copy, NULL for a proven unique text."""
    key = _prefix_key(text_of(text))
    page, bit = _place(key, bits)
    table = F.broadcast(_repeated_keys(docs, text, bits))
    byte = F.expr("conv(hex(substring(__bitmap, __bit div 8 + 1, 1)), 16, 10)").cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(__bit % 8 AS int))")) != 0
    kept = [F.col(f"`{c}`") for c in without(docs, *OWN).columns]
    digest = F.when(F.col("__bitmap").isNotNull() & is_set, F.sha2(ascii_lower(text_of(text)), 256))
    return (
        without(docs, *OWN)
        .withColumns({"__page": page, "__bit": bit})
        .join(table, "__page", "left")
        .select(*kept, digest.alias("__digest"))
    )


def _groups(rows: DataFrame, id_column: str) -> DataFrame:
    """One row per digest that occurs twice or more, written once.

    Partial sums keep a huge group of copies cheap; a join with the written table can be split where one
    digest has very many rows.
    """
    return cut(
        rows.groupBy("__digest")
        .agg(F.max(f"`{id_column}`").alias("__best"), F.count(F.lit(1)).alias("__size"))
        .filter(F.col("__size") > 1)
    )


def exact_groups(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", carried: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size`` and ``kept``; ``carried`` names the columns to return.

    Equal texts (after folding A-Z) form a group; its largest id stays. NULL text is the empty text. A
    NULL id is smaller than any other; if all ids of a group are NULL, ``keep_id`` is NULL and each of
    its rows is marked kept, as are rows that repeat both the id and the text: they are one document.
    An empty table gives an empty result. Columns of ``docs`` with the names of the results are
    replaced.

    The carried columns are written once; without ``carried`` they are all columns but the text.
    """
    source = without(docs, "keep_id", "group_size", "kept")
    carried = carried or [c for c in source.columns if c != text]
    rows = cut(digested(source, text).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*carried, id_column])], "__digest"))
    plain = [F.col(f"`{c}`") for c in rows.columns if c != "__digest"]
    own = F.col(f"`{id_column}`")
    unique = rows.filter(F.col("__digest").isNull()).select(
        *plain, own.alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    shared = rows.filter(F.col("__digest").isNotNull())
    joined = shared.join(_groups(shared, id_column), "__digest", "left")
    single = F.col("__size").isNull()
    copies = joined.select(
        *plain,
        F.when(single, own).otherwise(F.col("__best")).alias("keep_id"),
        F.coalesce(F.col("__size"), F.lit(1).cast("bigint")).alias("group_size"),
        (single | own.eqNullSafe(F.col("__best"))).alias("kept"),
    )
    return unique.unionByName(copies)


def exact_dedup(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns: of equal texts one row, that with the largest id.

    Rows that repeat id and text leave one row. Proven unique texts are never shuffled; only texts that
    may have copies are joined with their groups, and Spark splits a group that is too large.
    """
    rows = digested(docs, text)
    narrow = digested(docs.select(f"`{id_column}`", f"`{text}`"), text).filter(F.col("__digest").isNotNull())
    unique = rows.filter(F.col("__digest").isNull()).drop("__digest")
    shared = rows.filter(F.col("__digest").isNotNull())
    best = (
        shared.join(_groups(narrow, id_column), "__digest", "left")
        .filter(F.col("__size").isNull() | F.col(f"`{id_column}`").eqNullSafe(F.col("__best")))
        .drop("__best", "__size")
        .dropDuplicates(["__digest"])
        .drop("__digest")
    )
    return unique.unionByName(best)
