"""Numbering, deduplication and filling (W1-W6, A7) without one-task windows.

Two rules keep hot keys harmless. Keeping the first row of a key is a ``row_number() = 1`` filter,
which Spark reduces to one row per key and task before the shuffle. Everything that needs a
position over a long run of rows is range-partitioned and stitched from per-partition summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import quoted
from tidemark.session import cut

COPY_CHUNK = 100_000
FAN, LEVELS = 1_000, 3  # blocks that are scanned together, and how often their totals are grouped again
_POSITION_BITS = 33


def _columns(order: list[str | Column]) -> list[Column]:
    return [quoted(o) if isinstance(o, str) else o for o in order]


def _total(df: DataFrame, leading: list[str], order: list[str | Column]) -> list[Column]:
    """An order without ties between different rows: the given one, then all columns it does not name."""
    named = {*leading, *[o for o in order if isinstance(o, str)]}
    return [*_columns(order), *[quoted(c) for c in df.columns if c not in named]] or [quoted(leading[0])]


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key. All columns break ties, so the survivor does not depend on the plan."""
    w = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*_total(df, keys, order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def repeat_rows(df: DataFrame, times: str, index: str | None = None) -> DataFrame:
    """Each row ``times`` times (optionally numbered from 1).

    Every row is cut into chunks of copies first, and the chunks are dealt over all tasks.
    """
    kept = [quoted(c) for c in df.columns if c != times]
    wanted = quoted(times).cast("bigint")
    last_chunk = F.floor((wanted - 1) / COPY_CHUNK).cast("bigint")
    chunks = df.filter(wanted > 0).select(*kept, wanted.alias("_t"), F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_c"))
    first = F.col("_c") * COPY_CHUNK + 1
    last = F.least(first + (COPY_CHUNK - 1), F.col("_t"))
    copies = chunks.repartition(*kept, F.col("_c")).select(*kept, F.explode(F.sequence(first, last)).alias("_i"))
    return copies.withColumnRenamed("_i", index) if index else copies.drop("_i")


def number_copies(df: DataFrame, name: str) -> DataFrame:
    """Number the exact copies of each row from 1, so that (row, number) is unique."""
    counted = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return repeat_rows(counted, "_copies", name)


def multiset_minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` without as many copies as ``b`` holds; merged before the shuffle."""
    names = [quoted(c) for c in a.columns]
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    left = signed.groupBy(*names).agg(F.sum("_n").alias("_n")).filter("_n > 0")
    return repeat_rows(left, "_n")


def identified(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` written with a number for each row, so that a row keeps its identity in whatever is computed from it."""
    return cut(df.withColumn(name, F.monotonically_increasing_id()))


def dedup_by_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and all other rows.

    Rows are written with a number each; the removed ones are those whose number was not kept, an anti join
    on one number. A key is reduced to one row for each task before anything moves.
    """
    rows = identified(df)
    kept = first_per_key(rows, keys, order)
    return kept.drop("_row"), rows.join(kept.select("_row"), "_row", "left_anti").drop("_row")


def distinct_on(df: DataFrame, columns: list[str], order: list[str | Column]) -> DataFrame:
    """Like ``dropDuplicates(columns)``, with a defined survivor."""
    return first_per_key(df, columns, order)


def number_rows(
    df: DataFrame,
    order: list[str | Column],
    name: str,
    start: int | Column = 1,
    partition: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Dense row numbers over the whole table, or within ``partition``.

    The table is sorted by range and written with each row's position in its range, and the sizes of
    the ranges (one row each) give the offsets. ``unique`` says that ``order`` has no ties; otherwise
    all columns and a written row number break them, so equal rows also spread over ranges.
    """
    partition = partition or []
    columns = df.columns
    if unique:
        total = [*[quoted(p) for p in partition], *_columns(order)]
    else:
        df = identified(df)
        total = [*[quoted(p) for p in partition], *_total(df, partition, order)]
    placed = cut(df.orderBy(*total).withColumn("_pos", F.monotonically_increasing_id()))
    position_mask = F.lit((1 << _POSITION_BITS) - 1)
    ranged = placed.select(
        *[quoted(c) for c in columns],
        F.shiftright("_pos", _POSITION_BITS).cast("int").alias("_range"),
        F.col("_pos").bitwiseAND(position_mask).alias("_at"),
    )
    # One row per range: as many rows as the sort has partitions, so this window and broadcast are small.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = ranged.join(F.broadcast(offsets), "_range")
    dense = F.col("_at") + F.col("_offset")
    start = F.lit(start) if isinstance(start, int) else start
    if not partition:
        return numbered.select(*[quoted(c) for c in columns], (dense + start).cast("bigint").alias(name))
    numbered = numbered.select(*[quoted(c) for c in columns], dense.alias("_dense"))
    firsts = numbered.groupBy(*[quoted(p).alias(f"_key_{p}") for p in partition]).agg(F.min("_dense").alias("_first"))
    same = [quoted(p).eqNullSafe(quoted(f"_key_{p}")) for p in partition]
    return numbered.join(firsts, same).select(
        *[quoted(c) for c in columns], (F.col("_dense") - F.col("_first") + start).cast("bigint").alias(name)
    )


def _before(blocks: DataFrame, keys: list[str], value: Column, carry: str, levels: int = LEVELS) -> DataFrame:
    """``(keys, _block, carry)``: the sum, or for ``carry == "_last"`` the last non-NULL, of ``value`` over all earlier blocks of the keys.

    Blocks are scanned in groups of ``FAN``, their totals again in groups, and so on, so no task scans more than a group
    except at the top, where a row stands for ``FAN ** levels`` blocks.
    """
    by = [quoted(k) for k in keys]
    last = carry == "_last"
    rows = blocks.select(*by, "_block", value.alias("_value"))

    def earlier(w) -> Column:
        w = w.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        return F.last("_value", ignorenulls=True).over(w) if last else F.coalesce(F.sum("_value").over(w), F.lit(0))

    if not levels:
        return rows.select(*by, "_block", earlier(Window.partitionBy(*by)).alias(carry))
    rows = rows.withColumn("_group", F.floor(F.col("_block") / FAN))
    inside = rows.withColumn("_inside", earlier(Window.partitionBy(*by, "_group")))
    total = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_block"))) if last else F.sum("_value")
    totals = rows.groupBy(*by, "_group").agg(total.alias("_total")).withColumnRenamed("_group", "_block")
    above = _before(totals, keys, F.col("_total"), "_last" if last else "_sum", levels - 1)
    above = above.select(*[quoted(k).alias(f"_up_{k}") for k in keys], F.col("_block").alias("_up_block"), F.col(above.columns[-1]).alias("_above"))
    same = [F.col("_group") == F.col("_up_block"), *[quoted(k).eqNullSafe(quoted(f"_up_{k}")) for k in keys]]
    found = F.coalesce("_inside", "_above") if last else F.col("_inside") + F.col("_above")
    return inside.join(above, same).select(*by, "_block", found.alias(carry))


def forward_fill(
    df: DataFrame, column: str, order: list[str], partition: list[str] | None = None, unique: bool = False
) -> DataFrame:
    """Replace NULL by the last value before it, in ``order``.

    Rows are numbered, cut into blocks of equal length, filled inside the block, and what is still
    NULL takes the last value of the blocks before it. A hot partition is many blocks.
    """
    partition = partition or []
    keys = [quoted(p) for p in partition]
    numbered = number_rows(df, [*partition, *order], "_no", unique=unique)
    blocks = numbered.withColumn("_block", F.floor((F.col("_no") - 1) / COPY_CHUNK))
    inside = Window.partitionBy(*keys, "_block").orderBy("_no").rowsBetween(Window.unboundedPreceding, 0)
    filled = blocks.withColumn("_in", F.last(column, ignorenulls=True).over(inside))
    lasts = blocks.groupBy(*keys, "_block").agg(
        F.max_by(quoted(column), F.when(quoted(column).isNotNull(), F.col("_no"))).alias("_last_in")
    )
    carried = _before(lasts, partition, F.col("_last_in"), "_last")
    carried = carried.select(*[quoted(p).alias(f"_key_{p}") for p in partition], F.col("_block").alias("_at_block"), F.col("_last").alias("_carry"))
    same = [F.col("_block") == F.col("_at_block"), *[quoted(p).eqNullSafe(quoted(f"_key_{p}")) for p in partition]]
    value = F.coalesce(F.col("_in"), F.col("_carry"))
    out = [value.alias(c) if c == column else quoted(c) for c in df.columns]
    return filled.join(carried, same, "left").select(*out)


def earliest_version(df: DataFrame, attributes: list[str], start: str, end: str | None = None) -> DataFrame:
    """The earliest version of each attribute tuple."""
    return first_per_key(df, attributes, [start] + ([end] if end else []))


def running_count(
    df: DataFrame, column: str, order: list[str], name: str, partition: list[str] | None = None, unique: bool = False
) -> DataFrame:
    """Non-NULL values up to each row, in ``order``: blocks of rows, then block totals."""
    partition = partition or []
    keys = [quoted(p) for p in partition]
    numbered = number_rows(df, [*partition, *order], "_no", unique=unique)
    blocks = numbered.withColumn("_block", F.floor((F.col("_no") - 1) / COPY_CHUNK))
    inside = Window.partitionBy(*keys, "_block").orderBy("_no").rowsBetween(Window.unboundedPreceding, 0)
    counted = blocks.withColumn("_in", F.count(column).over(inside))
    totals = blocks.groupBy(*keys, "_block").agg(F.count(column).alias("_total"))
    carried = _before(totals, partition, F.col("_total"), "_sum")
    carried = carried.select(*[quoted(p).alias(f"_key_{p}") for p in partition], F.col("_block").alias("_at_block"), F.col("_sum").alias("_carry"))
    same = [F.col("_block") == F.col("_at_block"), *[quoted(p).eqNullSafe(quoted(f"_key_{p}")) for p in partition]]
    return counted.join(carried, same, "left").select(
        *[quoted(c) for c in df.columns], (F.col("_in") + F.col("_carry")).alias(name)
    )
