"""Grouped results (A2, A5-A15). Every aggregate combines partially before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import is_missing, quoted
from tidemark.operators.windows import number_rows


def code_sums(code: str, amount: Column, names: dict[object, str]) -> list[Column]:
    """One sum per code; other codes count as zero."""
    zero = F.lit(0)
    return [F.sum(F.when(quoted(code) == k, amount).otherwise(zero)).alias(n) for k, n in names.items()]


def sum_by_code(df: DataFrame, keys: list[str], code: str, amount: Column, names: dict[object, str]) -> DataFrame:
    """Conditional sums, one column per code; only the listed codes are shuffled."""
    return df.filter(quoted(code).isin(*names)).groupBy(*keys).agg(*code_sums(code, amount, names))


def count_by_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.groupBy(F.col("_metadata.file_name").alias(name)).agg(F.count(F.lit(1)).alias("n"))


def count_by_year(df: DataFrame, ts: str, column: str) -> DataFrame:
    """Rows per year and value, ordered."""
    return (
        df.groupBy(F.year(ts).alias("year"), column).agg(F.count(F.lit(1)).alias("n")).orderBy("year", column)
    )


def duplicate_groups(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Groups that occur more than once, with their size."""
    return df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column and the row count, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(is_missing(f)).alias(f"n{i}") for i, f in enumerate(df.schema.fields)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("missing"), F.col("total").alias("total"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select(F.inline(rows))


def max_value(df: DataFrame, column: str, name: str = "watermark") -> DataFrame:
    return df.agg(F.max(column).alias(name))


def collapse_max(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the largest value of every other column."""
    return df.groupBy(*keys).agg(*[F.max(quoted(c)).alias(c) for c in df.columns if c not in keys])


def string_agg(
    df: DataFrame, keys: list[str], column: str, sep: str = ",", distinct: bool = True, name: str = "items"
) -> DataFrame:
    """Values of a group as one ordered text.

    Equal values are merged before the shuffle (with their count unless ``distinct``), so a group is
    only as large as its number of different values. Each text is one cell of the result;
    ``string_parts`` gives the groups that no cell can hold.
    """
    value = quoted(column).cast("string")
    merged = df.filter(quoted(column).isNotNull()).groupBy(*keys, value.alias("_v")).agg(
        F.count(F.lit(1)).cast("int").alias("_n")
    )
    items = F.array_sort(F.collect_list(F.struct("_v", "_n")))
    item = (lambda x: x["_v"]) if distinct else (lambda x: F.array_join(F.array_repeat(x["_v"], x["_n"]), sep))
    return merged.groupBy(*keys).agg(F.array_join(F.transform(items, item), sep).alias(name))


def string_parts(
    df: DataFrame, keys: list[str], column: str, sep: str = ",", items: int = 10_000, name: str = "items"
) -> DataFrame:
    """The different values of a group as ordered texts of ``items`` values each: ``(keys, part, text)``.

    The values are numbered by a distributed sort, so a group of any size is spread over tasks.
    """
    different = df.filter(quoted(column).isNotNull()).select(*keys, quoted(column).cast("string").alias("_v")).distinct()
    numbered = number_rows(different, ["_v"], "_no", partition=keys, unique=True)
    parts = numbered.withColumn("part", F.expr(f"(_no - 1) div {int(items)}"))
    values = F.array_sort(F.collect_list(F.struct("_no", "_v")))
    return parts.groupBy(*keys, "part").agg(F.array_join(F.transform(values, lambda x: x["_v"]), sep).alias(name))


def ordered_distinct(df: DataFrame, keys: list[str], column: str, position: str, sep: str = ", ", name: str = "items") -> DataFrame:
    """Different values of a group in the order of their first position, as one text."""
    firsts = df.filter(quoted(column).isNotNull()).groupBy(*keys, column).agg(F.min(position).alias("_p"))
    items = F.array_sort(F.collect_list(F.struct("_p", quoted(column).alias("_v"))))
    text = F.array_join(F.transform(items, lambda x: x["_v"]), sep)
    return firsts.groupBy(*keys).agg(text.alias(name))


def rows_as_json(df: DataFrame, keys: list[str], columns: dict[str, str], name: str = "body") -> DataFrame:
    """The rows of each group as one JSON array, ordered by the listed columns (JSON name to column)."""
    rows = df.select(*keys, F.struct(*[quoted(c).alias(n) for n, c in columns.items()]).alias("_row"))
    body = F.to_json(F.array_sort(F.collect_list("_row")))
    return rows.groupBy(*keys).agg(body.alias(name))


def status_summary(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def distinct_count(df: DataFrame, keys: list[str], column: str, name: str = "n_values") -> DataFrame:
    """Different values per group, or of the whole table without keys; pairs are merged before the shuffle."""
    pairs = df.filter(quoted(column).isNotNull()).select(*keys, column).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def pivot_max(df: DataFrame, keys: list[str], column: str, values: list[object], value: str) -> DataFrame:
    """Listed values as columns, holding the largest ``value``."""
    return df.groupBy(*keys).pivot(column, values).agg(F.max(value))


def grid(df: DataFrame, column: str, n: int, order: list[str], within: list[str | Column] | None = None) -> DataFrame:
    """Lay a list out in ``n`` columns: row number modulo ``n`` picks the column, ``within`` orders it.

    Both numberings are distributed, although there are only ``n`` buckets.
    """
    within = within or order
    numbered = number_rows(df, order, "_rn")
    placed = numbered.withColumn("_bucket", F.pmod("_rn", F.lit(n)).cast("int"))
    lined = number_rows(placed, within, "row_no", partition=["_bucket"])
    cells = lined.groupBy("row_no").agg(
        *[F.max(F.when(F.col("_bucket") == b, quoted(column))).alias(f"col_{b}") for b in range(n)]
    )
    return cells
