"""Numeric and null expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GIB = 1024 ** 3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def exact(c: Column | str) -> Column:
    """A two-decimal amount whose sums do not depend on the order of addition."""
    return _col(c).cast("decimal(18,2)")


def gib(c: Column | str) -> Column:
    return F.round(_col(c) / F.lit(GIB), 2)


def whole_percent(part: Column | str, total: Column | str) -> Column:
    """Integer percentage, rounded down; NULL for an empty total."""
    return F.floor(F.try_divide(_col(part) * 100, _col(total))).cast("int")


def number_prefix(c: Column | str, digits: int) -> Column:
    """Leading ``digits`` characters as an integer; NULL when they are not a number."""
    return F.substring(_col(c), 1, digits).try_cast("int")


def is_missing(field: T.StructField) -> Column:
    """NULL, or NaN for floating-point columns only."""
    c = quoted(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def any_missing(df: DataFrame, columns: list[str] | None = None) -> Column:
    wanted = columns or df.columns
    return reduce(lambda a, b: a | b, [is_missing(df.schema[c]) for c in wanted])


def row_hash(*columns: Column | str) -> Column:
    """64-bit hash of a tuple. Spark's hash passes over NULLs, so it also takes which members are NULL."""
    members = [_col(c) for c in columns]
    return F.xxhash64(*[c.isNull() for c in members], *members)


def exploded(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One more column with the members of an array; rows with no members drop out.

    A plain ``explode`` makes Spark test the array's size in a filter below, which computes a costly
    array expression a second time.
    """
    rows = df.select("*", F.posexplode_outer(items).alias("_at", name))
    return rows.filter("_at IS NOT NULL").drop("_at")


def fill_values(df: DataFrame, text: str = "unknown", number: float = 0) -> dict[str, object]:
    """Fill value per column, from the schema: text for strings, number for numerics."""
    out: dict[str, object] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out[f.name] = text
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = number
    return out
