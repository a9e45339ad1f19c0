"""Ordering, unions and set comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import quoted


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order; every task keeps at most ``k`` rows."""
    return df.orderBy(*order).limit(k)


def union_conformed(dfs: list[DataFrame], defaults: dict[str, object] | None = None) -> DataFrame:
    """Union by name; a column that a source lacks is filled with its default, else NULL.

    Only a missing column gets the default: a NULL inside a source stays NULL.
    """
    defaults = defaults or {}
    names = list(dict.fromkeys(c for df in dfs for c in df.columns))
    types = {f.name: f.dataType for df in dfs for f in df.schema.fields}
    out = None
    for df in dfs:
        part = df.select(
            *[
                quoted(n) if n in df.columns else F.lit(defaults.get(n)).cast(types[n]).alias(n)
                for n in names
            ]
        )
        out = part if out is None else out.unionByName(part)
    return out


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def compare_sets(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Each different tuple with where it occurs: ``both``, ``left`` or ``right``; one shuffle."""
    marked = a.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        b.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    seen = marked.groupBy(*columns).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    side = F.when((F.col("_l") == 1) & (F.col("_r") == 1), "both").when(F.col("_l") == 1, "left").otherwise("right")
    return seen.select(*columns, side.alias("side"))


def array_difference(a: Column, b: Column) -> dict[str, Column]:
    """Members of two arrays: in both, only left, only right; sorted."""
    return {
        "in_both": F.array_sort(F.array_intersect(a, b)),
        "only_left": F.array_sort(F.array_except(a, b)),
        "only_right": F.array_sort(F.array_except(b, a)),
    }
