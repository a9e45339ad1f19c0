"""Lookup, membership and pre-aggregated joins.

No side is broadcast by a hint: joins are left to Spark's own size thresholds and to AQE, which also
splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import exploded, quoted


def new_rows(src: DataFrame, tgt: DataFrame, keys: list[str] | None = None, on: Column | None = None) -> DataFrame:
    """Source rows without a match in the target, by key columns or by an expression over ``s`` and ``t``."""
    if keys is not None:
        return src.join(tgt.select(*keys), keys, "left_anti")
    return src.alias("s").join(tgt.alias("t"), on, "left_anti")


def keep_matching(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in the other relation."""
    return df.join(other.select(*keys), keys, "left_semi")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    key: str,
    fk: str,
    current: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Add one foreign key column; ``on`` maps fact columns to dimension columns.

    Only the needed dimension columns enter the join, so one dimension can be looked up for several roles.
    """
    rows = dim if current is None else dim.filter(current)
    side = rows.select(
        *[quoted(d).alias(f"_{fk}_{i}") for i, d in enumerate(on.values())], quoted(key).alias(fk)
    )
    condition = [quoted(f) == F.col(f"_{fk}_{i}") for i, f in enumerate(on)]
    return fact.join(side, condition, how).drop(*[f"_{fk}_{i}" for i in range(len(on))])


def join_active(src: DataFrame, dim: DataFrame, keys: list[str], active: Column, how: str = "left") -> DataFrame:
    """Join to the active rows only; the filter runs before the join."""
    return src.join(dim.filter(active), keys, how)


def pre_aggregate_join(
    fact: DataFrame, detail: DataFrame, keys: list[str], aggregates: dict[str, Column], how: str = "inner"
) -> DataFrame:
    """Aggregate the detail by the join keys first: no fan-out, and partial sums before the shuffle."""
    return fact.join(detail.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()]), keys, how)


def assemble(spark: SparkSession, **single: DataFrame) -> DataFrame:
    """One row from several one-row, one-column relations, as scalar subqueries (no cross join)."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in single.items()])


def explode_json(df: DataFrame, column: str, schema: str, outer: bool = False) -> DataFrame:
    """One row per element of a JSON array column, its fields as columns.

    With ``outer`` a row without elements is kept, its fields NULL.
    """
    rest = [quoted(c) for c in df.columns if c != column]
    parsed = df.select(*rest, F.from_json(quoted(column), schema).alias("_items"))
    if outer:
        return parsed.select(*rest, F.inline_outer("_items"))
    return exploded(parsed, F.col("_items"), "_item").select(*rest, "_item.*")


def lookup_id(df: DataFrame, parents: DataFrame, on: dict[str, str], id_: str, name: str) -> DataFrame:
    """Parent id by attributes; NULL when there is none. Several parents give the smallest id."""
    unique = parents.groupBy(*on.values()).agg(F.min(id_).alias(id_))
    return lookup(df, unique, on, id_, name)
