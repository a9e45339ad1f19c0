"""Dependency closure and key comparison."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import list_items
from tidemark.functions.values import quoted
from tidemark.operators.sets import array_difference
from tidemark.operators.aggregates import ordered_distinct
from tidemark.session import cut

# Labels of the comparison and of depth.
EXACT, PARTIAL, NONE_COMMON, NO_KEYS = "Exact match", "Partial match", "No common keys", "No keys in either"
SAME_ORDER, OTHER_ORDER, NO_ORDER = "Exactly Matched and in Same Order", "Matched but in different order", "N/A"
DIRECT = "DIRECT"
NO_PARTITION_KEY = "No partition key specified"
# Fixed values end.

CUT_EVERY = 16
CLASS = ["c1", "c2", "c3"]


def _classes(roots: DataFrame, views: DataFrame) -> DataFrame:
    """``(root, c1, c2, c3)``: roots with the same set of views below them share 192 bits of fingerprint."""
    below = roots.join(views, F.col("root") == F.col("object")).select("root", "next").distinct()
    marks = [F.bit_xor(F.xxhash64(F.lit(n), "next")).alias(f"c{n}") for n in (1, 2, 3)]
    return below.groupBy("root").agg(*marks)


def _walked(edges: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The links, the different roots, the class of each root (``root, c1, c2, c3``), and what each class reaches
    below its roots (``c1, c2, c3, object, level``).

    Roots that have the same views below them reach the same objects, so one walk serves all of them; they
    differ in themselves only, at level 0. All walks advance together. A level joins only what the level before it found, and
    leaves out what was visited; it writes one table of new pairs.
    """
    links = cut(edges.select("parent", "object", "object_type").distinct())
    views = links.filter("object_type = 'VIEW'").select(F.col("parent").alias("object"), F.col("object").alias("next"))
    starts = roots.select("root").distinct()
    classes = cut(_classes(starts, views))
    one = classes.groupBy(*CLASS).agg(F.min("root").alias("root"))
    walk = one.join(views, F.col("root") == F.col("object")).select(*CLASS, F.col("next").alias("object"), F.lit(1).alias("level"))
    frontier = cut(walk.distinct())
    visited = frontier
    for level in count(2):
        step = frontier.join(views, "object").select(*CLASS, F.col("next").alias("object")).distinct()
        frontier = cut(step.join(visited.select(*CLASS, "object"), [*CLASS, "object"], "left_anti").withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
        if level % CUT_EVERY == 0:
            visited = cut(visited)
    return links, starts, classes, visited


def lineage(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Everything reachable from each root: (root, parent, object, object_type, level, label).

    ``edges`` has (parent, object, object_type), ``roots`` has (root). An object is expanded once per root, so
    cycles end; its level is its smallest depth. Only views are expanded.
    """
    links, starts, classes, visited = _walked(edges, roots)
    label = F.when(F.col("level") == 0, DIRECT).otherwise(F.concat(F.lit("NESTED-"), F.col("level").cast("string")))
    found = visited.withColumnRenamed("object", "parent").join(links, "parent")
    nested = found.join(classes, CLASS).filter("parent <> root").select("root", "parent", "object", "object_type", "level")
    direct = starts.join(links, F.col("root") == F.col("parent")).select("root", "parent", "object", "object_type", F.lit(0).alias("level"))
    return direct.unionByName(nested).withColumn("label", label)


def lineage_per_parent(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """What ``objects_per_parent`` gives for ``lineage(edges, roots)``: (root, parent, n_objects).

    How many objects a parent reads does not depend on the root, so it is counted once for each parent, and the
    objects themselves never join the roots.
    """
    links, starts, classes, visited = _walked(edges, roots)
    counts = links.select("parent", "object").distinct().groupBy("parent").agg(F.count(F.lit(1)).alias("n_objects"))
    reached = visited.select(*CLASS, F.col("object").alias("parent")).join(counts, "parent")
    nested = classes.join(reached, CLASS).filter("parent <> root").select("root", "parent", "n_objects")
    direct = starts.join(counts, F.col("root") == F.col("parent")).select("root", "parent", "n_objects")
    return direct.unionByName(nested)


def lineage_summary(found: DataFrame, excluded: list[str] | None = None, schema_of: Column | None = None) -> DataFrame:
    """Distinct objects per root and type, without excluded schemas."""
    objects = found.select("root", "object", "object_type").distinct()
    if excluded and schema_of is not None:
        objects = objects.filter(~F.upper(schema_of).isin([e.upper() for e in excluded]))
    return objects.groupBy("root", "object_type").agg(F.count(F.lit(1)).alias("n_objects"))


def objects_per_parent(found: DataFrame) -> DataFrame:
    """How many different objects each parent reads, per root."""
    links = found.select("root", "parent", "object").distinct()
    return links.groupBy("root", "parent").agg(F.count(F.lit(1)).alias("n_objects"))


def consolidate_keys(objects: DataFrame, columns: DataFrame) -> DataFrame:
    """Partition columns of each object as an ordered list; a placeholder where there are none.

    ``objects`` has (object), ``columns`` has (object, column_name, position).
    """
    lists = ordered_distinct(columns, ["object"], "column_name", "position", name="partition_keys")
    return objects.select("object").distinct().join(lists, "object", "left").select(
        "object", F.coalesce("partition_keys", F.lit(NO_PARTITION_KEY)).alias("partition_keys")
    )


def parse_keys(c: Column | str) -> Column:
    """``LINEAR(a, b)``, ``['a', 'b']``, ``(a, b)`` or ``a, b`` as an upper-case array; placeholders are empty."""
    c = F.col(c) if isinstance(c, str) else c
    inner = F.regexp_replace(F.trim(c), r"(?is)^(linear)?\s*\((.*)\)$", "$2")
    named = F.upper(F.trim(F.coalesce(inner, F.lit(""))))
    none = named.isin("NONE", "NO CLUSTER KEY", NO_PARTITION_KEY.upper())
    return F.when(none, F.array().cast("array<string>")).otherwise(list_items(named))


def compare_keys(df: DataFrame, left: str, right: str) -> DataFrame:
    """Set and order comparison of two key texts, with the members on each side."""
    parsed = df.withColumn("_a", parse_keys(left)).withColumn("_b", parse_keys(right))
    a, b = F.col("_a"), F.col("_b")
    parts = array_difference(a, b)
    no_diff = (F.size(parts["only_left"]) == 0) & (F.size(parts["only_right"]) == 0)
    status = (
        F.when((F.size(a) == 0) & (F.size(b) == 0), NO_KEYS)
        .when(no_diff, EXACT)
        .when(F.size(parts["in_both"]) > 0, PARTIAL)
        .otherwise(NONE_COMMON)
    )
    both = (F.size(a) > 0) & (F.size(b) > 0)
    order = F.when(both & (a == b), SAME_ORDER).when(both & no_diff, OTHER_ORDER).otherwise(NO_ORDER)

    def text(x: Column) -> Column:
        return F.when(F.size(x) == 0, "None").otherwise(F.array_join(x, ", "))

    return parsed.select(
        *[quoted(c) for c in df.columns],
        status.alias("status"),
        order.alias("order_status"),
        *[text(x).alias(n) for n, x in parts.items()],
    )


def map_names(df: DataFrame, column: str, mapping: DataFrame, name: str) -> DataFrame:
    """Replace a name by its mapping (columns ``name``, ``mapped``), case-insensitively; else keep it."""
    known = mapping.groupBy(F.upper("name").alias("_name")).agg(F.min("mapped").alias("_mapped"))
    return (
        df.join(known, F.upper(quoted(column)) == F.col("_name"), "left")
        .withColumn(name, F.coalesce("_mapped", quoted(column)))
        .drop("_name", "_mapped")
    )
