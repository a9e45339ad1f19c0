"""Interaction of filters: what each filter removes, in every order in which they can be applied.

A text is judged once. Its failures are the bits of a mask, and all later work is on the counts of equal
masks (at most ``2^filters`` cells for each part). A recursive common table expression extends filter
prefixes by the letters that they do not hold yet and carries the bits applied so far, for every mask; each level of the
recursion says for each mask what its step does to such a document. These steps meet the cells of each part
in one join on the mask.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, words_of
from tidemark.session import cut

LETTERS = "ABCDE"
COPY = 16  # the bit of filter E
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits 1, 2, 4, 8 for filters A to D: few words, few different words, many capitals, a symbol."""
    words = F.col("__words")
    n = F.size(words)
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failures = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 3 * F.char_length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failures)), F.lit(0))


def mask_cells(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part by the set of filters that they fail.

    NULL and empty texts have no words and fail A only (and E). A NULL part is the empty string. E fails
    where a smaller id has the identical text; repeated rows of one id do not fail by each other, and rows with a NULL
    id neither fail E nor make others fail it. A document is good (toxic) if any of its rows in ``labels`` says 1.
    Texts are compared by their 256-bit digest. Copies are counted in every task before they meet.
    """
    body = text_of(text)
    read = docs.select(
        F.col(f"`{id_column}`").alias("__id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("__part"),
        body.alias("__body"),
        words_of(body).alias("__words"),
    )
    judged = read.select("__id", "__part", text_mask(F.col("__body")).alias("__mask"), F.unhex(F.sha2("__body", 256)).alias("__digest"))
    known = labels.groupBy(F.col(f"`{id_column}`").alias("__id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("__good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("__toxic"),
    )
    marked = judged.join(known, "__id", "left").na.fill(False, ["__good", "__toxic"])
    kind = ["__digest", "__mask", "__part", "__good", "__toxic"]
    by_id = marked.groupBy("__id", *kind).agg(F.count(F.lit(1)).alias("__n"))
    known_id = F.col("__id").isNotNull()
    by_text = by_id.groupBy(*kind).agg(
        F.sum("__n").alias("__n"),
        F.coalesce(F.sum(F.when(known_id, F.col("__n"))), F.lit(0)).alias("__with_id"),
        F.min("__id").alias("__first"),
        F.min_by("__n", "__id").alias("__at_first"),
    )
    # One text has one row for each part and label here, whatever its copies.
    smallest = by_text.groupBy("__digest").agg(F.min("__first").alias("__smallest"))
    met = by_text.join(smallest, "__digest")
    spared = F.when(F.col("__first") == F.col("__smallest"), F.col("__at_first")).otherwise(0)
    copies = F.col("__with_id") - F.coalesce(spared, F.lit(0))
    split = met.select(
        "__part",
        "__good",
        "__toxic",
        F.explode(
            F.array(
                F.struct(F.col("__mask").alias("mask"), (F.col("__n") - copies).alias("n")),
                F.struct((F.col("__mask") + COPY).alias("mask"), copies.alias("n")),
            )
        ).alias("__cell"),
    )
    count = F.col("__cell.n")
    return (
        split.filter(count > 0)
        .groupBy(F.col("__part").alias("part"), F.col("__cell.mask").alias("mask"))
        .agg(
            F.sum(count).alias("n"),
            F.sum(F.when(F.col("__good"), count).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("__toxic"), count).otherwise(0)).alias("toxic"),
        )
    )


def filter_steps(spark: SparkSession, letters: str = LETTERS) -> DataFrame:
    """``(prefix, step, letter, mask, kept, removed, redundant, unique_fails)`` of every filter prefix and mask.

    The recursion holds ``2^filters`` rows for each prefix, whatever the data.
    """
    bits = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(letters))
    return spark.sql(
        f"""
        WITH RECURSIVE masks AS (SELECT explode(sequence(0, {(1 << len(letters)) - 1})) AS mask),
        walk(prefix, applied, step, letter, mask, kept, removed, redundant, unique_fails) MAX RECURSION LEVEL {len(letters) + 1} AS (
            SELECT CAST('' AS STRING), 0, 0, CAST('' AS STRING), mask, true, false, false, false FROM masks
            UNION ALL
            SELECT concat(prefix, f.letter), applied | f.bit, step + 1, f.letter, mask,
                   mask & (applied | f.bit) = 0,
                   mask & f.bit <> 0 AND mask & applied = 0,
                   mask & f.bit <> 0 AND mask & applied <> 0,
                   mask = f.bit
            FROM walk LATERAL VIEW explode(filter(array({bits}), x -> applied & x.bit = 0)) AS f
            WHERE step < {len(letters)}
        )
        SELECT prefix, step, letter, mask, kept, removed, redundant, unique_fails FROM walk WHERE step > 0
        """
    )


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``(part, filter_order, step)`` with the metrics of that step, and the filter's removals summed over all orders.

    An empty table has no parts and gives no rows.
    """
    steps = cut(filter_steps(cells.sparkSession, letters))  # the levels run once; three branches read them
    n = F.col("n")
    lost = F.col("removed")
    sums = {
        **{m: F.sum(F.when(F.col(m), n).otherwise(0)) for m in METRICS[:4]},
        "good_lost": F.sum(F.when(lost, F.col("good")).otherwise(0)),
        "toxic_lost": F.sum(F.when(lost, F.col("toxic")).otherwise(0)),
    }
    by_prefix = cells.join(steps, "mask").groupBy("part", "prefix", "step", "letter").agg(*[v.alias(m) for m, v in sums.items()])
    rest = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - k)) for k in range(1, len(letters) + 1)]), F.col("step"))
    total = by_prefix.groupBy("part", "letter").agg(F.sum(F.col("removed") * rest).alias("shapley"))
    # Every order has one prefix for each step: the prefix is extended by the orders of the letters that it lacks.
    orders = steps.filter(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    places = orders.select("filter_order", F.posexplode(F.split("filter_order", "")).alias("at", "letter")).select(
        "filter_order", F.expr("substring(filter_order, 1, at + 1)").alias("prefix")
    )
    return (
        by_prefix.join(places, "prefix")
        .join(total, ["part", "letter"])
        .select("part", "filter_order", "step", *[F.col(m).cast("bigint").alias(m) for m in METRICS], F.col("shapley").cast("bigint").alias("shapley"))
    )
