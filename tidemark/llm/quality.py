"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one integer whose bit
``r`` is set where rule ``r`` failed. A policy is a named, versioned set of rules: a bit mask. Applying
another policy, or asking what one rule changes, reads the ledger's integers and never the texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANK_CLASS, WORD_CLASS, let, text_of, without, words_of

#: Rules in bit order. A condition over the measures that holds means the rule failed.
RULES: dict[str, Callable[[Column], Column]] = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 10 * m["n_dup_lines"] > 4 * m["n_lines"],
    "short_words": lambda m: m["word_chars"] < 3 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 10 * m["n_words"],
    "capitals": lambda m: 2 * m["n_capitals"] > m["word_chars"],
    "no_words": lambda m: m["n_words"] == 0,
}
BIT = {name: 1 << place for place, name in enumerate(RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Policy:
    """The rules that reject a document, under a name and a version."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum({BIT[r] for r in self.rules})


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(RULES))


def _repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words that the text holds at least twice.

    Windows are compared by 64-bit hashes, sorted together with their places: equal neighbours repeat.
    Sorted repeated places then cover three words each, less where the next one is nearer.
    """
    windows = F.arrays_zip(
        words.alias("a"), F.slice(words, 2, F.size(words)).alias("b"), F.slice(words, 3, F.size(words)).alias("c")
    )
    hashes = F.transform(F.slice(windows, 1, F.size(words) - 2), lambda w: F.xxhash64(w))

    def places(h: Column) -> Column:
        ordered = F.array_sort(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("p")))

        def repeated(s: Column) -> Column:
            later = F.slice(s, 2, F.size(s))
            pairs = F.filter(F.arrays_zip(s.alias("x"), later.alias("y")), lambda z: z["x"]["h"] == z["y"]["h"])
            both = F.flatten(F.transform(pairs, lambda z: F.array(z["x"]["p"], z["y"]["p"])))
            return F.array_sort(F.array_distinct(both))

        return let(ordered, repeated)

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.lit(3), b - a))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(places(h), covered))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(hashes, count))


def measures(body: Column) -> Column:
    """All measures of a text and its failed bits as one struct.

    It is a single expression in which words and lines are bound once, so a filter on the bits parses each
    text once, too.
    """
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD_CLASS))

    def counted(parsed: Column) -> Column:
        words, lines = parsed["words"], parsed["lines"]
        values = {
            "n_words": F.size(words),
            "word_chars": F.char_length(parsed["body"]) - F.regexp_count(parsed["body"], F.lit(BLANK_CLASS)),
            "n_symbols": F.regexp_count(parsed["body"], F.lit("[#*$%&|<>]")),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeated_words(words),
            "n_lines": F.size(lines),
            "n_capitals": F.regexp_count(parsed["body"], F.lit("[A-Z]")),
        }
        return F.struct(*[values[m].cast("bigint").alias(m) for m in MEASURES])

    def judged(m: Column) -> Column:
        bits = sum((F.when(failed(m), BIT[name]).otherwise(0) for name, failed in RULES.items()), F.lit(0))
        return F.struct(*[m[name].alias(name) for name in MEASURES], bits.cast("bigint").alias("failed_bits"))

    parsed = F.struct(body.alias("body"), words_of(body).alias("words"), lines.alias("lines"))
    return let(let(parsed, counted), judged)


def quality_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``.

    NULL and empty texts have no words and fail ``few_words`` and ``no_words``. A line counts as
    duplicate where it has a word and equals an earlier line. Columns of ``docs`` with the name of a
    measure or ``failed_bits`` are replaced. An empty table gives an empty ledger.
    """
    kept = [F.col(f"`{c}`") for c in without(docs, *MEASURES, "failed_bits").columns]
    return docs.select(*kept, measures(text_of(text)).alias("__measured")).select(*kept, "__measured.*")


def fails(policy: Policy, bits: Column | None = None) -> Column:
    """Whether a row of the ledger is rejected by a policy."""
    bits = F.col("failed_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(policy.mask)) != 0


def apply_policies(ledger: DataFrame, *policies: Policy) -> DataFrame:
    """The ledger with one verdict column per policy, ``kept_<name>_v<version>``."""
    return ledger.withColumns({f"kept_{p.name}_v{p.version}": ~fails(p) for p in policies})


def quality_filter(docs: DataFrame, policy: Policy = STRICT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with the columns of ``docs``, whatever they are called."""
    return docs.filter(~fails(policy, measures(text_of(text))["failed_bits"]))


def ablation(ledger: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: ``(rule, fails, rejects_alone, kept_without)``.

    The texts' patterns of failed bits are counted first (at most one row per pattern); all figures are
    bitwise conditions over the patterns.
    """
    mask = F.lit(policy.mask)
    patterns = ledger.groupBy(F.col("failed_bits").bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit")) for r in policy.rules]))
    each = patterns.withColumn("__rule", rule).select("bits", "n", "__rule.*")
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        total(F.col("bits") == F.col("bit")).alias("rejects_alone"),
        total(rest == 0).alias("kept_without"),
    )
