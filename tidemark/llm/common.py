"""Expressions and helpers that several text operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKAGE = Path(__file__).resolve().parents[1]

# Fixed value: white space between words is blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def text_of(name: str) -> Column:
    """A text column; null counts as empty, other types are read as strings."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of one byte per character take the faster ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """The words of a text, in order; no word gives an empty array."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK_CLASS}+"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once and only where the result is needed."""
    return F.transform(F.array(value), body)[0]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, whatever their case; they make room for an operator's own."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def unsigned_hex(value: Column) -> Column:
    """16 hexadecimal digits of a long whose order as text is the order of the signed number."""
    return F.lpad(F.hex(value.bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for a context, as ``--py-files`` would.

    Workers need not find it on a path of their own then. Spark's file server hands the archive on.
    """
    context = spark.sparkContext
    if getattr(context, "_tidemark_sent", False) or not PACKAGE.is_dir():  # sent before, or itself read from an archive
        return
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._tidemark_sent = True


def map_batches(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` by workers that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
