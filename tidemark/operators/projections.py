"""Column selection, renaming and casting, also from control rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import moment
from tidemark.functions.text import list_items
from tidemark.functions.values import quoted

# Type names a control table may use.
TYPE_NAMES: dict[str, str] = {
    "string": "string",
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
}
# Fixed values end.


def rename_by_map(df: DataFrame, meta: DataFrame, file: str) -> DataFrame:
    """Rename by control rows (file_name, file_column, rename_column); a blank new name keeps the old.

    The driver reads the different rows of the one file: one for each of its columns.
    """
    rows = meta.filter(F.trim("file_name") == file).select("file_column", "rename_column").distinct().collect()
    names = {r["file_column"].strip(): r["rename_column"].strip() for r in rows if (r["rename_column"] or "").strip()}
    return df.withColumnsRenamed({c: names[c.strip()] for c in df.columns if c.strip() in names})


def normalise_name(name: str) -> str:
    return name.replace(" ", "").lower()


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names without blanks."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return df.select(
        *[
            F.trim(quoted(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def apply_schema_map(df: DataFrame, names: list[str], types: list[str]) -> DataFrame:
    """Keep the listed columns, trimmed and cast; text that does not fit its type becomes NULL."""
    if len(names) != len(types):
        raise ValueError(f"{len(names)} column names but {len(types)} types")
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not in the data: {missing}")
    unknown = [t for t in types if t.strip().lower() not in TYPE_NAMES]
    if unknown:
        raise ValueError(f"unknown types: {unknown}")
    out = []
    for n, t in zip(names, types):
        c = quoted(n)
        if isinstance(df.schema[n].dataType, T.StringType):
            c = F.trim(c)
        out.append(c.try_cast(TYPE_NAMES[t.strip().lower()]).alias(n))
    return df.select(*out)


def explode_column_map(meta: DataFrame) -> DataFrame:
    """Pair the bracketed source, target and type lists of each file by position."""
    zipped = F.arrays_zip(
        list_items("source_columns").alias("source_column"),
        list_items("target_columns").alias("target_column"),
        list_items("column_types").alias("column_type"),
    )
    return meta.select("file_name", F.posexplode(zipped).alias("position", "pair")).select(
        "file_name", (F.col("position") + 1).alias("position"), "pair.*"
    )


def replace_token(df: DataFrame, token: str, value: str) -> DataFrame:
    """Replace a null token in every string column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.replace(token, value, subset=text)


def any_column_equals(columns: list[str], value: object) -> Column:
    """True when the value is in at least one of the columns."""
    return F.lit(value).isin(*[quoted(c) for c in columns])


def drop_sentinel(df: DataFrame, columns: list[str] | None = None, sentinel: str = "unknown") -> DataFrame:
    """Drop rows where a string column holds the sentinel or NULL; other column types are not compared."""
    text = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    ]
    return df.filter(reduce(lambda a, b: a & b, [quoted(c) != sentinel for c in text], F.lit(True)))


def filter_last_days(df: DataFrame, column: str, days: int, as_of: dt.date) -> DataFrame:
    """Rows of the last days; the bound is a literal, so it reaches the scan."""
    bound = moment(as_of - dt.timedelta(days=days)).cast(df.schema[column].dataType)
    return df.filter(quoted(column) >= bound)


def classify_in_list(df: DataFrame, column: str, codes: DataFrame, yes: str, no: str, name: str) -> DataFrame:
    """``yes`` when the value is in the code table, else ``no``.

    The distinct code list joins as a relation: Spark broadcasts it below its size threshold and
    shuffles it (with skew splitting) above.
    """
    listed = codes.select(F.col(codes.columns[0]).alias("_code")).distinct().withColumn("_hit", F.lit(True))
    return (
        df.join(listed, quoted(column) == F.col("_code"), "left")
        .withColumn(name, F.when(F.col("_hit"), yes).otherwise(no))
        .drop("_code", "_hit")
    )
