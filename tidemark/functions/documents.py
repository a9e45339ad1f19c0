"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_value(c: Column | str, path: str, type_: str = "string") -> Column:
    """Value at a JSON path, cast tolerantly; broken JSON, a missing path or a bad cast is NULL."""
    return F.get_json_object(_col(c), path).try_cast(type_)


def json_variant(c: Column | str, path: str, type_: str) -> Column:
    """The same over a variant: parse tolerantly once, then read a nested path."""
    return F.try_variant_get(F.try_parse_json(_col(c)), path, type_)


def json_struct(c: Column | str, schema: str) -> Column:
    """Typed object; fields that do not fit are NULL."""
    return F.from_json(_col(c), schema)
