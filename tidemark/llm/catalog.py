"""The registered queries of the text operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import queries as registered


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registered.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registered.SQL)
