"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import (  # noqa: F401  (importing registers)
    analysis,
    changes,
    checks,
    files,
    groups,
    logs,
    rows,
    scalars,
    streams,
    warehouse,
)
from tidemark.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
