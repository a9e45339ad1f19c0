"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from tests.compare import connect, difference, explained, spark_rows, sql_rows
from tidemark.plans.catalog import oracle_sql, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Operators that no plan may contain: pairs of all rows, and Python in the row path.
HAZARDS = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    plan = explained(df)
    assert not [h for h in HAZARDS if h in plan]
    result = spark_rows(df)
    assert name in oracle_sql(), "every query here has SQL"
    assert difference(result, sql_rows(con, oracle_sql()[name])) is None


def test_the_comparison_sees_differences():
    rows = (["a", "b"], [(1, "x"), (2, "y")])
    assert difference(rows, (["a", "b"], [(2, "y"), (1, "x")])) is None
    assert "values" in difference(rows, (["a", "b"], [(1, "x"), (2, "z")]))
    assert "rows" in difference(rows, (["a", "b"], [(1, "x")]))
    assert "columns" in difference(rows, (["a", "c"], rows[1]))
    assert "types" in difference(rows, (["a", "b"], [(1.0, "x"), (2.0, "y")]))
