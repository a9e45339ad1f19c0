"""Run a registered query and its SQL side by side and describe the first difference."""

from __future__ import annotations

import contextlib
import io
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(row[i] for i in order) for row in cur.fetchall()]


def explained(df) -> str:
    """The formatted physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def types_of(rows):
    return [sorted({type(v).__name__ for v in column if v is not None}) for column in zip(*rows)]


def difference(spark_side, sql_side) -> str | None:
    (names_a, rows_a), (names_b, rows_b) = spark_side, sql_side
    if names_a != names_b:
        return f"columns {names_a} vs {names_b}"
    if len(rows_a) != len(rows_b):
        extra = list((Counter(map(repr, rows_a)) - Counter(map(repr, rows_b))).keys())[:2]
        lack = list((Counter(map(repr, rows_b)) - Counter(map(repr, rows_a))).keys())[:2]
        return f"rows {len(rows_a)} vs {len(rows_b)}; only spark {extra} only sql {lack}"[:1500]
    if types_of(rows_a) != types_of(rows_b):
        return f"types {types_of(rows_a)} vs {types_of(rows_b)} for {names_a}"
    a, b = Counter(map(repr, rows_a)), Counter(map(repr, rows_b))
    if a != b:
        return f"values: only spark {list((a - b).keys())[:2]} only sql {list((b - a).keys())[:2]}"[:1500]
    return None


def main(prefixes: list[str], folder: str) -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    spark = local_session(8)
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if prefixes and not any(name == p or name.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            result = spark_rows(fn(spark, folder))
            took = time.time() - began
            if name not in oracle:
                print(f"ROWS {name} {len(result[1])} rows {took:.2f}s", flush=True)
                continue
            problem = difference(result, sql_rows(con, oracle[name]))
        except Exception as error:  # report and go on
            problem, took, result = f"{type(error).__name__}: {str(error)[:1200]}", time.time() - began, ([], [])
        print(f"{'FAIL' if problem else 'ok  '} {name} {len(result[1])} rows {took:.2f}s {problem or ''}", flush=True)
        bad += bool(problem)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1]
    sys.exit(1 if main(sys.argv[2:], folder) else 0)
