"""Runs registered queries against their SQL counterparts in an in-process DuckDB."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value: object) -> object:
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime | date):
        return str(value)
    return value


def rows(columns: list[str], records: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; numbers by type and exact value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in records), key=repr)


def spark_rows(df) -> list[tuple]:
    return rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    result = con.execute(sql)
    return rows([c[0] for c in result.description], result.fetchall())


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    con = connect(sf_dir)
    problems = {}
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            got = spark_rows(df)
            took = time.time() - start
            if name not in oracles:
                print(f"{name:28s} rows-only {len(got):6d} {took:6.1f}s", flush=True)
                continue
            result = con.execute(oracles[name])
            columns = [c[0] for c in result.description]
            want = rows(columns, result.fetchall())
            if sorted(columns) != sorted(df.columns):
                problems[name] = f"columns {sorted(df.columns)} vs {sorted(columns)}"
            elif got != want:
                extra = [r for r in got if r not in set(want)][:3]
                lacking = [r for r in want if r not in set(got)][:3]
                problems[name] = f"{len(got)} vs {len(want)} rows; only spark {extra}; only sql {lacking}"
            state = "FAIL" if name in problems else "ok"
            print(f"{name:28s} {state:9s} {len(got):6d} {took:6.1f}s  {problems.get(name, '')}", flush=True)
        except Exception as e:  # noqa: BLE001
            problems[name] = f"{type(e).__name__}: {str(e)[:600]}"
            print(f"{name:28s} ERROR {problems[name]}", flush=True)
    return problems


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from clickfacts.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    found = compare(session, sys.argv[1], sys.argv[2:] or None)
    print(f"{len(found)} problems")
