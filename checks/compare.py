"""Run queries next to their SQL in DuckDB: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import datetime as dt
import hashlib
import sys
import time
from pathlib import Path

import duckdb

from bizpulse.session import build_session
from checks.catalog import queries
from checks.oracle import oracle_sql


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def digest(columns: list[str], rows) -> tuple[list[str], int, str]:
    """Sorted column names, row count and an order-free hash of all values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


SAME_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
             "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, connection, name: str, sf_dir: str) -> str:
    """Empty when both sides agree in columns, types, row count and values; else what differs."""
    df = queries()[name](spark, sf_dir)
    got = digest(df.columns, df.collect())
    result = connection.execute(oracle_sql()[name])
    names, types = [d[0] for d in result.description], [str(d[1]) for d in result.description]
    rows = result.fetchall()
    wanted = digest(names, rows)
    if got[0] != wanted[0]:
        return f"columns {got[0]} != {wanted[0]}"
    duck_types = dict(zip(names, types))
    spark_types = {c: SAME_TYPE.get(t, t) for c, t in df.dtypes}
    differing = {c: (spark_types[c], duck_types[c]) for c in names if spark_types[c] != duck_types[c]}
    if differing:
        return f"types {differing}"
    if got[1:] != wanted[1:]:
        mine = {tuple(map(_plain, (r[c] for c in got[0]))) for r in df.collect()}
        theirs = {tuple(_plain(r[names.index(c)]) for c in got[0]) for r in rows}
        return f"rows {got[1]} vs {wanted[1]}; e.g. only here {sorted(mine - theirs)[:2]}, only there {sorted(theirs - mine)[:2]}"
    if not got[1]:
        return "no rows on either side"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    conf = {"spark__ui__enabled": "false", "spark__sql__shuffle__partitions": "8",
            "spark__ui__showConsoleProgress": "false"}
    spark = build_session("compare", master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    connection, bad = duck(sf_dir), 0
    for name in chosen:
        began = time.monotonic()
        try:
            problem = compare(spark, connection, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {time.monotonic() - began:6.2f}s {name} {problem}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
