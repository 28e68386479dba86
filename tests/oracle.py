"""Runs registered queries and their SQL side by side: `python tests/oracle.py [sf_dir] [key…]`."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value.isoformat() if isinstance(value, datetime.date) else value


def normalized(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def difference(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None if both results are equal as multisets, else what differs."""
    df = run(spark, sf_dir)
    ours = normalized(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = normalized([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    unequal = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(unequal)} of {len(ours[1])} rows differ, first {unequal[0]}" if unequal else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    from litro.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    database = connect(sf_dir)
    sqls = oracle_sql()
    failed = 0
    for key, run in queries().items():
        if sys.argv[2:] and key not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = difference(session, database, run, sqls[key], sf_dir) if key in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.1f}s {key}: {problem or 'equal'}", flush=True)
    print(f"{failed} problems")
