"""Runs registered queries next to their SQL in DuckDB and compares the rows.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if hasattr(value, "to_eng_string"):
        return f"decimal {value}"
    return f"{type(value).__name__} {value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str, build, sql: str | None) -> str | None:
    """None where rows, values and names agree, else what differs."""
    df = build(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = _rows(columns, result.fetchall())
    if not want:
        return "the SQL gives no rows"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"row {mine} != {theirs} ({sorted(columns)})"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from emberlog import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, build in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, build, entry.oracle_sql().get(name))
        except Exception as error:  # noqa: BLE001 - report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
