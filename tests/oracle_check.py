"""Compare registered queries with their SQL: ``python -m tests.oracle_check [sf_dir] [names...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if glob.glob(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return str(value)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def spark_rows(df):
    order = sorted(df.columns)
    return order, _sorted([tuple(_plain(v) for v in r) for r in df.select(*order).collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(names)
    at = [names.index(n) for n in order]
    return order, _sorted([tuple(_plain(r[i]) for i in at) for r in result.fetchall()])


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else what differs."""
    columns, rows = spark_rows(query(spark, sf_dir))
    if sql is None:
        return None if rows else "no rows"
    names, expected = duck_rows(con, sql)
    if columns != names:
        return f"columns {columns} != {names}"
    if len(rows) != len(expected):
        first = next((a for a in rows if a not in expected), None) if len(rows) < 5000 else None
        return f"{len(rows)} rows, expected {len(expected)}; first extra {first}"
    for a, b in zip(rows, expected):
        if a != b:
            return f"row {dict(zip(columns, a))} != {dict(zip(columns, b))}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), duck(sf_dir)
    oracle, failed = E.oracle_sql(), 0
    for name, query in E.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, oracle.get(name), sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
