"""Runs registered queries and their SQL on the same tables and compares the rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def tidy(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    return value


def row_set(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(tidy(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def difference(spark, folder: str, run, sql: str) -> str | None:
    df = run(spark, folder)
    mine = row_set(df.columns, [tuple(r) for r in df.collect()])
    columns, rows = oracle_rows(folder, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = row_set(columns, rows)
    if not mine:
        return "no rows"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry

    from vecloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session("8")
    checks, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in checks:
                found = difference(session, folder, run, checks[name])
            else:
                found = None if run(session, folder).count() else "no rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        failed += found is not None
        print(f"{name:22s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print("failed:", failed)
