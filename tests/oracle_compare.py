"""Run registered queries next to their SQL in DuckDB and compare all rows.

``python tests/oracle_compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _canonical(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[int, int, str]:
    """(rows in Spark, rows in DuckDB, "" or what differs)."""
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    problem = ""
    if sorted(df.columns) != sorted(columns):
        problem = f"columns {sorted(df.columns)} / {sorted(columns)}"
    elif mine != theirs:
        extra, missing = set(mine) - set(theirs), set(theirs) - set(mine)
        problem = f"only spark {sorted(extra)[:2]}; only sql {sorted(missing)[:2]}"
    return len(mine), len(theirs), problem


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from leaseflow.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    twins, bad = oracle_sql(), 0
    for name, query in queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            n, m, problem = compare(query(spark, sf_dir), con, twins[name])
        except Exception as error:  # report and go on to the next query
            n, m, problem = -1, -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} {n}/{m} {time.time() - start:.1f}s {problem}",
              flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
