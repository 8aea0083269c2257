"""Compare catalog queries with their SQL twins: ``python tests/check_oracle.py [folder] [name …]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, float):
        return f"{value:.6f}" if value else "0.000000"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    con.execute(sql)
    names = [d[0] for d in con.description]
    want = rows_of(names, con.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        a, b = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows, expected {len(want)}\n   spark {str(a)[:900]}\n   sql   {str(b)[:900]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from plumbline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, twins[name], folder) if name in twins else "no twin"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1200]}"
            if chosen:
                traceback.print_exc()
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
