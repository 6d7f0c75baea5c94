"""Run a query in Spark and its SQL in DuckDB and compare the rows as bags.

As a script: ``python tests/compare.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (datetime, date)):
        return str(value)
    return str(value)


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, run, sql, sf_dir):
    """(problem or None, rows, seconds in Spark, seconds in DuckDB, types)."""
    t0 = time.time()
    frame = run(spark, sf_dir)
    ours = frame.collect()
    t1 = time.time()
    if sql is None:
        return None, len(ours), t1 - t0, 0.0, ""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    theirs = result.fetchall()
    t2 = time.time()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", len(ours), t1 - t0, t2 - t1, ""
    a, b = bag(ours, frame.columns), bag(theirs, columns)
    spark_types = dict(frame.dtypes)
    pairs = " ".join(f"{c}:{spark_types[c]}/{k}" for c, k in zip(columns, types) if not _same_type(spark_types[c], k))
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return (
            f"{sum(a.values())} vs {sum(b.values())} rows, {sorted(columns)}\n   spark {only_a}\n   sql   {only_b}",
            len(ours), t1 - t0, t2 - t1, pairs,
        )
    return None, len(ours), t1 - t0, t2 - t1, pairs


def _same_type(spark: str, duck: str) -> bool:
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    return same.get(spark) == duck


def main():
    from __spark_entry__ import oracle_sql, queries
    from flowloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        try:
            problem, rows, s, d, types = compare(spark, con, name, run, oracles.get(name), sf_dir)
        except Exception as e:  # show the rest as well
            problem, rows, s, d, types = f"{type(e).__name__}: {str(e)[:600]}", 0, 0, 0, ""
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:4} {name:26} rows={rows:7} spark={s:6.2f}s duck={d:6.2f}s {types}")
        if problem:
            print("    ", problem)
    print("failed:", bad)


if __name__ == "__main__":
    main()
