"""Compare registered queries with their SQL on one sample folder.

Usage: python tests/check_oracles.py [sf_dir] [name ...]
With ``--oracles`` instead of names, queries without SQL are left out.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def compare(spark_rows, spark_columns, sql_rows, sql_columns) -> str | None:
    """None when equal, otherwise what differs."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns differ: {sorted(set(spark_columns) ^ set(sql_columns))}"
    names = sorted(spark_columns)
    a_index, b_index = [spark_columns.index(n) for n in names], [sql_columns.index(n) for n in names]
    a = sorted((tuple(canonical(r[i]) for i in a_index) for r in spark_rows), key=repr)
    b = sorted((tuple(canonical(r[i]) for i in b_index) for r in sql_rows), key=repr)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    types = [(n, {type(x[i]).__name__ for x in a} ^ {type(x[i]).__name__ for x in b})
             for i, n in enumerate(names)]
    types = [t for t in types if t[1]]
    if types:
        return f"types differ: {types}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; {names}: {bad[0][0]} against {bad[0][1]}"
    return None


def main() -> None:
    from tripwell import catalog
    from tripwell.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    if wanted == ["--oracles"]:
        wanted = list(catalog.oracle_sql())
    spark = build_session("check", "local[8]", 8)
    con = connect(sf_dir)
    queries, oracles = catalog.queries(), catalog.oracle_sql()
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001  (report and go on)
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:1500]}", flush=True)
            continue
        spark_time = time.time() - start
        if name not in oracles:
            print(f"rows {name}: {len(rows)} rows {spark_time:.1f}s {rows[:3] if wanted else ''}", flush=True)
            continue
        start = time.time()
        try:
            cursor = con.execute(oracles[name])
            problem = compare(rows, df.columns, cursor.fetchall(), [d[0] for d in cursor.description])
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__} {str(e)[:1500]}"
        sql_time = time.time() - start
        print(f"{'ok  ' if problem is None else 'DIFF'} {name}: {len(rows)} rows {spark_time:.1f}s "
              f"sql {sql_time:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
