"""Run a query in Spark and its SQL in DuckDB and compare the rows. Also usable from the shell:

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, f"{value:.6f}".replace("-0.000000", "0.000000"))
    return (1, f"{type(value).__name__}:{value}")


def rows_of(names, rows) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} against {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from tallywell.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = difference(df, duck(folder), sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {'ok' if found is None else found}", flush=True)
    print(f"{bad} not equal")
