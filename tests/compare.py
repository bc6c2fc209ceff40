"""Run named queries in Spark and DuckDB and compare rows, column names and values.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns: {sorted(spark_df.columns)} / {sorted(columns)}"
    expected = _rows(columns, result.fetchall())
    found = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if found == expected:
        return None
    only_spark, only_duck = found - expected, expected - found
    return (
        f"rows {sum(found.values())} / {sum(expected.values())}; "
        f"spark only {list(only_spark)[:2]}; duckdb only {list(only_duck)[:2]}"
    )


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidegauge.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracle:
                verdict = difference(run(spark, sf), con, oracle[name]) or "ok"
            else:
                verdict = f"{run(spark, sf).count()} rows, no oracle"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.2f}s  {verdict}", flush=True)
