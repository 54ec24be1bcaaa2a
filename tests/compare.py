"""Run a registered query and its DuckDB statement on the same tables and compare every value.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time(0) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def order_key(row):
    return tuple((v is not None, type(v).__name__ if not isinstance(v, (int, float)) else "n", v) for v in row)


def sort_rows(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)) if isinstance(v, (str, bool)) else "n",
                                             v if v is not None else 0) for v in r))


def close(a, b) -> bool:
    if a is None or b is None or isinstance(a, (str, bool)) or isinstance(b, (str, bool)):
        return a == b
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return a == b or abs(a - b) <= 1e-9 * max(abs(a), abs(b))
    return a == b


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sort_rows([tuple(plain(r[n]) for n in names) for r in df.select(*names).collect()])


def rows_of_duck(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(r[i]) for i in order) for r in cursor.fetchall()]
    return [names[i] for i in order], sort_rows(rows)


def differences(left, right, limit: int = 5) -> list[str]:
    (names_l, rows_l), (names_r, rows_r) = left, right
    if names_l != names_r:
        return [f"columns {sorted(set(names_l) ^ set(names_r))}"]
    if len(rows_l) != len(rows_r):
        return [f"rows {len(rows_l)} != {len(rows_r)}"]
    found = []
    for a, b in zip(rows_l, rows_r):
        bad = {n: (x, y) for n, x, y in zip(names_l, a, b) if not close(x, y)}
        if bad:
            found.append(str(bad))
            if len(found) >= limit:
                break
    return found


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("attain-compare").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failures = 0
    for name, query in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            left = rows_of_spark(query(spark, folder))
            spent = time.time() - started
            found = differences(left, rows_of_duck(con, oracle[name])) if name in oracle else ["(no oracle)"]
            size = len(left[1])
        except Exception as exc:  # report and go on with the next query
            spent, size, found = time.time() - started, -1, [f"{type(exc).__name__}: {str(exc)[:600]}"]
        failures += bool(found) and found != ["(no oracle)"]
        print(f"{'OK ' if not found else 'BAD'} {name:45s} rows {size:7d} {spent:6.2f}s {' | '.join(found)}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
