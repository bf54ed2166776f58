"""Runs queries and their SQL on the same tables and compares the results, value by value.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemill.sources.tables import TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normalised(names, rows) -> list[tuple]:
    """Rows as text with columns by name, sorted; text keeps decimals and their scale apart."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both results agree in column names, rough types and values."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: str(d[1]).lower() for d in cursor.description}
    alias = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp", "double": "double"}
    for name, dtype in df.dtypes:
        if alias.get(dtype, dtype) != types[name].replace(" ", ""):
            return f"type of {name}: {dtype} != {types[name]}"
    got = normalised(df.columns, df.collect())
    want = normalised(names, expected)
    if got != want:
        a, b = set(got), set(want)
        return f"{len(got)} rows != {len(want)} rows; only here {list(a - b)[:3]}; only there {list(b - a)[:3]}"
    return None


def main() -> int:
    import __spark_entry__ as driver
    from tidemill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    oracles = driver.oracle_sql()
    for name, query in driver.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = differences(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("rows only")
        print(f"{name:30s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} queries differ")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
