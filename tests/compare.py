"""Run queries on Spark and their SQL on DuckDB and compare the values.

    python -m tests.compare /root/testdata/sf0.01 [names...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql):
    """(problem or None, number of rows)."""
    left = as_rows(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    right = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}", len(left[1])
    if left[1] != right[1]:
        a, b = set(left[1]), set(right[1])
        return (
            f"rows {len(left[1])} vs {len(right[1])}; {left[0]}\n  spark only {sorted(a - b, key=repr)[:2]}"
            f"\n  duckdb only {sorted(b - a, key=repr)[:2]}",
            len(left[1]),
        )
    return None, len(left[1])


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries

    from revlattice.session import build_session

    spark = build_session(
        "compare", "local[8]", 8, {"spark.driver.memory": "8g", "spark.sql.warehouse.dir": "/tmp/wh"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    todo, sql = queries(), oracle_sql()
    for name in names or todo:
        start = time.time()
        try:
            problem, n = compare(todo[name](spark, sf_dir), con, sql[name])
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:700]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:38s} {n:8d} rows {time.time() - start:6.2f}s", flush=True)
        if problem:
            print("  " + problem[:1500], flush=True)
    print(f"{bad} bad; without SQL: {sorted(set(todo) - set(sql))}; without query: {sorted(set(sql) - set(todo))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
