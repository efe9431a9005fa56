"""Run queries in Spark and their SQL in DuckDB on the same parquet tables and compare the values."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None where both sides agree, else a description."""
    got_columns, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = table(names, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: got {a} expected {b}"
    return None


def main(folder: str, only: list[str]) -> int:
    sys.path.insert(0, ".")
    from eventloom.catalog import CHECKS, QUERIES
    from eventloom.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("GROUP_ROWS"):
        spark.conf.set("eventloom.groupRows", os.environ["GROUP_ROWS"])
    con, bad = duck(folder), 0
    for name, run in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in CHECKS:
                problem = difference(run(spark, folder), con, CHECKS[name])
            else:
                rows = run(spark, folder).collect()
                problem = None if rows else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        mark = "ok " if problem is None else "BAD"
        print(f"{mark} {name} {time.time() - start:.2f}s {'' if name in CHECKS else '(rows)'} {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
