"""Registry of runnable queries and of the SQL that checks them.

A query takes (spark, folder) and returns a DataFrame. Its check is SQL over the same parquet
tables; ``checked`` prefixes the derived tables that the SQL names.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import pin_timezone

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

_NUMBER = "CAST(regexp_extract(props,'[0-9]+',0) AS INT)"
_START = "TIMESTAMP '2024-01-24 00:00:00'"

# Derived tables, in dependency order.
TABLES = {
    "clicks": f"""SELECT event_id AS click_id, user_id AS ip,
        CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS app,
        {_NUMBER} % 3 AS device, {_NUMBER} % 7 AS os, {_NUMBER} AS channel, ts AS click_time,
        CASE WHEN value > 100 THEN 1 ELSE 0 END AS is_attributed FROM events""",
    "timed": """SELECT *, CAST(hour(click_time) AS BIGINT) AS hour, CAST(day(click_time) AS BIGINT) AS day,
        CAST(isodow(click_time) AS BIGINT) AS wday,
        CASE WHEN hour(click_time) IN (4,5,9,10,13,14) THEN 1 WHEN hour(click_time) IN (6,11,15) THEN 3 ELSE 2 END AS in_test_hh
        FROM clicks""",
    "click_train": f"SELECT * FROM clicks WHERE click_time < {_START}",
    "test_supplement": f"""SELECT click_id, ip, app, device, os, channel, click_time FROM clicks WHERE click_time >= {_START}
        UNION ALL SELECT click_id + 1000000000, ip, app, device, os, channel, click_time FROM clicks
        WHERE click_time >= {_START} AND click_id % 5 = 0""",
    "click_test": "SELECT * FROM test_supplement WHERE click_id < 1000000000 AND click_id % 3 = 0",
    "visit_log": """SELECT o_orderkey AS visit, o_custkey % 60 AS pid, CAST(o_orderdate AS DATE) AS date,
        CAST(o_orderkey % 3 AS INT) + 1 AS rank, o_totalprice / CAST(499979 AS DOUBLE) AS similarity,
        (3 + o_custkey % 5) / CAST(10 AS DOUBLE) AS threshold, CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS type
        FROM orders""",
    "readings": """SELECT l_orderkey AS visit, l_orderkey % 60 AS pid, CASE WHEN l_orderkey % 20 = 0 THEN 1 ELSE 0 END AS type,
        CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS BIGINT) AS pos,
        min(CAST(l_shipdate AS DATE)) OVER (PARTITION BY l_orderkey) AS date,
        concat('b', CAST(l_partkey % 40 AS VARCHAR)) AS bssid, concat('s', CAST(l_partkey % 7 AS VARCHAR)) AS ssid,
        -(40 + CAST(l_quantity AS INT)) AS rssi,
        CASE WHEN l_partkey % 3 = 0 THEN 5180 ELSE 2412 + 5 * CAST(l_partkey % 13 AS INT) END AS frequency FROM lineitem""",
    "members": """SELECT c_custkey AS msno, CASE c_mktsegment WHEN 'BUILDING' THEN 'female' WHEN 'MACHINERY' THEN NULL ELSE 'male' END AS gender,
        CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS fst_exp_date, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS lst_exp_date,
        count(o_orderkey) AS n_trans, max(o_totalprice) AS max_paid, c_acctbal AS balance, CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS is_churn
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment, c_acctbal""",
    "races": """SELECT o_orderkey AS race_id, o_orderpriority AS weather, c_mktsegment AS track, o_orderstatus AS hrSex,
        CASE WHEN o_totalprice < 1000 THEN CAST(CAST(floor(o_totalprice) AS INT) AS VARCHAR)
             ELSE concat(CAST(CAST(floor(o_totalprice / 1000) AS INT) AS VARCHAR), ',', lpad(CAST(CAST(floor(o_totalprice) AS INT) % 1000 AS VARCHAR), 3, '0')) END AS trRcCntT,
        CAST(o_orderkey % 17 AS INT) AS chulNo, c_acctbal AS hrWeight, o_totalprice AS rcDist,
        CASE WHEN (o_orderkey * 7919) % 100 < 8 + CASE WHEN o_orderpriority < '3' THEN 30 ELSE 0 END
        + CASE WHEN o_totalprice > 150000 THEN 25 ELSE 0 END + CASE WHEN c_mktsegment = 'BUILDING' THEN 20 ELSE 0 END
        THEN 'pass' ELSE 'fail' END AS rcResult
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "scores": """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
        (o_custkey % 99 + 1) / CAST(100 AS DOUBLE) AS gbm, (o_orderkey % 97 + 1) / CAST(100 AS DOUBLE) AS rf,
        ((o_orderkey * 37) % 89 + 1) / CAST(100 AS DOUBLE) AS glm FROM orders""",
    "deduped": "SELECT pid, date, visit, bssid, avg(rssi) AS rssi, avg(frequency) AS frequency FROM readings GROUP BY ALL",
    "surveys": """SELECT pid, visit, row_number() OVER (PARTITION BY pid ORDER BY visit) AS n FROM (
        SELECT DISTINCT pid, visit FROM readings WHERE type = 1)""",
}


def names_in(sql: str) -> set[str]:
    return {t for t in TABLES if re.search(rf"\b{t}\b", sql)}


def checked(sql: str) -> str:
    """``sql`` with the derived tables it needs as common table expressions."""
    needed: set[str] = set()
    pending = names_in(sql)
    while pending:
        needed |= pending
        pending = set().union(*[names_in(TABLES[t]) for t in pending]) - needed
    parts = [f"{t} AS ({TABLES[t]})" for t in TABLES if t in needed]
    if not parts:
        return sql
    own = sql.lstrip()
    return f"WITH {', '.join(parts)}, {own[5:]}" if own.startswith("WITH ") else f"WITH {', '.join(parts)} {own}"


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")

    def run(spark: SparkSession, folder: str) -> DataFrame:
        pin_timezone(spark)
        return query(spark, folder)

    QUERIES[name] = run
    if sql is not None:
        CHECKS[name] = checked(sql)


def query(name: str, sql: str | None = None):
    """Decorator form of :func:`register`."""

    def wrap(fn: Query) -> Query:
        register(name, fn, sql)
        return fn

    return wrap


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles whose last digits depend on summation order, rounded for comparison."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})
