"""The three workloads' tables, derived from the parquet tables of a data folder.

``clicks`` (ad clicks), ``visit_log`` / ``readings`` / ``scans`` (Wi-Fi visits), ``members``
(subscriptions), ``races`` (outcomes) and ``scores`` (predictions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.ordered import dealt, position
from eventloom.plans.pipelines import CLICK_ORDER  # noqa: F401

SIX_KEYS = ("ip", "app", "device", "os", "channel", "click_time")

TEST_START = "TIMESTAMP_NTZ '2024-01-24 00:00:00'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    number = "CAST(regexp_extract(props,'[0-9]+',0) AS INT)"
    return table(spark, folder, "events").selectExpr(
        "event_id AS click_id",
        "user_id AS ip",
        "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS app",
        f"{number} % 3 AS device",
        f"{number} % 7 AS os",
        f"{number} AS channel",
        "ts AS click_time",
        "CASE WHEN value > 100 THEN 1 ELSE 0 END AS is_attributed",
    )


def click_train(spark: SparkSession, folder: str) -> DataFrame:
    return clicks(spark, folder).filter(f"click_time < {TEST_START}")


def test_supplement(spark: SparkSession, folder: str) -> DataFrame:
    late = clicks(spark, folder).filter(f"click_time >= {TEST_START}").drop("is_attributed")
    again = late.filter("click_id % 5 = 0").withColumn("click_id", F.col("click_id") + 1000000000)
    return late.unionByName(again)


def click_test(spark: SparkSession, folder: str) -> DataFrame:
    return test_supplement(spark, folder).filter("click_id < 1000000000 AND click_id % 3 = 0")


def visit_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS visit",
        "o_custkey % 60 AS pid",
        "CAST(o_orderdate AS DATE) AS date",
        "CAST(o_orderkey % 3 AS INT) + 1 AS rank",
        "o_totalprice / CAST(499979 AS DOUBLE) AS similarity",
        "(3 + o_custkey % 5) / CAST(10 AS DOUBLE) AS threshold",
        "CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS type",
    )


READING_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")


def readings(spark: SparkSession, folder: str, with_position: bool = False) -> DataFrame:
    """One row per access point of a scan; ``pos`` (its place in the scan) only on request.

    All rows of a visit are in one partition, and there are more partitions the more rows there are.
    """
    lines = dealt(table(spark, folder, "lineitem"), ["l_orderkey"])
    first_day = lines.groupBy("l_orderkey").agg(F.min(F.col("l_shipdate").cast("date")).alias("date"))
    if with_position:
        lines = position(lines, ["l_orderkey"], READING_ORDER, "pos")
    return lines.join(first_day, "l_orderkey").selectExpr(
        "l_orderkey AS visit",
        "l_orderkey % 60 AS pid",
        "CASE WHEN l_orderkey % 20 = 0 THEN 1 ELSE 0 END AS type",
        *(["pos"] if with_position else []),
        "date",
        "concat('b', CAST(l_partkey % 40 AS STRING)) AS bssid",
        "concat('s', CAST(l_partkey % 7 AS STRING)) AS ssid",
        "-(40 + CAST(l_quantity AS INT)) AS rssi",
        "CASE WHEN l_partkey % 3 = 0 THEN 5180 ELSE 2412 + 5 * CAST(l_partkey % 13 AS INT) END AS frequency",
    )


# A packed scan holds at most this many records; a longer visit continues in further parts.
SCAN_PART = 1000


def scans(spark: SparkSession, folder: str) -> DataFrame:
    """Packed scans: records of 4 fields joined by commas (type 0) or of 5 joined by tabs (type 1).

    ``part`` numbers the packed rows of a visit from 0, so that no text grows without bound.
    """
    rows = readings(spark, folder, with_position=True)
    fields = [F.col("bssid"), F.col("ssid"), F.col("rssi").cast("string"), F.col("frequency").cast("string")]
    record = F.when(F.col("type") == 1, F.concat_ws("\t", *fields, F.lit("x"))).otherwise(F.concat_ws(",", *fields))
    packed = F.expr(
        "CASE WHEN type = 1 THEN listagg(record, '\\t') WITHIN GROUP (ORDER BY pos)"
        " ELSE listagg(record, ',') WITHIN GROUP (ORDER BY pos) END"
    )
    part = F.floor((F.col("pos") - 1) / SCAN_PART).cast("bigint")
    rows = rows.withColumn("record", record).withColumn("part", part)
    return rows.groupBy("visit", "pid", "type", "date", "part").agg(packed.alias("wifi"))


def members(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min(F.col("o_orderdate").cast("date")).cast("string").alias("fst_exp_date"),
        F.max(F.col("o_orderdate").cast("date")).cast("string").alias("lst_exp_date"),
        F.count("o_orderkey").alias("n"),
        F.max("o_totalprice").alias("max_paid"),
    )
    customers = table(spark, folder, "customer")
    return customers.join(orders, customers.c_custkey == orders.o_custkey, "left").selectExpr(
        "c_custkey AS msno",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'female' WHEN 'MACHINERY' THEN NULL ELSE 'male' END AS gender",
        "fst_exp_date",
        "lst_exp_date",
        "coalesce(n, 0L) AS n_trans",
        "max_paid",
        "c_acctbal AS balance",
        "CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS is_churn",
    )


def races(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(
        "o_orderkey AS race_id",
        "o_orderpriority AS weather",
        "c_mktsegment AS track",
        "o_orderstatus AS hrSex",
        "CASE WHEN o_totalprice < 1000 THEN CAST(CAST(floor(o_totalprice) AS INT) AS STRING)"
        " ELSE concat(CAST(CAST(floor(o_totalprice / 1000) AS INT) AS STRING), ',',"
        " lpad(CAST(CAST(floor(o_totalprice) AS INT) % 1000 AS STRING), 3, '0')) END AS trRcCntT",
        "CAST(o_orderkey % 17 AS INT) AS chulNo",
        "c_acctbal AS hrWeight",
        "o_totalprice AS rcDist",
        "CASE WHEN (o_orderkey * 7919) % 100 < 8 + CASE WHEN o_orderpriority < '3' THEN 30 ELSE 0 END"
        " + CASE WHEN o_totalprice > 150000 THEN 25 ELSE 0 END + CASE WHEN c_mktsegment = 'BUILDING' THEN 20 ELSE 0 END"
        " THEN 'pass' ELSE 'fail' END AS rcResult",
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y",
        "(o_custkey % 99 + 1) / CAST(100 AS DOUBLE) AS gbm",
        "(o_orderkey % 97 + 1) / CAST(100 AS DOUBLE) AS rf",
        "((o_orderkey * 37) % 89 + 1) / CAST(100 AS DOUBLE) AS glm",
    )


VIEWS = (clicks, click_train, test_supplement, click_test, visit_log, readings, scans, members, races, scores)


def register(spark: SparkSession, folder: str) -> None:
    """Make every table of this module a temporary view, for use from ``spark.sql``."""
    for view in VIEWS:
        view(spark, folder).createOrReplaceTempView(view.__name__)
