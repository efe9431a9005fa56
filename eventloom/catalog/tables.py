"""Queries of sources and sinks, projections, filters, joins, set operations and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import views
from eventloom.catalog.base import longs, query
from eventloom.functions import text, timeparts
from eventloom.operators import relational as rel
from eventloom.operators import sampling, stats, visits
from eventloom.sources import files

CLICK_COLUMNS = ["ip", "app", "device", "os", "channel", "click_time"]


def whole_seconds(df):
    """The click log's own resolution is one second; its text form is written that way."""
    return df.withColumn("click_time", F.date_trunc("second", "click_time").cast("timestamp_ntz"))


def written_csv(spark, df, **options) -> str:
    path = files.scratch_folder(spark)
    df.write.mode("overwrite").options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", **options).csv(path)
    return path


# --- sources and sinks ------------------------------------------------------------------------------


@query(
    "scan_typed_csv",
    "SELECT ip, app, device, os, channel, date_trunc('second', click_time) AS click_time, is_attributed FROM clicks",
)
def _(spark, folder):
    path = written_csv(spark, whole_seconds(views.clicks(spark, folder)))
    return files.read_typed_csv(spark, path, columns=[*CLICK_COLUMNS, "is_attributed"])


@query(
    "scan_row_range",
    """SELECT click_id, ip, click_time FROM (SELECT *, row_number() OVER (ORDER BY click_time, click_id) AS n FROM clicks)
       WHERE n BETWEEN 200 AND 5000""",
)
def _(spark, folder):
    return rel.row_range(views.clicks(spark, folder), views.CLICK_ORDER, 200, 5000).select("click_id", "ip", "click_time")


@query("scan_select_cols", "SELECT CAST(ip AS VARCHAR) AS ip, CAST(channel AS VARCHAR) AS channel FROM clicks")
def _(spark, folder):
    path = written_csv(spark, views.clicks(spark, folder).drop("click_time"))
    kept = files.read_csv_columns(spark, path, drop=["click_id", "is_attributed"])
    return kept.select("ip", "channel")


@query("scan_tsv_skip", "SELECT visit, pid, date, rank, type FROM visit_log")
def _(spark, folder):
    log = views.visit_log(spark, folder).select("visit", "pid", "date", "rank", "type")
    path = files.scratch_folder(spark)
    files.write_tsv_with_preamble(log, path, ["visit log", "exported", "places"])
    return files.read_tsv_after_preamble(spark, path, log.schema, skip=3)


@query("scan_encoding", "SELECT race_id, concat('é ', weather) AS weather FROM races")
def _(spark, folder):
    named = views.races(spark, folder).select("race_id", F.concat(F.lit("é "), "weather").alias("weather"))
    path = written_csv(spark, named, encoding="ISO-8859-1")
    return files.read_inferred_csv(spark, path, encoding="ISO-8859-1").withColumn("race_id", F.col("race_id").cast("bigint"))


@query("scan_infer", "SELECT msno, gender, n_trans, balance, is_churn FROM members")
def _(spark, folder):
    path = written_csv(spark, views.members(spark, folder).select("msno", "gender", "n_trans", "balance", "is_churn"))
    return longs(files.read_inferred_csv(spark, path), "msno", "n_trans")


@query("create_like", "SELECT CAST(0 AS BIGINT) AS copied, count(*) AS source FROM click_train")
def _(spark, folder):
    train = views.click_train(spark, folder)
    both = rel.append_by_name([files.like(train), train])
    return both.agg(F.count_if(F.col("src_rank") == 0).alias("copied"), F.count_if(F.col("src_rank") == 1).alias("source"))


@query(
    "load_colmap",
    """SELECT click_id, ip, app, device, os, channel AS channels, date_trunc('second', click_time) AS click_time
       FROM test_supplement""",
)
def _(spark, folder):
    loaded = whole_seconds(views.test_supplement(spark, folder)).withColumnRenamed("channel", "channels")
    file_order = ["click_id", "ip", "app", "device", "channels", "os", "click_time"]
    path = written_csv(spark, loaded.select(*file_order))
    table_order = ["click_id", "ip", "app", "device", "os", "channels", "click_time"]
    return files.read_in_file_order(spark, path, file_order, table_order, loaded.schema)


@query("cache_parquet", "SELECT * FROM click_train")
def _(spark, folder):
    return files.cached_parquet(views.click_train(spark, folder), files.scratch_folder(spark))


@query(
    "sink_submission",
    "SELECT CAST(id AS VARCHAR) AS id, printf('%.9f', (gbm + rf + glm) / CAST(3 AS DOUBLE)) AS is_attributed FROM scores",
)
def _(spark, folder):
    mean = (F.col("gbm") + F.col("rf") + F.col("glm")) / F.lit(3.0)
    path = files.scratch_folder(spark)
    files.write_submission(views.scores(spark, folder).withColumn("is_attributed", mean), path, "id", "is_attributed")
    return files.read_csv_columns(spark, path)


@query(
    "insert_select",
    """SELECT ip, app, device, os, channel, click_time FROM click_train
       UNION ALL SELECT ip, app, device, os, channel, click_time FROM test_supplement""",
)
def _(spark, folder):
    path = files.scratch_folder(spark)
    files.insert_select(views.click_train(spark, folder), path, CLICK_COLUMNS)
    files.insert_select(views.test_supplement(spark, folder), path, CLICK_COLUMNS)
    return spark.read.parquet(path)


# --- projections ------------------------------------------------------------------------------------


@query("project_cols", "SELECT ip, app, device, os, channel, click_time FROM clicks")
def _(spark, folder):
    return views.clicks(spark, folder).select(*CLICK_COLUMNS)


@query("drop_cols", "SELECT click_id, app, device, os, channel, is_attributed FROM clicks")
def _(spark, folder):
    return views.clicks(spark, folder).drop("ip", "click_time")


@query("project_positional", "SELECT msno, gender, max_paid, balance, is_churn FROM members")
def _(spark, folder):
    df = views.members(spark, folder)
    return df.select(df.columns[:2] + df.columns[5:])


@query("project_by_type", "SELECT race_id, chulNo AS \"chulNo\", hrWeight AS \"hrWeight\", rcDist AS \"rcDist\" FROM races")
def _(spark, folder):
    df = views.races(spark, folder)
    return df.select([f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


@query("reorder_cols", "SELECT pid, date, visit, rank, similarity, threshold, type FROM visit_log")
def _(spark, folder):
    df = views.visit_log(spark, folder)
    first = ["pid", "date"]
    return df.select(first + [c for c in df.columns if c not in first])


@query("rename_cols", "SELECT visit AS \"index\", pid AS place, date AS visit_date, type FROM visit_log")
def _(spark, folder):
    df = views.visit_log(spark, folder).select("visit", "pid", "date", "type")
    return df.withColumnsRenamed({"visit": "index", "pid": "place"}).withColumnRenamed("date", "visit_date")


@query(
    "const_cols",
    "SELECT visit, pid, CAST(0.9999 AS DOUBLE) AS similarity, 0 AS threshold, 1 AS rank, 1 AS type FROM visit_log",
)
def _(spark, folder):
    return views.visit_log(spark, folder).select(
        "visit", "pid", F.lit(0.9999).alias("similarity"), F.lit(0).alias("threshold"),
        F.lit(1).alias("rank"), F.lit(1).alias("type"),
    )


# --- filters ----------------------------------------------------------------------------------------


def timed_clicks(spark, folder):
    return views.clicks(spark, folder).withColumns(
        {"hour": timeparts.hour_of("click_time"), "day": timeparts.day_of("click_time")}
    )


@query(
    "filter_days",
    "SELECT click_id, day FROM timed WHERE (day = 7 OR day = 8 OR day > 10) AND day NOT IN (12, 20)",
)
def _(spark, folder):
    day = F.col("day")
    df = timed_clicks(spark, folder).filter((day == 7) | (day == 8) | (day > 10)).filter(~day.isin(12, 20))
    return df.select("click_id", "day")


@query("filter_valid_hours", "SELECT click_id, day, hour FROM timed WHERE day = 9 AND hour IN (12, 13, 17, 18, 21, 22)")
def _(spark, folder):
    df = timed_clicks(spark, folder).filter((F.col("day") == 9) & F.col("hour").isin(12, 13, 17, 18, 21, 22))
    return df.select("click_id", "day", "hour")


@query(
    "filter_partial_days",
    "SELECT click_id, day, hour FROM timed WHERE NOT (day = 6 AND hour IN (14, 15)) AND NOT (day = 9 AND hour = 16)",
)
def _(spark, folder):
    day, hour = F.col("day"), F.col("hour")
    df = timed_clicks(spark, folder).filter(~((day == 6) & hour.isin(14, 15))).filter(~((day == 9) & (hour == 16)))
    return df.select("click_id", "day", "hour")


@query("filter_above_threshold", "SELECT * FROM visit_log WHERE similarity > threshold")
def _(spark, folder):
    return views.visit_log(spark, folder).filter(F.col("similarity") > F.col("threshold"))


@query("filter_rssi", "SELECT visit, bssid, rssi FROM readings WHERE rssi > -50")
def _(spark, folder):
    return views.readings(spark, folder).filter("rssi > -50").select("visit", "bssid", "rssi")


@query(
    "filter_kth_key",
    """SELECT visit, pid, date FROM visit_log WHERE pid = (
         SELECT pid FROM (SELECT pid, row_number() OVER (ORDER BY pid) AS n FROM (SELECT DISTINCT pid FROM visit_log)) WHERE n = 11)""",
)
def _(spark, folder):
    return rel.rows_of_kth_key(views.visit_log(spark, folder), "pid", 11).select("visit", "pid", "date")


@query(
    "fill_zero",
    """SELECT msno, coalesce(CASE WHEN gender = 'female' THEN 1 WHEN gender IS NULL THEN NULL ELSE 0 END, 0) AS gender,
       coalesce(CAST(replace(fst_exp_date, '-', '') AS DOUBLE), 0) AS fst_exp_date,
       coalesce(CAST(replace(lst_exp_date, '-', '') AS DOUBLE), 0) AS lst_exp_date,
       n_trans, coalesce(max_paid, 0) AS max_paid, balance, is_churn FROM members""",
)
def _(spark, folder):
    df = views.members(spark, folder).withColumns(
        {
            "gender": text.recode_gender("gender"),
            "fst_exp_date": text.strip_all("fst_exp_date"),
            "lst_exp_date": text.strip_all("lst_exp_date"),
        }
    )
    return df.fillna(0)


@query(
    "fill_sentinel",
    "SELECT msno, coalesce(gender, 'none') AS gender, coalesce(max_paid, 999999999) AS max_paid FROM members",
)
def _(spark, folder):
    df = views.members(spark, folder).select("msno", "gender", "max_paid")
    return df.withColumns(text.filled({"gender": "none", "max_paid": 999999999.0}))


@query(
    "fill_median",
    """SELECT msno, round(coalesce(max_paid, (SELECT quantile_cont(max_paid, 0.5) FROM members)), 6) AS max_paid FROM members""",
)
def _(spark, folder):
    filled = stats.fill_median(views.members(spark, folder).select("msno", "max_paid"), "max_paid")
    return filled.withColumn("max_paid", F.round("max_paid", 6))


# --- joins ------------------------------------------------------------------------------------------

_SIX = "ip, app, device, os, channel, click_time"


@query(
    "sql_click_id_map",
    f"""SELECT DISTINCT t.click_id AS test_click_id, s.click_id AS sup_click_id
        FROM test_supplement s JOIN click_test t USING ({_SIX}) ORDER BY test_click_id""",
)
def _(spark, folder):
    supplement = views.test_supplement(spark, folder).withColumnRenamed("click_id", "sup_click_id")
    test = views.click_test(spark, folder).withColumnRenamed("click_id", "test_click_id")
    pairs = supplement.join(test, list(views.SIX_KEYS)).select("test_click_id", "sup_click_id")
    return pairs.distinct().orderBy("test_click_id")


@query(
    "align_test_mean",
    f"""WITH m AS (SELECT {_SIX}, avg((channel + click_id % 7) / CAST(200 AS DOUBLE)) AS is_attributed FROM test_supplement GROUP BY ALL)
        SELECT {_SIX}, click_id, round(is_attributed, 6) AS is_attributed FROM click_test LEFT JOIN m USING ({_SIX})""",
)
def _(spark, folder):
    score = (F.col("channel") + F.col("click_id") % 7) / F.lit(200.0)
    scored = views.test_supplement(spark, folder).withColumn("is_attributed", score)
    aligned = rel.align_mean(views.click_test(spark, folder), scored, views.SIX_KEYS, "is_attributed")
    return aligned.withColumn("is_attributed", F.round("is_attributed", 6))


@query(
    "align_test_features",
    f"""WITH u AS (SELECT DISTINCT {_SIX} FROM test_supplement),
        g AS (SELECT *, count(*) OVER (PARTITION BY ip, app) AS n_ip_app FROM u)
        SELECT {_SIX}, click_id, n_ip_app FROM click_test LEFT JOIN g USING ({_SIX})""",
)
def _(spark, folder):
    from eventloom.operators.features import add_features, group_size

    unique = views.test_supplement(spark, folder).drop("click_id").dropDuplicates()
    described = add_features(unique, [group_size(["ip", "app"], "n_ip_app")], order=views.SIX_KEYS)
    return rel.align_features(views.click_test(spark, folder), described)


@query(
    "sql_inner_join",
    "SELECT c_name AS name, n_name AS nation, c_acctbal AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(spark, folder):
    return spark.sql(
        """SELECT c_name AS name, n_name AS nation, c_acctbal AS balance
           FROM {people} p JOIN {places} n ON p.c_nationkey = n.n_nationkey""",
        people=views.table(spark, folder, "customer"),
        places=views.table(spark, folder, "nation"),
    )


@query("semi_known_pid", "SELECT visit, pid, bssid FROM readings WHERE pid IN (SELECT pid FROM visit_log WHERE type = 1)")
def _(spark, folder):
    known = views.visit_log(spark, folder).filter("type = 1").select("pid")
    return views.readings(spark, folder).join(known, "pid", "left_semi").select("visit", "pid", "bssid")


@query("anti_seen_member", "SELECT msno, gender FROM members WHERE msno NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(spark, folder):
    seen = views.table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").selectExpr("o_custkey AS msno")
    return views.members(spark, folder).join(seen, "msno", "left_anti").select("msno", "gender")


@query(
    "drop_singleton_keys",
    "SELECT visit, pid, bssid FROM readings WHERE visit IN (SELECT visit FROM readings GROUP BY visit HAVING count(*) > 1)",
)
def _(spark, folder):
    return rel.keys_seen_again(views.readings(spark, folder), "visit").select("visit", "pid", "bssid")


@query("semi_reference_bssid", """SELECT r.visit, r.pid, r.bssid, r.rssi FROM readings r WHERE EXISTS (
    SELECT 1 FROM readings s JOIN surveys v ON s.pid = v.pid AND s.visit = v.visit AND v.n = 2
    WHERE s.pid = r.pid AND s.bssid = r.bssid)""")
def _(spark, folder):
    return visits.seen_in_survey(views.readings(spark, folder), 2).select("visit", "pid", "bssid", "rssi")


@query("overlap_count", "SELECT count(*) AS n FROM click_test WHERE ip IN (SELECT ip FROM click_train)")
def _(spark, folder):
    return rel.overlap_count(views.click_test(spark, folder), views.click_train(spark, folder), "ip")


# --- aggregates of tables ---------------------------------------------------------------------------


@query("sql_ip_app_count", "SELECT ip, app, count(channel) AS ip_app_count FROM click_test GROUP BY ip, app")
def _(spark, folder):
    return spark.sql(
        "SELECT ip, app, count(channel) AS ip_app_count FROM {test} GROUP BY ip, app",
        test=views.click_test(spark, folder),
    )


@query(
    "vocab_sizes",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(max({c}) + 1 AS BIGINT) AS size FROM
            (SELECT {c} FROM click_train UNION ALL SELECT {c} FROM test_supplement)"""
        for c in ("app", "device", "os", "channel")
    ),
)
def _(spark, folder):
    frames = [views.click_train(spark, folder), views.test_supplement(spark, folder)]
    return rel.column_maxima(frames, ["app", "device", "os", "channel"])


@query("class_counts", "SELECT is_attributed, count(*) AS n FROM clicks GROUP BY is_attributed")
def _(spark, folder):
    return views.clicks(spark, folder).groupBy("is_attributed").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_keys", "SELECT count(*) AS row_count, count(DISTINCT pid) AS n_pid FROM visit_log")
def _(spark, folder):
    return views.visit_log(spark, folder).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("pid").alias("n_pid"))


@query("dedup_rows", f"SELECT DISTINCT {_SIX} FROM test_supplement")
def _(spark, folder):
    return views.test_supplement(spark, folder).drop("click_id").dropDuplicates()


@query("distinct_pairs", "SELECT DISTINCT pid, bssid FROM readings")
def _(spark, folder):
    return views.readings(spark, folder).select("pid", "bssid").distinct()


# --- set operations, sorts --------------------------------------------------------------------------


@query(
    "sql_union_all",
    "SELECT ip, app, device, os, channel, click_time FROM click_train UNION ALL SELECT ip, app, device, os, channel, click_time FROM test_supplement",
)
def _(spark, folder):
    columns = ", ".join(CLICK_COLUMNS)
    return spark.sql(
        f"SELECT {columns} FROM {{train}} UNION ALL SELECT {columns} FROM {{more}}",
        train=views.click_train(spark, folder),
        more=views.test_supplement(spark, folder),
    )


_APPENDED = """SELECT click_id, ip, app, device, os, channel, click_time, is_attributed, 0 AS src_rank FROM click_train
    UNION ALL SELECT click_id, ip, app, device, os, channel, click_time, NULL, 1 FROM test_supplement"""


@query("append_by_name", _APPENDED)
def _(spark, folder):
    return rel.append_by_name([views.click_train(spark, folder), views.test_supplement(spark, folder)])


@query("append_strict", "SELECT * FROM click_test UNION ALL SELECT * FROM test_supplement")
def _(spark, folder):
    return views.click_test(spark, folder).unionByName(views.test_supplement(spark, folder))


@query("split_back", "SELECT click_id, ip, click_time FROM test_supplement")
def _(spark, folder):
    both = rel.append_by_name([views.click_train(spark, folder), views.test_supplement(spark, folder)])
    return rel.split_back(both, 1).select("click_id", "ip", "click_time")


@query("sort_pid_date", "SELECT pid, date, visit FROM visit_log ORDER BY pid, date, visit")
def _(spark, folder):
    return views.visit_log(spark, folder).select("pid", "date", "visit").orderBy("pid", "date", "visit")


@query(
    "random_ten",
    "SELECT click_id, ip, app FROM clicks ORDER BY md5(concat_ws('|', CAST(click_id AS VARCHAR), '7')), click_id LIMIT 10",
)
def _(spark, folder):
    return sampling.random_rows(views.clicks(spark, folder).select("click_id", "ip", "app"), "click_id", 10, seed=7)


# --- text and recoding ------------------------------------------------------------------------------


@query(
    "strip_first_comma",
    """SELECT race_id, try_cast(regexp_replace("trRcCntT", ',', '') AS INT) AS "trRcCntT",
       try_cast(regexp_replace(concat("trRcCntT", ',', "trRcCntT"), ',', '') AS INT) AS twice FROM races""",
)
def _(spark, folder):
    t = F.col("trRcCntT")
    return views.races(spark, folder).select(
        "race_id",
        text.strip_first_comma(t).alias("trRcCntT"),
        text.strip_first_comma(F.concat(t, F.lit(","), t)).alias("twice"),
    )


@query(
    "strip_all",
    "SELECT msno, CAST(replace(fst_exp_date, '-', '') AS DOUBLE) AS fst, CAST(replace(lst_exp_date, '-', '') AS DOUBLE) AS lst FROM members",
)
def _(spark, folder):
    return views.members(spark, folder).select(
        "msno", text.strip_all("fst_exp_date").alias("fst"), text.strip_all("lst_exp_date").alias("lst")
    )


@query(
    "parse_duration",
    """SELECT race_id, round(("chulNo" % 3) * 60 + ("chulNo" + CAST(0.5 AS DOUBLE)), 6) AS seconds FROM races""",
)
def _(spark, folder):
    c = F.col("chulNo")
    seconds = F.concat((c + F.lit(0.5)).cast("string"), F.lit(" sec"))
    spoken = F.when(c % 3 > 0, F.concat((c % 3).cast("string"), F.lit(" min "), seconds)).otherwise(seconds)
    return views.races(spark, folder).select("race_id", F.round(text.parse_duration(spoken), 6).alias("seconds"))


@query(
    "cast_all_numeric",
    """SELECT race_id, try_cast("trRcCntT" AS DOUBLE) AS "trRcCntT", try_cast(weather AS DOUBLE) AS weather,
       CAST("chulNo" AS DOUBLE) AS "chulNo" FROM races""",
)
def _(spark, folder):
    return views.races(spark, folder).select(
        "race_id", *[F.col(c).try_cast("double").alias(c) for c in ("trRcCntT", "weather", "chulNo")]
    )


@query(
    "recode_label",
    """SELECT race_id, CASE "rcResult" WHEN 'fail' THEN 0 WHEN 'pass' THEN 1 END AS code,
       CASE "hrSex" WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS other FROM races""",
)
def _(spark, folder):
    return views.races(spark, folder).select(
        "race_id", text.recode_label("rcResult").alias("code"), text.recode_label("hrSex", ("O", "F")).alias("other")
    )


@query("recode_gender", "SELECT msno, CAST(gender = 'female' AS INT) AS female FROM members")
def _(spark, folder):
    return views.members(spark, folder).select("msno", text.recode_gender("gender").alias("female"))


@query(
    "label_encode",
    "SELECT race_id, weather, CAST(dense_rank() OVER (ORDER BY weather) - 1 AS BIGINT) AS code FROM races",
)
def _(spark, folder):
    return rel.encode_labels(views.races(spark, folder).select("race_id", "weather"), "weather", "code")
