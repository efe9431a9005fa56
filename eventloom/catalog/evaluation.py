"""Queries of splits, encodings, ensembles, metrics and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom import views
from eventloom.catalog.base import query, rounded
from eventloom.functions import text
from eventloom.operators import evaluate as ev
from eventloom.operators import relational as rel
from eventloom.operators import sampling as sa
from eventloom.operators import stats as st
from eventloom.operators import visits as v
from eventloom.plans import models

# --- splits and balancing ---------------------------------------------------------------------------


def hashed(key: str, seed: int = 1) -> str:
    return f"md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}'))"


@query(
    "split_70_30",
    f"""SELECT msno, is_churn, row_number() OVER (ORDER BY {hashed('msno')}) <=
        (SELECT floor(count(*) * CAST(0.7 AS DOUBLE)) FROM members) AS is_train FROM members""",
)
def _(spark, folder):
    df = views.members(spark, folder).select("msno", "is_churn")
    return sa.split_exact(df, "msno", 0.7, seed=1)


@query(
    "split_three",
    f"""WITH r AS (SELECT msno, row_number() OVER (ORDER BY {hashed('msno')}) AS n, count(*) OVER () AS size FROM members)
        SELECT msno, CASE WHEN n <= floor(size * CAST(0.5 AS DOUBLE)) THEN 0
                          WHEN n <= floor(size * CAST(0.75 AS DOUBLE)) THEN 1 ELSE 2 END AS part FROM r""",
)
def _(spark, folder):
    return sa.split_bands(views.members(spark, folder).select("msno"), "msno", (0.5, 0.25), seed=1)


def drawn(key: str, seed: int) -> str:
    return f"CAST(('0x' || substr({hashed(key, seed)}, 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


@query(
    "split_random",
    f"""SELECT race_id, CASE WHEN {drawn('race_id', 42)} < CAST(0.5 AS DOUBLE) THEN 0
        WHEN {drawn('race_id', 42)} < CAST(0.8 AS DOUBLE) THEN 1 ELSE 2 END AS part FROM races""",
)
def _(spark, folder):
    return sa.split_random(views.races(spark, folder).select("race_id"), "race_id", (0.5, 0.3), seed=42)


@query("split_bernoulli", f"SELECT race_id, {drawn('race_id', 42)} < CAST(0.8 AS DOUBLE) AS is_train FROM races")
def _(spark, folder):
    return sa.split_bernoulli(views.races(spark, folder).select("race_id"), "race_id", 0.8, seed=42)


@query(
    "split_stratified",
    f"""WITH r AS (SELECT click_id, is_attributed,
          row_number() OVER (PARTITION BY is_attributed ORDER BY {hashed('click_id')}) AS n,
          count(*) OVER (PARTITION BY is_attributed) AS size FROM clicks)
        SELECT click_id, is_attributed, n <= ceil(size * CAST(0.9 AS DOUBLE)) AS is_train FROM r""",
)
def _(spark, folder):
    df = views.clicks(spark, folder).select("click_id", "is_attributed")
    return sa.split_stratified(df, "click_id", "is_attributed", 0.9, seed=1)


@query(
    "split_tail",
    """SELECT click_id, row_number() OVER (ORDER BY click_time DESC, click_id DESC) <= 500 AS is_valid FROM click_train""",
)
def _(spark, folder):
    df = views.click_train(spark, folder).select("click_time", "click_id")
    return rel.tail_flag(df, views.CLICK_ORDER, 500).select("click_id", "is_valid")


def balanced_sql(table: str, key: str, label: str) -> str:
    return f"""WITH r AS (SELECT {key}, {label}, row_number() OVER (PARTITION BY {label} ORDER BY {hashed(key)}) AS n FROM {table}),
        s AS (SELECT min(c) AS smallest FROM (SELECT count(*) AS c FROM {table} GROUP BY {label}))
        SELECT {key}, {label} FROM r WHERE n <= (SELECT smallest FROM s)"""


@query("downsample", balanced_sql("clicks", "click_id", "is_attributed"))
def _(spark, folder):
    return sa.balance(views.clicks(spark, folder).select("click_id", "is_attributed"), "click_id", "is_attributed")


@query("downsample_min", balanced_sql("clicks", "click_id", "app"))
def _(spark, folder):
    return sa.balance(views.clicks(spark, folder).select("click_id", "app"), "click_id", "app")


@query("fold_modulo", "SELECT msno, CAST((row_number() OVER (ORDER BY msno) - 1) % 3 AS BIGINT) AS fold FROM members")
def _(spark, folder):
    return sa.fold_modulo(views.members(spark, folder).select("msno"), ["msno"], 3)


@query(
    "class_weight",
    "SELECT click_id, is_attributed, CASE WHEN is_attributed = 1 THEN CAST(200 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight FROM clicks",
)
def _(spark, folder):
    weight = sa.class_weight("is_attributed", 200).alias("weight")
    return views.clicks(spark, folder).select("click_id", "is_attributed", weight)


_LEVELS = """lv_{c} AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM races GROUP BY {c})"""


@query(
    "one_hot",
    "WITH "
    + ", ".join(_LEVELS.format(c=c) for c in ("weather", "track"))
    + """, sizes AS (SELECT (SELECT count(*) FROM lv_weather) AS w, (SELECT count(*) FROM lv_track) AS t)
    SELECT race_id, CAST(w + t AS BIGINT) AS width, concat_ws(',', CAST(a.i AS VARCHAR), CAST(w + b.i AS VARCHAR)) AS slots
    FROM races JOIN lv_weather a USING (weather) JOIN lv_track b USING (track), sizes""",
)
def _(spark, folder):
    encoded = models.one_hot(views.races(spark, folder), ["weather", "track"])
    return encoded.select(
        "race_id",
        F.size("onehot").cast("bigint").alias("width"),
        F.array_join(
            F.filter(F.transform("onehot", lambda x, i: F.when(x == 1.0, i)), lambda i: i.isNotNull()).cast("array<string>"),
            ",",
        ).alias("slots"),
    )


# --- ensembles and metrics --------------------------------------------------------------------------

PREDICTIONS = ["gbm", "rf", "glm"]


@query("ensemble_mean", "SELECT id, round((gbm + rf + glm) / 3, 6) AS p FROM scores")
def _(spark, folder):
    return views.scores(spark, folder).select("id", F.round(ev.arithmetic_mean(PREDICTIONS), 6).alias("p"))


@query("ensemble_geo", "SELECT id, round(sqrt(gbm * rf), 6) AS p FROM scores")
def _(spark, folder):
    return views.scores(spark, folder).select("id", F.round(ev.geometric_mean(["gbm", "rf"]), 6).alias("p"))


@query("ensemble_harm", "SELECT id, round(2 / (1 / gbm + 1 / rf), 6) AS p FROM scores")
def _(spark, folder):
    return views.scores(spark, folder).select("id", F.round(ev.harmonic_mean(["gbm", "rf"]), 6).alias("p"))


_AUC = """(SELECT sum(CAST(pos AS DOUBLE) * (below + neg / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))
    FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg AS below FROM (
        SELECT {c} AS p, sum(y) AS pos, count(*) - sum(y) AS neg FROM scores GROUP BY {c})))"""


@query("metric_auc", " UNION ALL ".join(f"SELECT '{c}' AS model, round({_AUC.format(c=c)}, 6) AS auc" for c in PREDICTIONS))
def _(spark, folder):
    return rounded(ev.auc_of(views.scores(spark, folder), "y", PREDICTIONS), "auc")


_LOGLOSS = "-avg(y * ln({c}) + (1 - y) * ln(1 - {c}))"


@query("metric_logloss", f"SELECT round({_LOGLOSS.format(c='gbm')}, 6) AS logloss FROM scores")
def _(spark, folder):
    return rounded(ev.log_loss(views.scores(spark, folder), "y", "gbm"), "logloss")


@query("metric_confusion", 'SELECT CAST(gbm > 0.5 AS INT) AS pred, y AS "true", count(*) AS n FROM scores GROUP BY ALL')
def _(spark, folder):
    return ev.confusion(views.scores(spark, folder), "y", "gbm")


@query("metric_accuracy", "SELECT round(avg(CAST(CAST(gbm > 0.5 AS INT) = y AS INT)), 6) AS accuracy FROM scores")
def _(spark, folder):
    return rounded(ev.accuracy(views.scores(spark, folder), "y", "gbm"), "accuracy")


@query(
    "metric_summary",
    f"""SELECT round(avg((y - gbm) * (y - gbm)), 6) AS mse, round(sqrt(avg((y - gbm) * (y - gbm))), 6) AS rmse,
        round(1 - avg((y - gbm) * (y - gbm)) / var_pop(y), 6) AS r2, round({_LOGLOSS.format(c='gbm')}, 6) AS logloss,
        round((avg(CAST(gbm <= 0.5 AS INT)) FILTER (y = 1) + avg(CAST(gbm > 0.5 AS INT)) FILTER (y = 0)) / 2, 6) AS mean_per_class_error,
        round({_AUC.format(c='gbm')}, 6) AS auc, round(2 * {_AUC.format(c='gbm')} - 1, 6) AS gini FROM scores""",
)
def _(spark, folder):
    df = ev.summary(views.scores(spark, folder), "y", "gbm")
    return rounded(df, *df.columns)


_THRESHOLDS = """WITH c AS (SELECT gbm AS threshold, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM scores GROUP BY gbm),
    r AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
          sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM c),
    t AS (SELECT threshold, (tp + n - fp) / (p + n) AS accuracy, tp / (tp + fp) AS precision, tp / p AS recall,
          least(tp / p, (n - fp) / n) AS min_per_class_accuracy FROM r),
    l AS (SELECT threshold, 'accuracy' AS variable, accuracy AS value FROM t UNION ALL
          SELECT threshold, 'precision', precision FROM t UNION ALL SELECT threshold, 'recall', recall FROM t UNION ALL
          SELECT threshold, 'min_per_class_accuracy', min_per_class_accuracy FROM t)"""


@query(
    "metric_thresholds",
    f"""{_THRESHOLDS} SELECT threshold, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(min_per_class_accuracy, 6) AS min_per_class_accuracy FROM t""",
)
def _(spark, folder):
    return rounded(ev.thresholds(views.scores(spark, folder), "y", "gbm"), *ev.CRITERIA)


@query("unpivot_scores", f"{_THRESHOLDS} SELECT threshold, variable, round(value, 6) AS value FROM l")
def _(spark, folder):
    table = ev.thresholds(views.scores(spark, folder), "y", "gbm")
    return rounded(ev.to_long(table, ["threshold"], ev.CRITERIA), "value")


@query(
    "metric_max_criteria",
    f"""{_THRESHOLDS}, b AS (SELECT variable, max(value) AS value FROM l GROUP BY variable)
        SELECT variable AS criterion, max(l.threshold) AS threshold, round(max(b.value), 6) AS value
        FROM l JOIN b USING (variable) WHERE l.value = b.value GROUP BY variable""",
)
def _(spark, folder):
    return rounded(ev.max_criteria(views.scores(spark, folder), "y", "gbm"), "value")


@query(
    "scoring_history",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS algorithm, b * 60 + b + CAST(0.5 AS DOUBLE) AS duration, m AS variable, round(val, 6) AS value FROM (
          SELECT id % 10 AS b, 'validation_rmse' AS m, sqrt(avg((y - {c}) * (y - {c}))) AS val FROM scores GROUP BY ALL
          UNION ALL SELECT id % 10, 'validation_logloss', {_LOGLOSS.format(c=c)} FROM scores GROUP BY ALL)"""
        for c in ("gbm", "rf")
    ),
)
def _(spark, folder):
    histories = []
    for c in ("gbm", "rf"):
        squared = (F.col("y") - F.col(c)) * (F.col("y") - F.col(c))
        per_round = views.scores(spark, folder).groupBy((F.col("id") % 10).alias("b")).agg(
            F.sqrt(F.avg(squared)).alias("validation_rmse"), ev.log_loss_value("y", c).alias("validation_logloss")
        )
        spoken = F.format_string("%d min %d.5 sec", "b", "b")
        histories.append(
            per_round.select(
                F.lit(c).alias("algorithm"), text.parse_duration(spoken).alias("duration"),
                "validation_rmse", "validation_logloss",
            )
        )
    stacked = rel.append_by_name(histories, rank=None)
    return rounded(ev.to_long(stacked, ["algorithm", "duration"], ["validation_rmse", "validation_logloss"]), "value")


# --- tables and statistics --------------------------------------------------------------------------


@query(
    "freq_table",
    """SELECT "rcResult", count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM races) AS DOUBLE), 6) AS share
       FROM races GROUP BY "rcResult" """,
)
def _(spark, folder):
    return rounded(st.frequency_table(views.races(spark, folder), "rcResult"), "share")


@query("two_way_table", 'SELECT weather, "rcResult", count(*) AS n FROM races GROUP BY ALL')
def _(spark, folder):
    return st.two_way_table(views.races(spark, folder), "weather", "rcResult")


def five_sql(column: str, table: str, by: str = "") -> str:
    q = lambda p, name: f"round(quantile_cont({column}, {p}), 6) AS {name}"
    return f"""SELECT {by + ', ' if by else ''}round(min({column}), 6) AS min, {q(0.25, 'q1')}, {q(0.5, 'median')},
        round(avg({column}), 6) AS mean, {q(0.75, 'q3')}, round(max({column}), 6) AS max FROM {table} {'GROUP BY ' + by if by else ''}"""


FIVE = ("min", "q1", "median", "mean", "q3", "max")


@query("column_summary", five_sql("similarity", "visit_log"))
def _(spark, folder):
    return rounded(st.five_numbers(views.visit_log(spark, folder), "similarity"), *FIVE)


@query("class_profile_numeric", five_sql('"hrWeight"', "races", '"rcResult"'))
def _(spark, folder):
    return rounded(st.five_numbers(views.races(spark, folder), "hrWeight", ["rcResult"]), *FIVE)


@query(
    "class_profile_factor",
    """SELECT weather, "rcResult", count(*) AS n,
       round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY weather) AS DOUBLE), 6) AS share FROM races GROUP BY weather, "rcResult" """,
)
def _(spark, folder):
    return rounded(st.level_shares(views.races(spark, folder), "weather", "rcResult"), "share")


_NUMERIC = ["chulNo", "hrWeight", "rcDist"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS var1, '{b}' AS var2, round(corr("{a}", "{b}"), 6) AS r FROM races""" for a in _NUMERIC for b in _NUMERIC
    ),
)
def _(spark, folder):
    return rounded(st.correlation_matrix(views.races(spark, folder), _NUMERIC), "r")


@query(
    "cor_test",
    """SELECT round(r, 6) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t, n - 2 AS df FROM (
       SELECT corr(similarity, threshold) AS r, count(*) AS n FROM visit_log)""",
)
def _(spark, folder):
    return rounded(st.correlation_test(views.visit_log(spark, folder), "similarity", "threshold"), "r", "t")


_SIDE = "avg(rssi) FILTER (frequency_24 = {i}) AS m{i}, var_samp(rssi) FILTER (frequency_24 = {i}) AS v{i}, count(*) FILTER (frequency_24 = {i}) AS n{i}"


@query(
    "welch_t",
    f"""WITH f AS (SELECT CAST(frequency < 3000 AS INT) AS frequency_24, rssi FROM readings),
        g AS (SELECT {_SIDE.format(i=0)}, {_SIDE.format(i=1)} FROM f)
        SELECT round(m0, 6) AS mean1, round(m1, 6) AS mean2, round((m0 - m1) / sqrt(v0 / n0 + v1 / n1), 6) AS t,
        round((v0 / n0 + v1 / n1) * (v0 / n0 + v1 / n1) / ((v0 / n0) * (v0 / n0) / (n0 - 1) + (v1 / n1) * (v1 / n1) / (n1 - 1)), 4) AS df FROM g""",
)
def _(spark, folder):
    band = (F.col("frequency") < v.BAND_LIMIT).cast("int")
    df = st.welch_t(views.readings(spark, folder).withColumn("frequency_24", band), "rssi", "frequency_24")
    return rounded(rounded(df, "mean1", "mean2", "t"), "df", digits=4)


@query(
    "zscore",
    """SELECT msno, round((balance - avg(balance) OVER ()) / stddev_samp(balance) OVER (), 6) AS balance,
       round((n_trans - avg(n_trans) OVER ()) / stddev_samp(n_trans) OVER (), 6) AS n_trans FROM members""",
)
def _(spark, folder):
    df = views.members(spark, folder).select("msno", "balance", "n_trans")
    return rounded(st.z_scores(df, ["balance", "n_trans"]), "balance", "n_trans")


_R = " , ".join(f'corr("{a}", "{b}") AS r_{a}_{b}' for a, b in (("chulNo", "hrWeight"), ("chulNo", "rcDist"), ("hrWeight", "rcDist")))


@query(
    "vif",
    f"""WITH c AS (SELECT {_R} FROM races),
        d AS (SELECT *, 1 + 2 * "r_chulNo_hrWeight" * "r_chulNo_rcDist" * "r_hrWeight_rcDist" - "r_chulNo_hrWeight" ** 2
              - "r_chulNo_rcDist" ** 2 - "r_hrWeight_rcDist" ** 2 AS det FROM c)
        SELECT 'chulNo' AS feature, round((1 - "r_hrWeight_rcDist" ** 2) / det, 6) AS vif FROM d
        UNION ALL SELECT 'hrWeight', round((1 - "r_chulNo_rcDist" ** 2) / det, 6) FROM d
        UNION ALL SELECT 'rcDist', round((1 - "r_chulNo_hrWeight" ** 2) / det, 6) FROM d""",
)
def _(spark, folder):
    return rounded(models.variance_inflation(views.races(spark, folder), _NUMERIC), "vif")


# The two-sided probability by Simpson's rule over the density of t, and the quantile of t by its expansion for
# many degrees of freedom.
_TAIL = """1 - 2 * (SELECT sum(CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * pow(1 + pow(abs(t) * i / 20000, 2) / df, -(df + 1) / 2)) FROM range(20001) AS s(i))
        * abs(t) / 60000 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())"""
_Z = "1.959963984540054"
_T = f"""({_Z} + (pow({_Z}, 3) + {_Z}) / (4 * df) + (5 * pow({_Z}, 5) + 16 * pow({_Z}, 3) + 3 * {_Z}) / (96 * df * df)
        + (3 * pow({_Z}, 7) + 19 * pow({_Z}, 5) + 17 * pow({_Z}, 3) - 15 * {_Z}) / (384 * pow(df, 3)))"""


@query(
    "cor_test_pairs",
    f"""WITH r AS ({" UNION ALL ".join(
        f"""SELECT '{a}' AS var1, '{b}' AS var2, corr("{a}", "{b}") AS r, count(*) AS n FROM races"""
        for a, b in (("chulNo", "hrWeight"), ("chulNo", "rcDist"), ("hrWeight", "rcDist"))
    )}), t AS (SELECT *, CAST(n - 2 AS DOUBLE) AS df, r * sqrt((n - 2) / (1 - r * r)) AS t FROM r)
    SELECT var1, var2, n, round(r, 8) AS r, round(t, 6) AS t, n - 2 AS df, round({_TAIL}, 8) AS p,
        round(tanh(atanh(r) - {_Z} / sqrt(n - 3)), 8) AS low, round(tanh(atanh(r) + {_Z} / sqrt(n - 3)), 8) AS high FROM t""",
)
def _(spark, folder):
    df = st.correlation_tests(views.races(spark, folder), _NUMERIC)
    return rounded(rounded(df, "r", "p", "low", "high", digits=8), "t")


def _welch_sides(column: str) -> str:
    side = """avg("{c}") FILTER ("rcResult" = '{k}') AS m{i}, var_samp("{c}") FILTER ("rcResult" = '{k}') / count("{c}") FILTER ("rcResult" = '{k}') AS e{i},
        count("{c}") FILTER ("rcResult" = '{k}') AS n{i}"""
    return f"SELECT '{column}' AS value, {side.format(c=column, k='fail', i=1)}, {side.format(c=column, k='pass', i=2)} FROM races"


@query(
    "welch_t_pairs",
    f"""WITH g AS ({" UNION ALL ".join(map(_welch_sides, _NUMERIC))}),
        t AS (SELECT *, (m1 - m2) / sqrt(e1 + e2) AS t, (e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) AS df FROM g)
        SELECT value, round(m1, 6) AS mean1, round(m2, 6) AS mean2, round(t, 6) AS t, round(df, 4) AS df, round({_TAIL}, 8) AS p,
        round(m1 - m2 - {_T} * sqrt(e1 + e2), 5) AS low, round(m1 - m2 + {_T} * sqrt(e1 + e2), 5) AS high FROM t""",
)
def _(spark, folder):
    df = st.welch_tests(views.races(spark, folder), _NUMERIC, "rcResult", "fail", "pass")
    return rounded(rounded(rounded(df, "p", digits=8), "df", digits=4).transform(lambda d: rounded(d, "low", "high", digits=5)), "mean1", "mean2", "t")


@query(
    "class_density",
    """WITH v AS (SELECT "rcResult" AS k, CAST("rcDist" AS DOUBLE) AS x FROM races WHERE "rcDist" IS NOT NULL),
        e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 511 AS step FROM v),
        c AS (SELECT k, least(CAST(floor((x - lo) / step) AS INT), 510) AS cell, (x - lo) / step AS spot FROM v, e),
        b AS (SELECT k, place, sum(share) AS share FROM (SELECT k, cell AS place, 1 - (spot - cell) AS share FROM c
            UNION ALL SELECT k, cell + 1, spot - cell FROM c) GROUP BY k, place),
        s AS (SELECT k, count(*) AS n, 0.9 * least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34) * pow(count(*), -0.2) AS h
            FROM v GROUP BY k)
        SELECT s.k AS "rcResult", i AS place, round(lo + i * step, 4) AS x,
            round(1e6 * sum(share * exp(-0.5 * pow((i - place) * step / h, 2))) / (n * h * sqrt(2 * pi())), 6) AS density, round(h, 6) AS bandwidth
        FROM s JOIN b USING (k), e, range(512) AS g(i) GROUP BY s.k, i, lo, step, n, h""",
)
def _(spark, folder):
    df = st.class_density(views.races(spark, folder), "rcDist", "rcResult")
    df = df.withColumn("density", F.col("density") * 1e6)
    return rounded(rounded(df, "density", "bandwidth"), "x", digits=4)
