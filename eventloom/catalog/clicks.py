"""Queries of the click workload: time parts, per-group features, gaps, composite jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import views
from eventloom.catalog.base import query, register, rounded
from eventloom.functions import timeparts as tp
from eventloom.operators import features as f
from eventloom.operators import sketches as sk
from eventloom.operators.relational import append_by_name
from eventloom.plans import keysets, pipelines
from eventloom.plans.incremental import FeatureState, by_days
from eventloom.sources.files import scratch_folder


def timed(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks with hour, day, weekday and time-of-day bucket."""
    df = views.clicks(spark, folder).withColumns(
        {"hour": tp.hour_of("click_time"), "day": tp.day_of("click_time"), "wday": tp.weekday_no("click_time")}
    )
    return df.withColumn("in_test_hh", tp.in_test_hh("hour"))


# --- time parts -----------------------------------------------------------------------------------


@query("parse_ts", "SELECT click_id, try_cast(strftime(click_time, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts FROM clicks")
def _(spark, folder):
    text = F.date_format("click_time", "yyyy-MM-dd HH:mm:ss")
    return views.clicks(spark, folder).select("click_id", tp.parse_timestamp(text).cast("timestamp_ntz").alias("ts"))


@query("hour_day", "SELECT click_id, hour, day FROM timed")
def _(spark, folder):
    return timed(spark, folder).select("click_id", "hour", "day")


@query("shift_8h", "SELECT click_id, click_time + INTERVAL 8 HOUR AS shifted FROM clicks")
def _(spark, folder):
    return views.clicks(spark, folder).select("click_id", tp.shift_hours("click_time", 8).alias("shifted"))


@query(
    "shift_8h_parts",
    """SELECT click_id, CAST(hour(click_time + INTERVAL 8 HOUR) AS BIGINT) AS hour,
       CAST(day(click_time + INTERVAL 8 HOUR) AS BIGINT) AS day FROM clicks""",
)
def _(spark, folder):
    shifted = tp.shift_hours("click_time", 8)
    return views.clicks(spark, folder).select(
        "click_id", tp.hour_of(shifted).alias("hour"), tp.day_of(shifted).alias("day")
    )


@query("weekday_no", "SELECT click_id, wday FROM timed")
def _(spark, folder):
    return timed(spark, folder).select("click_id", "wday")


@query("date_int", "SELECT click_id, CAST(strftime(click_time, '%Y%m%d') AS INT) AS date_no FROM clicks")
def _(spark, folder):
    return views.clicks(spark, folder).select("click_id", tp.date_int("click_time").alias("date_no"))


@query(
    "ts_substr_parts",
    """SELECT click_id, CAST(substr(s, 1, 10) AS DATE) AS date, CAST(substr(s, 12, 2) AS DOUBLE) AS hr,
       CAST(substr(s, 15, 2) AS DOUBLE) AS mn, CAST(substr(s, 18, 2) AS DOUBLE) AS se
       FROM (SELECT click_id, strftime(click_time, '%Y-%m-%d %H:%M:%S') AS s FROM clicks)""",
)
def _(spark, folder):
    text = views.clicks(spark, folder).select(
        "click_id", F.date_format("click_time", "yyyy-MM-dd HH:mm:ss").alias("s")
    )
    return text.select("click_id", *[c.alias(n) for n, c in tp.substring_parts("s").items()])


@query(
    "in_test_hh",
    """SELECT click_id, in_test_hh AS rare_last, CASE in_test_hh WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS other_last FROM timed""",
)
def _(spark, folder):
    return timed(spark, folder).select(
        "click_id",
        tp.in_test_hh("hour", "rare_last").alias("rare_last"),
        tp.in_test_hh("hour", "other_last").alias("other_last"),
    )


# --- per-group features: one query per key list --------------------------------------------------------


def attach(name: str, feature: f.Feature, sql: str, digits: int | None = None) -> None:
    """Register the query that attaches one feature to every click."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = f.add_features(timed(spark, folder), [feature]).select("click_id", feature.name)
        return rounded(df, feature.name, digits=digits) if digits else df

    value = f"round({sql}, {digits})" if digits else sql
    register(name, run, f"SELECT click_id, {value} AS {feature.name} FROM timed")


def over(keys: Sequence[str], order: bool = False) -> str:
    return f"(PARTITION BY {', '.join(keys)}{' ORDER BY click_time, click_id' if order else ''})"


for keys in keysets.SIZES:
    attach(f"count_{'_'.join(keys)}", f.group_size(keys), f"count(*) OVER {over(keys)}")

for column, keys in keysets.USER_SIZES.items():
    label = column.removesuffix("Count").lower()
    attach(f"count_{label}", f.group_size(keys, column), f"count(*) OVER {over(keys)}")

for column, keys in keysets.ADDED_SIZES.items():
    attach(f"addcount_{column}", f.group_size(keys, column), f"count(*) OVER {over(keys)}")

for column, keys in keysets.CHANNEL_COUNTS.items():
    attach(column, f.non_null_count(keys, "channel", column), f"count(channel) OVER {over(keys)}")

for keys, counted in keysets.DISTINCT_COUNTS:
    attach(
        f"countuniq_{'_'.join(keys)}_{counted}",
        f.distinct_count(keys, counted),
        f"count(DISTINCT {counted}) OVER {over(keys)}",
    )

for keys, counted in keysets.MEANS:
    attach(f"mean_{'_'.join(keys)}_{counted}", f.group_mean(keys, counted), f"avg({counted}) OVER {over(keys)}", 6)

for keys, counted in keysets.VARIANCES:
    attach(
        f"var_{'_'.join(keys)}_{counted}", f.group_variance(keys, counted), f"var_samp({counted}) OVER {over(keys)}", 6
    )

for keys, counted in keysets.RUNNING_COUNTS:
    attach(
        f"cumcount_{'_'.join(keys)}",
        f.running_count(keys, counted),
        f"CAST(row_number() OVER {over(keys, True)} - 1 AS BIGINT)",
    )

for name, column, keys in (
    ("rank_usrapp", "UsrappRank", ["ip", "app", "device", "os"]),
    ("rank_usr", "UsrRank", ["ip", "os", "device"]),
):
    attach(
        name, f.running_count(keys, name=column, base=1), f"CAST(row_number() OVER {over(keys, True)} AS BIGINT)"
    )


def gap_sql(earlier: str, later: str, mode: str = "component", fill: bool = False) -> str:
    if mode == "component":
        whole = f"CAST(floor(({later} - {earlier}) / CAST(1000000 AS DOUBLE)) AS BIGINT)"
        value = f"(({whole} % 86400) + 86400) % 86400"
    elif mode == "epoch":
        value = (
            f"CAST(floor({later} / CAST(1000000 AS DOUBLE)) AS BIGINT)"
            f" - CAST(floor({earlier} / CAST(1000000 AS DOUBLE)) AS BIGINT)"
        )
    else:
        value = f"({later} - {earlier}) / CAST(1000000 AS DOUBLE)"
    return f"coalesce({value}, 0)" if fill else value


NOW = "epoch_us(click_time)"


def lead(keys: Sequence[str]) -> str:
    return f"lead({NOW}) OVER {over(keys, True)}"


def lag(keys: Sequence[str]) -> str:
    return f"lag({NOW}) OVER {over(keys, True)}"


for keys in keysets.NEXT_CLICKS:
    attach(f"next_click_{'_'.join(keys)}", f.next_gap(keys), gap_sql(NOW, lead(keys)))

for keys in keysets.PREVIOUS_CLICKS:
    attach(f"prev_click_{'_'.join(keys)}", f.previous_gap(keys), gap_sql(lag(keys), NOW))

_USER = ["ip", "app", "device", "os"]
attach("next_click_epoch", f.next_gap(_USER, "nextClick", mode="epoch"), gap_sql(NOW, lead(_USER), "epoch"))
attach(
    "prev_click_signed", f.previous_gap(_USER, "prevClick", mode="epoch", sign=-1), gap_sql(NOW, lag(_USER), "epoch")
)


def gaps_filled(kind: str, lists: dict[str, Sequence[str]]) -> None:
    """Several gap features in seconds, 0 where there is no neighbour."""
    make = f.next_gap if kind == "next" else f.previous_gap
    wanted = [make(keys, name, mode="total", fill=0) for name, keys in lists.items()]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f.add_features(timed(spark, folder), wanted).select("click_id", *lists)

    values = [
        (gap_sql(NOW, lead(k), "total", True) if kind == "next" else gap_sql(lag(k), NOW, "total", True)) + f" AS {n}"
        for n, k in lists.items()
    ]
    register(f"{kind}_click_fill0", run, f"SELECT click_id, {', '.join(values)} FROM timed")


gaps_filled("next", keysets.NEXT_CLICKS_FILLED)
gaps_filled("prev", keysets.PREVIOUS_CLICKS_FILLED)


@query(
    "next_click_hashed",
    f"""WITH hashed AS (SELECT *, CAST(epoch_us(click_time) // 1000000 AS BIGINT) AS t,
          CAST(('0x' || substr(md5(concat_ws('_', ip, app, device, os)), 1, 7)) AS BIGINT) % 67108864 AS category FROM clicks),
        gaps AS (SELECT *, coalesce(lead(t) OVER {over(['category'], True)}, 3000000000) - t AS g FROM hashed)
        SELECT click_id, category, g AS "nextClick", lag(g) OVER (ORDER BY click_time, click_id) AS "nextClick_shift" FROM gaps""",
)
def _(spark, folder):
    return pipelines.hashed_next_click(views.clicks(spark, folder))


# --- composite jobs: every value is checked ---------------------------------------------------------

_IDO = ["ip", "device", "os"]


def _uniq(keys: Sequence[str], c: str) -> str:
    return f"count(DISTINCT {c}) OVER {over(keys)} AS {'_'.join(keys)}_by_{c}_countuniq"


def _size(keys: Sequence[str], name: str | None = None) -> str:
    return f"count(*) OVER {over(keys)} AS {name or '_'.join(keys) + 'count'}"


_LGB = [
    f"{gap_sql(NOW, lead(['ip', 'os', 'device', 'app']))} AS ip_os_device_app_nextClick",
    f"{gap_sql(lag(['ip', 'channel']), NOW)} AS ip_channel_prevClick",
    _uniq(["ip"], "channel"),
    _uniq(_IDO, "app"),
    f"round(avg(app) OVER {over(_IDO)}, 6) AS ip_device_os_by_app_mean",
    _uniq(["ip", "day"], "hour"),
    _uniq(["ip"], "app"),
    _uniq(["ip", "app"], "os"),
    _uniq(["ip"], "device"),
    _uniq(["app"], "channel"),
    f"CAST(row_number() OVER {over(['ip'], True)} - 1 AS BIGINT) AS ip_by_os_cumcount",
    f"CAST(row_number() OVER {over(_IDO, True)} - 1 AS BIGINT) AS ip_device_os_by_app_cumcount",
    _size(["ip", "day", "hour"]),
    _size(["ip", "app"]),
    _size(["ip", "app", "os"]),
    _uniq(["os", "device", "app", "channel"], "hour"),
]


@query(
    "features_lgb",
    f"""SELECT click_id, ip, app, device, os, channel, click_time, is_attributed, hour, day, {', '.join(_LGB)} FROM timed""",
)
def _(spark, folder):
    return rounded(pipelines.features_lgb(views.clicks(spark, folder)), "ip_device_os_by_app_mean")


@query(
    "features_prep_data",
    "SELECT click_id, app, device, os, channel, is_attributed, hour, "
    + ", ".join(
        f"count(channel) OVER {over(keys)} AS {name}" for name, keys in keysets.CHANNEL_COUNTS.items()
    )
    + f", CAST(row_number() OVER {over(_USER, True)} - 1 AS BIGINT) AS ip_app_dev_os_cumcount"
    + f", CAST(row_number() OVER {over(_IDO, True)} - 1 AS BIGINT) AS ip_dev_os_cumcount FROM timed",
)
def _(spark, folder):
    return pipelines.features_prep_data(views.clicks(spark, folder))


@query(
    "features_process",
    "SELECT click_id, app, device, os, channel, is_attributed, hour, "
    + ", ".join(_size(keys, name) for name, keys in keysets.WEEKDAY_SIZES.items())
    + " FROM timed",
)
def _(spark, folder):
    return pipelines.features_process(views.clicks(spark, folder))


@query(
    "features_datatable",
    "SELECT click_id, ip, app, device, os, channel, click_time, is_attributed, hour, day, "
    + ", ".join(_size(keys, name) for name, keys in keysets.USER_SIZES.items())
    + f", CAST(row_number() OVER {over(_USER, True)} AS BIGINT) AS UsrappRank"
    + f", CAST(row_number() OVER {over(_IDO, True)} AS BIGINT) AS UsrRank, "
    + ", ".join(f"{gap_sql(NOW, lead(k), 'total', True)} AS {n}" for n, k in keysets.NEXT_CLICKS_FILLED.items())
    + ", "
    + ", ".join(f"{gap_sql(lag(k), NOW, 'total', True)} AS {n}" for n, k in keysets.PREVIOUS_CLICKS_FILLED.items())
    + " FROM timed",
)
def _(spark, folder):
    return pipelines.features_datatable(views.clicks(spark, folder))


_VALUE = "round({}, 6) AS {}"
_SHORT = [
    *[f"count(DISTINCT {c}) OVER {over(keys)} AS {name}" for name, (keys, c) in keysets.SHORT_DISTINCT.items()],
    *[f"CAST(row_number() OVER {over(keys, True)} - 1 AS BIGINT) AS {name}" for name, (keys, _) in keysets.SHORT_RUNNING.items()],
    *[_size(keys, name) for name, keys in keysets.SHORT_SIZES.items()],
    *[_VALUE.format(f"var_samp({c}) OVER {over(keys)}", name) for name, (keys, c) in keysets.SHORT_VARIANCES.items()],
    *[_VALUE.format(f"avg({c}) OVER {over(keys)}", name) for name, (keys, c) in keysets.SHORT_MEANS.items()],
    f"{gap_sql(NOW, lead(_USER), 'epoch')} AS nextClick",
]


@query(
    "features_short",
    f"SELECT click_id, ip, app, device, os, channel, is_attributed, hour, {', '.join(_SHORT)} FROM timed",
)
def _(spark, folder):
    done = pipelines.features_short(views.clicks(spark, folder))
    return rounded(done, *keysets.SHORT_VARIANCES, *keysets.SHORT_MEANS)


_RICH = [
    *[x for x in _LGB if "ip_os_device_app_nextClick" not in x],
    *[f"{gap_sql(NOW, lead(keys))} AS {'_'.join(keys)}_nextClick" for keys in keysets.NEXT_CLICKS],
    *[
        _VALUE.format(f"var_samp({c}) OVER {over(keys)}", f"{'_'.join(keys)}_by_{c}_var")
        for keys, c in keysets.VARIANCES[:3]
    ],
    *[_VALUE.format(f"avg({c}) OVER {over(keys)}", f"{'_'.join(keys)}_by_{c}_mean") for keys, c in keysets.MEANS[1:3]],
]


@query(
    "features_rich",
    f"SELECT click_id, ip, app, device, os, channel, click_time, is_attributed, hour, day, {', '.join(_RICH)} FROM timed",
)
def _(spark, folder):
    done = pipelines.features_rich(views.clicks(spark, folder))
    return rounded(done, *[c for c in done.columns if c.endswith(("_mean", "_var"))])


# --- train and test together or apart -----------------------------------------------------------------


def _scoped(scope: str):
    def build(df: DataFrame, order: Sequence[str]) -> DataFrame:
        return f.add_features(df, [f.group_size(["ip"]), f.running_count(["ip"], "os"), f.next_gap(["ip", "app"])], order)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        train, test = views.click_train(spark, folder), views.test_supplement(spark, folder)
        done = pipelines.over_train_and_test(train, test, build, scope)
        parts = [d.select("click_id", "ipcount", "ip_by_os_cumcount", "ip_app_nextClick") for d in done]
        return append_by_name(parts)

    return run


for _scope in ("union", "separate"):
    _keys = lambda k: f"PARTITION BY {k}{', src_rank' if _scope == 'separate' else ''}"
    _order = "ORDER BY src_rank, click_time, click_id"
    register(
        f"features_scope_{_scope}",
        _scoped(_scope),
        f"""WITH a AS (SELECT click_id, ip, app, click_time, 0 AS src_rank FROM click_train
            UNION ALL SELECT click_id, ip, app, click_time, 1 FROM test_supplement)
            SELECT click_id, src_rank, count(*) OVER ({_keys('ip')}) AS ipcount,
            CAST(row_number() OVER ({_keys('ip')} {_order}) - 1 AS BIGINT) AS ip_by_os_cumcount,
            {gap_sql(NOW, f"lead({NOW}) OVER ({_keys('ip, app')} {_order})")} AS "ip_app_nextClick" FROM a""",
    )


@query(
    "features_lgb_by_day",
    f"""SELECT click_id, ip, app, device, os, channel, click_time, is_attributed, hour, day, {', '.join(_LGB)} FROM timed""",
)
def _(spark, folder):
    """The features of :func:`pipelines.features_lgb`, from a state that took the clicks day by day (here: ten days at a time)."""
    clicks = pipelines.with_hour_and_day(views.clicks(spark, folder))
    state = FeatureState(spark, scratch_folder(spark), pipelines.LGB_FEATURES)
    days = F.floor(F.datediff("click_time", F.lit("2024-01-01")) / 10)
    return rounded(by_days(state, clicks, days).features(), "ip_device_os_by_app_mean")


_APP_DAYS = ["app", "date"]


@query(
    "sketch_distinct_of_days",
    """SELECT app, count(DISTINCT ip) AS exact, true AS same_as_whole, true AS near FROM clicks GROUP BY app""",
)
def _(spark, folder):
    """Visitors per app from the sketches of single days: the same estimate as over the whole table, within three standard errors."""
    clicks = views.clicks(spark, folder).withColumn("date", F.to_date("click_time"))
    days = sk.merged(sk.daily_sketches(clicks, _APP_DAYS, distinct="ip"), ["app"]).select("app", sk.distinct_estimate().alias("days"))
    whole = sk.daily_sketches(clicks, ["app"], distinct="ip").select("app", sk.distinct_estimate().alias("whole"))
    exact = clicks.groupBy("app").agg(F.count_distinct("ip").alias("exact"))
    reach = 3 * 1.04 / 2 ** (sk.LG / 2)
    near = F.abs(F.col("days") - F.col("exact")) <= F.greatest(F.lit(1.0), reach * F.col("exact"))
    both = days.join(whole, "app").join(exact, "app")
    return both.select("app", "exact", (F.col("days") == F.col("whole")).alias("same_as_whole"), near.alias("near"))


@query(
    "sketch_quantiles_of_days",
    """SELECT app, p, count(*) AS n, true AS near FROM clicks, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS p) GROUP BY app, p""",
)
def _(spark, folder):
    """Quantiles of the channel per app from the sketches of single days: their exact ranks are off by 2 % at most."""
    clicks = views.clicks(spark, folder).withColumn("date", F.to_date("click_time"))
    wanted = (0.05, 0.25, 0.5, 0.75, 0.95)
    merged = sk.merged(sk.daily_sketches(clicks, _APP_DAYS, numeric="channel"), ["app"])
    values = F.arrays_zip(F.array(*map(F.lit, wanted)).alias("p"), sk.quantile_estimates(wanted).alias("value"))
    found = merged.select("app", F.explode(values).alias("v")).select("app", "v.p", "v.value")
    ranks = clicks.join(F.broadcast(found), "app").groupBy("app", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.expr("channel < value")).alias("below"), F.count_if(F.expr("channel <= value")).alias("upto")
    )
    near = (F.col("below") / F.col("n") <= F.col("p") + 0.02) & (F.col("upto") / F.col("n") >= F.col("p") - 0.02)
    return ranks.select("app", "p", "n", near.alias("near"))
