"""Composite feature jobs, each one call."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.timeparts import day_of, epoch_seconds, hour_of, in_test_hh, weekday_no
from eventloom.operators import features as f
from eventloom.operators.ordered import Ordered, ordered_columns
from eventloom.operators.relational import append_by_name, split_back
from eventloom.operators.visits import bridge_table, number_visits, unpack_scans
from eventloom.plans import keysets

# Total orders of a click log, and of several appended logs.
CLICK_ORDER = ("click_time", "click_id")
APPENDED_ORDER = ("src_rank", "click_time", "click_id")

# The key lists and names of the feature sets below are fixed values: trained models and submission
# scripts refer to the columns by these names.
IP_DEVICE_OS = ("ip", "device", "os")


#: Columns of the boosted-tree scripts; the clicks need ``hour`` and ``day``.
LGB_FEATURES = (
    f.next_gap(["ip", "os", "device", "app"]),
    f.previous_gap(["ip", "channel"]),
    f.distinct_count(["ip"], "channel"),
    f.distinct_count(IP_DEVICE_OS, "app"),
    f.group_mean(IP_DEVICE_OS, "app"),
    f.distinct_count(["ip", "day"], "hour"),
    f.distinct_count(["ip"], "app"),
    f.distinct_count(["ip", "app"], "os"),
    f.distinct_count(["ip"], "device"),
    f.distinct_count(["app"], "channel"),
    f.running_count(["ip"], "os"),
    f.running_count(IP_DEVICE_OS, "app"),
    f.group_size(["ip", "day", "hour"]),
    f.group_size(["ip", "app"]),
    f.group_size(["ip", "app", "os"]),
    f.distinct_count(["os", "device", "app", "channel"], "hour"),
)


def with_hour_and_day(clicks: DataFrame) -> DataFrame:
    return clicks.withColumns({"hour": hour_of("click_time"), "day": day_of("click_time")})


def features_lgb(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """Gap, distinct-count, mean, running-count and size features of the boosted-tree scripts."""
    return f.add_features(with_hour_and_day(clicks), LGB_FEATURES, order)


def features_prep_data(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """Count features by key, day and hour with two running counts; the raw keys are dropped."""
    base = clicks.withColumns({"hour": hour_of("click_time"), "day": day_of("click_time")})
    base = base.withColumn("in_test_hh", in_test_hh("hour"))
    wanted = [f.non_null_count(keys, "channel", name) for name, keys in keysets.CHANNEL_COUNTS.items()]
    wanted += [
        f.running_count(["ip", "app", "device", "os"], name="ip_app_dev_os_cumcount"),
        f.running_count(IP_DEVICE_OS, name="ip_dev_os_cumcount"),
    ]
    return f.add_features(base, wanted, order).drop("click_time", "in_test_hh", "day", "ip")


def features_process(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """Count features by key, weekday and hour."""
    base = clicks.withColumns({"wday": weekday_no("click_time"), "hour": hour_of("click_time")})
    base = base.withColumn("in_test_hh", in_test_hh("hour"))
    sizes = [f.group_size(keys, name) for name, keys in keysets.WEEKDAY_SIZES.items()]
    done = f.add_features(base, sizes, order)
    return done.drop("click_time", "in_test_hh", "wday", "ip")


def features_datatable(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """Sizes, positions from 1 and gaps in seconds with 0 where there is no neighbour."""
    base = clicks.withColumns({"hour": hour_of("click_time"), "day": day_of("click_time")})
    gap = {"mode": "total", "fill": 0}
    return f.add_features(
        base,
        [
            *[f.group_size(keys, name) for name, keys in keysets.USER_SIZES.items()],
            f.running_count(["ip", "app", "device", "os"], name="UsrappRank", base=1),
            f.running_count(["ip", "os", "device"], name="UsrRank", base=1),
            *[f.next_gap(keys, name, **gap) for name, keys in keysets.NEXT_CLICKS_FILLED.items()],
            *[f.previous_gap(keys, name, **gap) for name, keys in keysets.PREVIOUS_CLICKS_FILLED.items()],
        ],
        order,
    )


def features_short(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """The set with short names: distinct and running counts, sizes, variances, a mean, and the time to the next
    click of the same user in whole seconds. Time and day are dropped."""
    base = clicks.withColumns({"hour": hour_of("click_time"), "day": day_of("click_time")})
    done = f.add_features(
        base,
        [
            *[f.distinct_count(keys, c, name) for name, (keys, c) in keysets.SHORT_DISTINCT.items()],
            *[f.running_count(keys, c, name) for name, (keys, c) in keysets.SHORT_RUNNING.items()],
            *[f.group_size(keys, name) for name, keys in keysets.SHORT_SIZES.items()],
            *[f.group_variance(keys, c, name) for name, (keys, c) in keysets.SHORT_VARIANCES.items()],
            *[f.group_mean(keys, c, name) for name, (keys, c) in keysets.SHORT_MEANS.items()],
            f.next_gap(["ip", "app", "device", "os"], "nextClick", mode="epoch"),
        ],
        order,
    )
    return done.drop("click_time", "day")


def features_rich(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """:func:`features_lgb` with ten lists for the next click, three variances and two more means."""
    done = features_lgb(clicks, order)
    made = {"_".join(keys) + "_nextClick" for keys in keysets.NEXT_CLICKS} & set(done.columns)
    base = done.drop(*made)
    return f.add_features(
        base,
        [
            *[f.next_gap(keys) for keys in keysets.NEXT_CLICKS],
            *[f.group_variance(keys, c) for keys, c in keysets.VARIANCES[:3]],
            *[f.group_mean(keys, c) for keys, c in keysets.MEANS[1:3]],
        ],
        order,
    )


def over_train_and_test(
    train: DataFrame, test: DataFrame, build: Callable[[DataFrame, Sequence[str]], DataFrame], scope: str = "union"
) -> tuple[DataFrame, DataFrame]:
    """Features of both tables, counted over train and test together or over each on its own.

    ``build`` takes a click table and its total order. With scope ``union`` all training rows come
    before all test rows, as in one appended file.
    """
    if scope == "separate":
        return build(train, CLICK_ORDER), build(test, CLICK_ORDER)
    if scope != "union":
        raise ValueError(scope)
    both = build(append_by_name([train, test]), APPENDED_ORDER)
    return split_back(both, 0), split_back(both, 1)


def scan_features(scans: DataFrame, visits: int | None = None) -> DataFrame:
    """From packed scans to bridge, band and mean signal per (place, access point), over all visits.

    Visits are numbered while they are still packed, so the unpacked readings are only aggregated.
    ``visits`` limits the work to the first visits of a place.
    """
    numbered = number_visits(scans)
    if visits is not None:
        numbered = numbered.filter(F.col("visit_no") <= visits)
    return bridge_table(unpack_scans(numbered))


# Size of the hash space, and the time that stands for "no later click".
HASH_SPACE = 2**26
FAR_FUTURE = 3_000_000_000


def hashed_next_click(clicks: DataFrame, order: Sequence[str] = CLICK_ORDER) -> DataFrame:
    """Seconds to the next click of the same hashed user, and the same value of the row before.

    Users share a slot when their hashes collide, which is part of the feature. The shift runs over
    the whole table in order.
    """
    user = F.md5(F.concat_ws("_", "ip", "app", "device", "os"))
    base = clicks.select(
        *dict.fromkeys(["click_id", *order]),
        F.pmod(F.conv(F.substring(user, 1, 7), 16, 10).cast("bigint"), F.lit(HASH_SPACE)).alias("category"),
        epoch_seconds("click_time").alias("__epoch"),
    )
    following = ordered_columns(base, ["category"], list(order), [Ordered("lead", "__next", "__epoch")])
    gap = F.coalesce(F.col("__next"), F.lit(FAR_FUTURE)) - F.col("__epoch")
    gaps = following.withColumn("nextClick", gap)
    shifted = ordered_columns(gaps, [], list(order), [Ordered("lag", "nextClick_shift", "nextClick")])
    return shifted.select("click_id", "category", "nextClick", "nextClick_shift")
