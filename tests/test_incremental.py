"""Features of a growing table against one run over all of it, and sketches of days against those of the whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import features as f
from eventloom.operators import sketches as sk
from eventloom.plans.incremental import FeatureState

SCHEMA = "click_id long, ip long, app int, channel int, click_time timestamp_ntz"
START = dt.datetime(2024, 3, 1)
WANTED = [
    f.group_size(["ip"], "n"),
    f.group_size(["ip", "app"], "narrow", narrow_bits=2),
    f.non_null_count(["ip"], "channel", "known"),
    f.group_mean(["app"], "channel", "mean"),
    f.distinct_count(["ip"], "channel", "channels"),
    f.running_count(["ip"], "app", "r0"),
    f.running_count(["ip", "app"], name="r1", base=1),
    f.next_gap(["ip"], "next"),
    f.next_gap(["ip", "app"], "total", mode="total", fill=-1.0),
    f.previous_gap(["ip"], "before", mode="epoch"),
    f.previous_gap(["ip", "app"], "minus", mode="total", sign=-1),
]


def day_rows(draw, day, count, first):
    """A hot address, a null one, and times that repeat within a day."""
    out = []
    for i in range(count):
        ip = 7 if draw.random() < 0.4 else draw.choice([None, 1, 2, 3, 4, 5])
        when = START + dt.timedelta(days=day, seconds=draw.randrange(3000), microseconds=draw.randrange(3) * 250_000)
        out.append((first + i, ip, draw.randrange(3), draw.choice([None, 1, 2, 3]), when))
    return out


def values(frame):
    names = sorted(frame.columns)
    return sorted(map(str, (tuple(r[n] for n in names) for r in frame.collect())))


def days_of(seed, sizes=(60, 40, 0, 70, 30)):
    draw = random.Random(seed)
    return [day_rows(draw, d, n, 1000 * d) for d, n in enumerate(sizes)]


@pytest.mark.parametrize("groups", ["ordinary", "small"])
def test_days_equal_one_run(spark, tmp_path, request, groups):
    if groups == "small":
        request.getfixturevalue("small_groups")  # the hot address is cut into pieces, within a day and in the single run
    days = days_of(1)
    state = FeatureState(spark, f"file://{tmp_path}", WANTED)
    for i, rows in enumerate(days):
        assert state.add(spark.createDataFrame(rows, SCHEMA)) == i + 1
        if i in (0, 3, 4):
            so_far = spark.createDataFrame([r for d in days[: i + 1] for r in d], SCHEMA)
            assert values(state.features()) == values(f.add_features(so_far, WANTED, ["click_time", "click_id"]))


def test_a_day_that_failed_is_repeated(spark, tmp_path):
    days = days_of(2, (30, 20))
    folder = f"file://{tmp_path}"
    state = FeatureState(spark, folder, WANTED)
    state.add(spark.createDataFrame(days[0], SCHEMA))
    # What a day leaves behind that stopped half way: some tables of the next version, but not the last one.
    spark.createDataFrame([(1,)], "odd int").write.parquet(f"{folder}/000002/last0")
    again = FeatureState(spark, folder, WANTED)
    assert again.version() == 1
    assert again.add(spark.createDataFrame(days[1], SCHEMA)) == 2
    whole = spark.createDataFrame(days[0] + days[1], SCHEMA)
    assert values(again.features()) == values(f.add_features(whole, WANTED, ["click_time", "click_id"]))
    with pytest.raises(ValueError, match="later"):
        again.add(spark.createDataFrame(days[0], SCHEMA))
    with pytest.raises(ValueError, match="variance"):
        FeatureState(spark, folder, [f.group_variance(["ip"], "channel")])
    with pytest.raises(ValueError, match="no day"):
        FeatureState(spark, f"{folder}/none", WANTED).features()


def test_only_closings_are_written_for_earlier_rows(spark, tmp_path):
    """A later day adds one record for each key that appears again, and never rewrites rows."""
    state = FeatureState(spark, f"file://{tmp_path}", [f.next_gap(["ip"], "next")])
    base = [(i, i % 5, 0, 1, START + dt.timedelta(seconds=i)) for i in range(50)]
    state.add(spark.createDataFrame(base, SCHEMA))
    state.add(spark.createDataFrame([(100, 2, 0, 1, START + dt.timedelta(days=1)), (101, 9, 0, 1, START + dt.timedelta(days=1))], SCHEMA))
    closed = spark.read.parquet(f"file://{tmp_path}/000002/closed0").collect()
    assert [r.click_id for r in closed] == [47]
    assert spark.read.parquet(f"file://{tmp_path}/000002/rows").count() == 2


def test_sketches_of_days_and_of_the_whole(spark):
    draw = random.Random(5)
    rows = [(d, g, None if g == "none" else draw.randrange(20_000), draw.gauss(0, 1)) for d in range(6) for g in ("a", "b", "none") for _ in range(3000)]
    frame = spark.createDataFrame(rows, "day int, g string, v long, x double").repartition(5)
    days = sk.daily_sketches(frame, ["day", "g"], "v", "x")
    merged = {r.g: r for r in sk.merged(days, ["g"]).select("g", sk.distinct_estimate().alias("n"), sk.quantile_estimates((0.1, 0.5, 0.9)).alias("q")).collect()}
    whole = {r.g: r.n for r in sk.daily_sketches(frame.coalesce(1), ["g"], "v").select("g", sk.distinct_estimate().alias("n")).collect()}
    half = sk.merged(sk.merged(days.where("day < 2"), ["g"]).unionByName(sk.merged(days.where("day >= 2"), ["g"])), ["g"])
    halves = {r.g: r.n for r in half.select("g", sk.distinct_estimate().alias("n")).collect()}
    for g in ("a", "b", "none"):
        exact = len({v for _, k, v, _ in rows if k == g and v is not None})
        assert merged[g].n == whole[g] == halves[g]
        assert abs(merged[g].n - exact) <= 0.05 * exact
        own = sorted(x for _, k, _, x in rows if k == g)
        for p, q in zip((0.1, 0.5, 0.9), merged[g].q, strict=True):
            assert abs(sum(x <= q for x in own) / len(own) - p) < 0.025
    empty = sk.daily_sketches(frame.where("g = 'none'").withColumn("x", F.lit(None).cast("double")), ["g"], "v", "x")
    only = empty.select(sk.distinct_estimate().alias("n"), sk.quantile_estimates((0.5,)).alias("q")).first()
    assert only.n == 0 and only.q is None


def test_rows_are_joined_for_the_longest_key_lists_only(spark, tmp_path):
    """Sums and distinct values of fewer keys join those of more; distinct values that another table holds are not kept again."""
    wanted = [
        f.group_size(["ip", "app", "channel"], "n"), f.group_size(["ip", "app"], "m"), f.distinct_count(["ip"], "app", "apps"),
        f.distinct_count(["app"], "channel", "channels"), f.distinct_count(["ip"], "channel", "of_ip"), f.group_mean(["ip"], "channel", "mean"),
        f.running_count(["ip", "app"], name="r"), f.previous_gap(["app", "ip"], "before", mode="epoch"), f.next_gap(["ip"], "next"),
    ]
    days = days_of(3)
    state = FeatureState(spark, f"file://{tmp_path}", wanted)
    for rows in days:
        state.add(spark.createDataFrame(rows, SCHEMA))
    so_far = spark.createDataFrame([r for d in days for r in d], SCHEMA)
    assert values(state.features()) == values(f.add_features(so_far, wanted, ["click_time", "click_id"]))
    assert len(state.ordered) == 2 and [keys for keys, _ in state._sides(len(days))] == [("app", "channel", "ip")]
    kept = {p.name for p in tmp_path.glob("000005/*")}
    assert {n for n in kept if n.startswith("distinct")} == {f"distinct{state.distinct.index((('app',), 'channel'))}", f"distinct{state.distinct.index((('ip',), 'channel'))}"}
