"""Relations between operators that hold on any data."""

import datetime as dt

from folders import SMALL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from eventloom import views
from eventloom.operators import evaluate as ev
from eventloom.operators import features as f
from eventloom.operators import sampling as sa


def test_running_count_reaches_group_size(spark):
    df = f.add_features(views.clicks(spark, SMALL), [f.group_size(["ip"], "n"), f.running_count(["ip"], name="r")])
    bad = df.groupBy("ip").agg((F.max("r") + 1 != F.max("n")).alias("bad")).filter("bad")
    assert bad.count() == 0


def test_distinct_count_is_at_most_group_size(spark):
    df = f.add_features(
        views.clicks(spark, SMALL), [f.group_size(["ip"], "n"), f.distinct_count(["ip"], "channel", "d")]
    )
    assert df.filter("d > n OR d < 1").count() == 0


def test_next_gap_is_the_previous_gap_of_the_next_row(spark):
    df = f.add_features(
        views.clicks(spark, SMALL),
        [f.next_gap(["ip"], "a"), f.previous_gap(["ip"], "b"), f.running_count(["ip"], name="r")],
    ).select("ip", "a", "b", "r")
    later = df.select("ip", (F.col("r") - 1).alias("r"), F.col("b").alias("c"))
    joined = df.join(later, ["ip", "r"])
    assert joined.count() > 0 and joined.filter("a <> c").count() == 0


def test_balance_gives_equal_classes(spark):
    sizes = [r["count"] for r in sa.balance(views.clicks(spark, SMALL), "click_id", "app").groupBy("app").count().collect()]
    assert len(sizes) == 5 and len(set(sizes)) == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(some.lists(some.tuples(some.integers(0, 1), some.integers(1, 9)), min_size=4, max_size=40))
def test_auc_equals_pair_counting(spark, pairs):
    pairs = [(0, 3), (1, 5), *pairs]
    df = spark.createDataFrame([(y, p / 10) for y, p in pairs], "y int, p double")
    wins = [(a > b) + (a == b) / 2 for y, a in pairs if y for z, b in pairs if not z]
    assert abs(ev.auc(df, "y", "p").first().auc - sum(wins) / len(wins)) < 1e-12


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    some.lists(some.tuples(some.integers(0, 2), some.integers(0, 3), some.integers(0, 50)), min_size=1, max_size=60),
    some.sampled_from(["1", "5", "1000"]),
)
def test_features_equal_a_plain_computation(spark, rows, group_rows):
    """Ordinary, split and mixed plans against a loop over the rows."""
    start = dt.datetime(2024, 1, 1)
    data = [(i, ip, app, start + dt.timedelta(seconds=s)) for i, (ip, app, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "click_id long, ip long, app long, click_time timestamp_ntz")
    spark.conf.set("eventloom.groupRows", group_rows)
    try:
        got = f.add_features(
            df,
            [
                f.running_count(["ip"], name="r"),
                f.next_gap(["ip", "app"], "g", mode="epoch"),
                f.distinct_count(["ip"], "app", "d"),
                f.group_size(["ip", "app"], "n"),
            ],
        ).collect()
    finally:
        spark.conf.unset("eventloom.groupRows")
    assert len(got) == len(data)
    ordered = sorted(data, key=lambda r: (r[3], r[0]))
    for r in got:
        mine = [x for x in ordered if x[1] == r.ip]
        same = [x for x in mine if x[2] == r.app]
        place = [x[0] for x in same].index(r.click_id)
        following = same[place + 1 :]
        assert r.r == [x[0] for x in mine].index(r.click_id)
        assert r.g == ((following[0][3] - same[place][3]).total_seconds() if following else None)
        assert r.d == len({x[2] for x in mine})
        assert r.n == len(same)
