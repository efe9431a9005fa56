"""Hand-written rows for the rules that the generated tables do not exercise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.functions import text
from eventloom.functions import timeparts as tp
from eventloom.operators import features as f
from eventloom.operators import relational as rel
from eventloom.operators import sampling as sa
from eventloom.operators import stats as st
from eventloom.operators import visits as v

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def clicks(spark, offsets, ip=1):
    """One row per (seconds after T0), numbered in the given order."""
    rows = [(i, ip, T0 + dt.timedelta(seconds=s)) for i, s in enumerate(offsets)]
    return spark.createDataFrame(rows, "click_id long, ip long, click_time timestamp_ntz")


def column(df, name, order="click_id"):
    return [r[name] for r in df.orderBy(order).collect()]


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


# --- gaps -------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "mode, seconds, expected",
    [
        ("component", 86400.3, 0),  # whole seconds modulo one day
        ("component", -0.3, 86399),  # a negative gap wraps
        ("component", 5.9, 5),
        ("epoch", 86400.3, 86400),
        ("total", 86400.3, 86400.3),
        ("total", -0.3, -0.3),
    ],
)
def test_gap_modes(spark, mode, seconds, expected):
    start, end = F.lit(0), F.lit(round(seconds * 1_000_000))
    assert value(spark, tp.gap_seconds(start, end, mode)) == pytest.approx(expected)


def test_epoch_mode_truncates_before_subtracting(spark):
    df = f.add_features(clicks(spark, [0.9, 1.1]), [f.next_gap(["ip"], "gap", mode="epoch")])
    assert column(df, "gap") == [1, None]


def test_previous_gap_signs_and_fill(spark):
    df = f.add_features(
        clicks(spark, [0, 10, 25]),
        [
            f.previous_gap(["ip"], "plus"),
            f.previous_gap(["ip"], "minus", mode="epoch", sign=-1),
            f.previous_gap(["ip"], "filled", mode="total", fill=0),
        ],
    )
    assert column(df, "plus") == [None, 10, 15]
    assert column(df, "minus") == [None, -10, -15]
    assert column(df, "filled") == [0.0, 10.0, 15.0]


def test_gap_follows_the_given_order_not_time(spark):
    # rows in file order, the second one earlier than the first: the gap wraps
    df = f.add_features(clicks(spark, [100, 40, 50]), [f.next_gap(["ip"], "gap")], order=["click_id"])
    assert column(df, "gap") == [86340, 10, None]


def test_tied_times_are_ordered_by_id(spark):
    df = f.add_features(clicks(spark, [5, 5, 5]), [f.running_count(["ip"], name="n"), f.next_gap(["ip"], "gap")])
    assert column(df, "n") == [0, 1, 2]
    assert column(df, "gap") == [0, 0, None]


# --- counts -----------------------------------------------------------------------------------------


@pytest.fixture
def keyed(spark):
    rows = [(1, 1, 10, 5), (2, 1, 10, None), (3, 1, 20, 5), (4, 2, None, 7), (5, None, 30, 7), (6, None, 30, None)]
    df = spark.createDataFrame(rows, "click_id long, ip long, app long, channel long")
    return df.withColumn("click_time", F.lit(T0).cast("timestamp_ntz"))


@pytest.mark.parametrize("group_rows", [None, "1"])
def test_counts_with_missing_values(spark, keyed, group_rows):
    if group_rows:
        spark.conf.set("eventloom.groupRows", group_rows)
    try:
        df = f.add_features(
            keyed,
            [
                f.group_size(["ip"], "size"),
                f.non_null_count(["ip"], "channel", "filled"),
                f.distinct_count(["ip"], "app", "apps"),
                f.distinct_count(["ip", "app"], "channel", "channels"),
                f.group_mean(["ip"], "app", "mean"),
                f.group_variance(["ip"], "app", "var"),
                f.running_count(["ip"], name="before", base=0),
                f.running_count(["ip"], name="place", base=1),
            ],
        ).collect()
    finally:
        spark.conf.unset("eventloom.groupRows")
    got = {r["click_id"]: r for r in df}
    assert [got[i]["size"] for i in range(1, 7)] == [3, 3, 3, 1, 2, 2]  # NULL keys form a group
    assert [got[i]["filled"] for i in range(1, 7)] == [2, 2, 2, 1, 1, 1]
    assert [got[i]["apps"] for i in range(1, 7)] == [2, 2, 2, 0, 1, 1]
    assert [got[i]["channels"] for i in range(1, 7)] == [1, 1, 1, 1, 1, 1]
    assert got[1]["mean"] == pytest.approx(40 / 3)
    assert got[1]["var"] == pytest.approx(100 / 3)
    assert got[4]["var"] is None  # a group of one value has no sample variance
    assert [got[i]["before"] for i in range(1, 7)] == [0, 1, 2, 0, 0, 1]
    assert [got[i]["place"] for i in range(1, 7)] == [1, 2, 3, 1, 1, 2]


def test_narrow_bits_wrap(spark):
    df = f.add_features(clicks(spark, range(5)), [f.group_size(["ip"], "n", narrow_bits=2)])
    assert column(df, "n") == [1] * 5


def test_feature_names():
    assert f.next_gap(["ip", "os"]).name == "ip_os_nextClick"
    assert f.previous_gap(["ip"]).name == "ip_prevClick"
    assert f.group_size(["ip", "app"]).name == "ip_appcount"
    assert f.distinct_count(["ip"], "app").name == "ip_by_app_countuniq"
    assert f.running_count(["ip"], "os").name == "ip_by_os_cumcount"
    assert f.group_mean(["ip"], "app").name == "ip_by_app_mean"
    assert f.group_variance(["ip"], "app").name == "ip_by_app_var"


# --- time and text ----------------------------------------------------------------------------------


def test_shift_crosses_midnight_and_month_end(spark):
    late = F.lit(dt.datetime(2024, 1, 31, 20, 0, 0)).cast("timestamp_ntz")
    shifted = tp.shift_hours(late, 8)
    assert value(spark, tp.hour_of(shifted)) == 4
    assert value(spark, tp.day_of(shifted)) == 1


def test_parse_timestamp_keeps_bad_text_missing(spark):
    assert value(spark, tp.parse_timestamp(F.lit("not a time"))) is None
    assert value(spark, tp.parse_timestamp(F.lit("2024-01-02 03:04:05"))) is not None


def test_weekday_starts_on_monday(spark):
    assert value(spark, tp.weekday_no(F.lit(dt.date(2024, 1, 1)))) == 1
    assert value(spark, tp.weekday_no(F.lit(dt.date(2024, 1, 7)))) == 7


@pytest.mark.parametrize("hour, first, second", [(4, 1, 1), (11, 3, 2), (0, 2, 3)])
def test_bucket_codings(spark, hour, first, second):
    assert value(spark, tp.in_test_hh(F.lit(hour), "rare_last")) == first
    assert value(spark, tp.in_test_hh(F.lit(hour), "other_last")) == second


@pytest.mark.parametrize("given, expected", [("12", 12), ("1,234", 1234), ("1,234,567", None), ("x", None)])
def test_first_comma_only(spark, given, expected):
    assert value(spark, text.strip_first_comma(F.lit(given))) == expected


@pytest.mark.parametrize("given, expected", [("1 min 2.5 sec", 62.5), ("7.25 sec", 7.25), ("2 min", 120.0), ("soon", None)])
def test_durations(spark, given, expected):
    assert value(spark, text.parse_duration(F.lit(given))) == expected


def test_unknown_label_level_is_missing(spark):
    assert value(spark, text.recode_label(F.lit("pass"))) == 1
    assert value(spark, text.recode_label(F.lit("draw"))) is None


# --- scans ------------------------------------------------------------------------------------------


@pytest.fixture
def packed(spark):
    rows = [
        (1, 0, "b1,s,-40,2412,b2,s,-50,5180"),
        (2, 0, "b3,s,-60,2412"),  # one access point
        (3, 0, "b4,s,-61,2412,b5,s"),  # incomplete tail
        (4, 1, "b6\ts\t-62\t2412\tx\tb7\ts\t-63\t5180\tx \t"),  # trailing separator
        (5, 1, "b8\ts\tweak\t2412\tx"),  # unreadable number
        (6, 0, ""),
    ]
    return spark.createDataFrame(rows, "visit long, type int, wifi string")


def test_unpack(packed):
    got = [(r.visit, r.pos, r.bssid, r.rssi, r.frequency) for r in v.unpack_scans(packed).orderBy("visit", "pos").collect()]
    assert got == [
        (1, 1, "b1", -40, 2412),
        (1, 2, "b2", -50, 5180),
        (2, 1, "b3", -60, 2412),
        (3, 1, "b4", -61, 2412),
        (4, 1, "b6", -62, 2412),
        (4, 2, "b7", -63, 5180),
        (5, 1, "b8", None, 2412),
    ]


def test_unpack_drops_single_scans_on_request(packed):
    assert {r.visit for r in v.unpack_scans(packed, drop_single=True).collect()} == {1, 4}


def test_leftover_fields(packed):
    got = {r.visit: r.leftover for r in v.leftover_fields(packed).collect()}
    assert got == {1: 0, 2: 0, 3: 2, 4: 0, 5: 0, 6: 0}


def test_even_moving_average_leans_forward_and_misses_edges(spark):
    rows = [(1, i, float(i * i)) for i in range(8)]
    df = spark.createDataFrame(rows, "pid int, n int, x double")
    got = column(v.centred_mean(df, ["pid"], ["n"], [("x", 4, "m")]), "m", "n")
    # one row before, two rows after
    assert got == [None, *[sum(float(k * k) for k in range(i - 1, i + 3)) / 4 for i in range(1, 6)], None, None]


def test_moving_average_is_missing_where_a_value_is(spark):
    rows = [(1, i, None if i == 3 else 1.0) for i in range(8)]
    df = spark.createDataFrame(rows, "pid int, n int, x double")
    assert column(v.centred_mean(df, ["pid"], ["n"], [("x", 3, "m")]), "m", "n") == [None, 1.0, None, None, None, 1.0, 1.0, None]


def test_moving_average_in_cells_equals_plain(spark, small_groups):
    rows = [(p, i, float((i * 37 + p) % 11)) for p in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "pid int, n int, x double")
    cells = {(r.pid, r.n): r.m for r in v.centred_mean(df, ["pid"], ["n"], [("x", 10, "m")]).collect()}
    for p in (1, 2):
        xs = [x for q, _, x in rows if q == p]
        for i in range(300):
            whole = xs[i - 4 : i + 6] if 4 <= i <= 294 else None
            assert cells[(p, i)] == (pytest.approx(sum(whole) / 10) if whole else None)


def test_bridge_cases(spark):
    seen = {"a": [1, 3], "b": [1, 2, 3, 4], "c": [2, 4], "d": [1, 4], "e": [3, 4], "f": [1]}
    rows = [(1, k, b, -50, 2412 if b < "d" else 5180) for b, ks in seen.items() for k in ks]
    df = spark.createDataFrame(rows, "pid long, visit long, bssid string, rssi int, frequency int")
    df = df.withColumn("date", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("visit").cast("int")))
    got = {r.bssid: (r.bridge, r.frequency_24) for r in v.bridges(df).collect()}
    assert got == {"a": (1, 1), "b": (0, 1), "c": (1, 1), "d": (1, 0), "e": (0, 0), "f": (0, 0)}


# --- relational, sampling, statistics -----------------------------------------------------------------


def test_append_fills_missing_and_split_back_returns_the_source(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, "z")], "x int, w string")
    both = rel.append_by_name([a, b])
    assert sorted(map(tuple, both.select("x", "y", "w", "src_rank").collect()), key=str) == [(1, 2, None, 0), (3, None, "z", 1)]
    assert [r.x for r in rel.split_back(both, 1).collect()] == [3]


def test_alignment_keeps_the_test_rows(spark):
    test = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "click_id int, k int")
    scored = spark.createDataFrame([(5, 0.2), (5, 0.4), (7, 0.9)], "k int, p double")
    got = {r.click_id: r.p for r in rel.align_mean(test, scored, ["k"], "p").collect()}
    assert got == {1: pytest.approx(0.3), 2: pytest.approx(0.3), 3: None}


def test_row_range_and_tail(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(50)], "a int, b int")
    inside = [(r.a, r.b) for r in rel.row_range(df, ["a", "b"], 10, 20).collect()]
    assert sorted(inside) == sorted((i % 3, i) for i in range(50))[9:20]
    tail = rel.tail_flag(df, ["a", "b"], 7).filter("is_valid").collect()
    assert sorted((r.a, r.b) for r in tail) == sorted((i % 3, i) for i in range(50))[-7:]
    assert rel.tail_flag(df, ["a", "b"], 500).filter("is_valid").count() == 50


def test_balance_with_a_class_of_one_row(spark):
    df = spark.createDataFrame([(i, 1 if i == 7 else 0) for i in range(40)], "id int, y int")
    assert sorted(r["count"] for r in sa.balance(df, "id", "y").groupBy("y").count().collect()) == [1, 1]


def test_splits_are_exact_disjoint_and_complete(spark):
    df = spark.range(1001)
    flagged = sa.split_exact(df, "id", 0.7)
    assert flagged.count() == 1001 and flagged.filter("is_train").count() == 700
    parts = {r.part: r["count"] for r in sa.split_bands(df, "id").groupBy("part").count().collect()}
    assert parts == {0: 500, 1: 250, 2: 251}
    assert sa.split_exact(df, "id", 0.0).filter("is_train").count() == 0


def test_split_does_not_depend_on_partitioning(spark):
    one = {r.id for r in sa.split_exact(spark.range(0, 500, 1, 1), "id").filter("is_train").collect()}
    many = {r.id for r in sa.split_exact(spark.range(0, 500, 1, 13), "id").filter("is_train").collect()}
    assert one == many


def test_stratified_split_with_many_classes_uses_ranks(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "id int, y int")
    few = {r.id for r in sa.split_stratified(df, "id", "y").filter("is_train").collect()}
    monkeypatch.setattr(sa, "BROADCAST_GROUPS", 3)
    many = {r.id for r in sa.split_stratified(df, "id", "y").filter("is_train").collect()}
    assert few == many and len(few) > 440


@pytest.mark.parametrize("split", [False, True])
def test_exact_quantiles(spark, split):
    if split:
        spark.conf.set("eventloom.groupRows", "10")
    try:
        df = spark.createDataFrame([(i % 2, float((i * 7919) % 101)) for i in range(200)], "g int, x double")
        got = {r.g: r.quantiles for r in st.exact_quantiles(df, "x", [0.25, 0.5, 0.9], ["g"]).collect()}
        want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", [0.25, 0.5, 0.9]).alias("q")).collect()}
    finally:
        spark.conf.unset("eventloom.groupRows")
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_z_scores_fitted_elsewhere(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    test = spark.createDataFrame([(2.0,)], "x double")
    assert st.z_scores(test, ["x"], fit_on=train).first().x == pytest.approx(0.0)


def test_param_grid(spark):
    grid = rel.param_grid(
        spark,
        {
            "num_leaves": [5, 7, 9, 255], "max_depth": [4, 6, 8, 48, 64], "subsample": [0.7, 0.9, 1.0],
            "colsample_bytree": [0.7, 0.9, 1.0], "min_child_weight": [0.0, 0.01, 0.1], "scale_pos_weight": [100, 200, 300, 400],
        },
    )
    assert grid.count() == grid.distinct().count() == 2160


def test_features_of_equal_rows_do_not_depend_on_partitions(spark):
    from eventloom.operators.relational import align_features

    test = spark.createDataFrame([(1, "a"), (2, "b")], "click_id long, k string")
    rows = [(10 - i, "a", float(i)) for i in range(10)]
    features = spark.createDataFrame(rows, "click_id long, k string, v double")
    for parts in (1, 2, 7):
        found = {r.click_id: r.v for r in align_features(test, features.repartition(parts)).collect()}
        assert found == {1: 9.0, 2: None}


def test_scans_of_several_parts(spark, monkeypatch):
    """Parts of two records: positions count on, and a last part of one record is not a single scan."""
    from eventloom import views
    from eventloom.operators.visits import unpack_scans

    monkeypatch.setattr(views, "SCAN_PART", 2)
    folder = "/root/testdata/sf0.001"
    columns = ["visit", "pid", "type", "pos", "bssid", "rssi", "frequency"]
    want = views.readings(spark, folder, with_position=True).select(*columns)
    packed = views.scans(spark, folder)
    assert packed.agg({"part": "max"}).first()[0] > 0
    got = unpack_scans(packed, part="part").select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    several = want.groupBy("visit").count().where("count > 1").select("visit")
    kept = unpack_scans(packed, part="part", drop_single=True).select(*columns)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want.join(several, "visit", "left_semi").select(*columns).collect()))


def test_all_visits_of_a_place_count(spark):
    """A place of six visits: the access point that is away in the fifth comes back in the sixth."""
    from eventloom.operators.visits import bridges, pivot_bssid, pivot_visit

    rows = [(1, v, f"2020-01-0{v}", "b1", -50 - v, 2412) for v in range(1, 7) if v != 5]
    rows += [(1, v, f"2020-01-0{v}", "b2", -60, 5180) for v in range(1, 7)]
    readings = spark.createDataFrame(rows, "pid long, visit long, date string, bssid string, rssi int, frequency int")
    found = {r.bssid: (r.bridge, r.frequency_24) for r in bridges(readings).collect()}
    assert found == {"b1": (1, 1), "b2": (0, 0)}
    wide = {r.bssid: r for r in pivot_visit(readings).collect()}
    assert wide["b1"].visit_5 is None and wide["b1"].visit_6 == -56.0
    assert set(pivot_bssid(readings).columns) == {"visit", "b1", "b2"}
    with pytest.raises(ValueError):
        pivot_bssid(readings, ["b1"])
    assert set(pivot_bssid(readings, ["b1"], leave_out=True).columns) == {"visit", "b1"}


def test_more_visits_than_a_table_has_columns(spark, monkeypatch):
    """Eleven visits, room for four columns: in blocks no reading is lost."""
    from eventloom.operators import visits as v

    monkeypatch.setattr(v, "PIVOT_COLUMNS", 4)
    rows = [(p, n, f"2020-01-{n:02}", b, -50 - n - i) for p in (1, 2) for n in range(1, 12) for i, b in enumerate(("b1", "b2", None)) if (n + i) % 3]
    readings = spark.createDataFrame(rows + [(1, 4, "2020-01-04", "b1", -93)], "pid long, visit long, date string, bssid string, rssi int")
    with pytest.raises(ValueError):
        v.pivot_visit(readings)
    wide = v.pivot_visit(readings, block=4)
    assert [c for c in wide.columns if c.startswith("visit_")] == ["visit_1", "visit_2", "visit_3", "visit_4"]
    found = {(r.pid, r.bssid, r.first_visit + i): r[f"visit_{i + 1}"] for r in wide.collect() for i in range(4) if r[f"visit_{i + 1}"] is not None}
    want = {(p, b, n): float(s) for p, n, _, b, s in rows} | {(1, "b1", 4): (-54 - 93) / 2}
    assert found == want
    some = v.pivot_visit(readings, block=4, visits=6).collect()
    assert {r.first_visit for r in some} == {1, 5} and all(r.visit_3 is None for r in some if r.first_visit == 5)


def test_a_visit_stays_in_one_partition(spark):
    """Sums by visit need no shuffle of their own, and the partitions follow the rows."""
    from eventloom import views
    from eventloom.operators.ordered import dealt
    from eventloom.operators.visits import mean_readings

    rows = spark.range(1000).select((F.col("id") % 300).alias("k"), "id")
    assert dealt(rows, ["k"], task_rows=20).rdd.getNumPartitions() == 50
    plan = mean_readings(views.readings(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    before = views.readings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == before.count("Exchange")


def test_splits_of_few_and_many_classes_agree(spark, monkeypatch):
    from eventloom.operators import sampling

    df = spark.range(300).select("id", (F.col("id") % 7).alias("c"), F.lit(1).alias("x"))
    usual = sampling.split_stratified(df, "id", "c", 0.3).where("is_train").select("id").collect()
    monkeypatch.setattr(sampling, "BROADCAST_GROUPS", 3)
    ranked = sampling.split_stratified(df, "id", "c", 0.3).where("is_train").select("id").collect()
    assert sorted(usual) == sorted(ranked)


def test_three_parts_evaluate_their_source_thrice(spark):
    from eventloom.operators.sampling import split_bands

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    split = split_bands(df, "o_orderkey", (0.5, 0.25))
    n = df.count()
    counts = {r.part: r["count"] for r in split.groupBy("part").count().collect()}
    assert counts == {0: n // 2, 1: int(n * 0.75) - n // 2, 2: n - int(n * 0.75)}
    # The histogram serves twice, through one exchange: count the scans of the plan that ran.
    split.collect()
    plan = split._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert 0 < plan.count("FileScan") <= 3, plan


def test_partitions_of_a_family_follow_the_rows(spark):
    """What is shuffled for windows has as many partitions as the stated rows call for, not as many as there are cores."""
    from eventloom.operators.ordered import TASK_ROWS, spread

    rows = spark.range(1000)
    assert spread(rows, ["id"], 50 * TASK_ROWS).rdd.getNumPartitions() == 50
    assert spread(rows, ["id"], 50 * TASK_ROWS, always=False).rdd.getNumPartitions() == 50
    assert spread(rows, ["id"], 1000, always=False) is rows
