"""The physical plans that the library is built around."""

from folders import SMALL
from pyspark.sql import functions as F

from eventloom import views
from eventloom.catalog import QUERIES
from eventloom.operators import features as f
from eventloom.operators import relational as rel
from eventloom.operators.ordered import position
from eventloom.plans import pipelines, workflows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node: str) -> int:
    return sum(line.lstrip(" :+-*()0123456789").startswith(node) for line in plan(df).splitlines())


def test_one_shuffle_serves_all_lists_of_a_key(spark):
    df = f.add_features(
        views.clicks(spark, SMALL),
        [
            f.group_size(["ip"]),
            f.group_size(["ip", "app"]),
            f.distinct_count(["ip"], "channel"),
            f.next_gap(["ip", "os", "device", "app"]),
            f.previous_gap(["ip", "channel"]),
            f.running_count(["ip"], "os"),
        ],
    )
    assert count(df, "Exchange") == 1


def test_lgb_job_sorts_once_per_chain_and_shuffles_rows_once(spark):
    df = pipelines.features_lgb(views.clicks(spark, "/root/testdata/sf0.01"))
    text = plan(df)
    assert text.count("REPARTITION_BY_COL") == 1
    assert count(df, "Sort ") == 6
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_few_groups_are_aggregated_before_any_shuffle_of_rows(spark):
    df = f.add_features(views.clicks(spark, SMALL), [f.group_size(["app"])])
    assert "BroadcastHashJoin" in plan(df) and "Window" not in plan(df)


def test_tail_flag_filters_without_moving_the_rows(spark):
    df = rel.tail_flag(views.click_train(spark, SMALL), views.CLICK_ORDER, 100)
    assert "Exchange" not in plan(df)


def test_row_range_reaches_the_scan(spark):
    df = rel.row_range(views.clicks(spark, SMALL), views.CLICK_ORDER, 100, 200)
    text = plan(df)
    assert "GreaterThanOrEqual(ts" in text.split("PushedFilters", 1)[1] and "Exchange" not in text


def test_global_position_of_a_large_table_is_not_one_task(spark, small_groups):
    df = position(views.clicks(spark, SMALL), [], list(views.CLICK_ORDER), "n")
    text = plan(df)
    rows = [line for line in text.splitlines() if "Exchange SinglePartition" in line]
    # only the table of piece edges is gathered
    assert len(rows) == 1 and "__piece" in text
    assert [r.n for r in df.orderBy("n").select("n").collect()] == list(range(1, 1001))


def test_oversized_groups_are_spread(spark):
    """A key holding a third of the rows ends up in many tasks."""
    spark.conf.set("eventloom.groupRows", "200")
    try:
        hot = views.clicks(spark, SMALL).withColumn("ip", F.when(F.col("click_id") % 3 == 0, -1).otherwise(F.col("ip")))
        df = f.add_features(hot, [f.running_count(["ip"], name="r"), f.next_gap(["ip"], "g")])
        rows = df.filter("ip = -1").withColumn("task", F.spark_partition_id())
        assert rows.select("task").distinct().count() > 1
        assert sorted(r.r for r in rows.collect()) == list(range(rows.count()))
    finally:
        spark.conf.unset("eventloom.groupRows")


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["filter_rssi"](spark, SMALL))
    assert "l_extendedprice" not in text.split("ReadSchema", 1)[1]


def test_no_query_plans_a_cartesian_product(spark):
    for name in ("metric_summary", "freq_table", "zscore", "fill_median", "split_70_30", "align_test_mean", "checked_wifi"):
        assert "CartesianProduct" not in plan(QUERIES[name](spark, SMALL)), name


def test_churn_submission_rows_fits_whole_models(spark, monkeypatch):
    """The query averages models of 200 trees and a network of as many passes as it makes by itself."""
    seen = {}

    def spy(train, test, builds, key="msno", label="is_churn"):
        seen.update({name: build(["balance"], label).getStages()[-1] for name, build in builds.items()})
        return test.select(key, F.lit(0.5).alias(label))

    monkeypatch.setattr(workflows, "churn_submission", spy)
    QUERIES["churn_submission_rows"](spark, SMALL)
    assert (seen["gbm"].getMaxIter(), seen["rf"].getNumTrees(), seen["glm"].getMaxIter(), seen["dl"].getMaxIter()) == (200, 200, 50, 50)
