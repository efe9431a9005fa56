"""Every value-checked query against its SQL, and every other query for rows."""

import pytest
from compare import difference, duck
from folders import SMALL

from eventloom.catalog import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_values(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, CHECKS[name]) is None


SPLIT = [
    "countuniq_ip_device_os_app", "cumcount_ip", "next_click_device", "prev_click_ip_channel", "next_click_hashed",
    "features_datatable", "features_lgb", "scan_row_range", "fill_median", "visit_index", "nth_survey_visit",
    "moving_avg_10_20", "moving_avg_daily", "bssid_order", "bridge_flag", "split_tail", "fold_modulo", "metric_auc",
    "metric_thresholds", "class_profile_numeric", "label_encode", "scan_unpack",
]


@pytest.mark.parametrize("name", SPLIT)
def test_values_with_oversized_groups(spark, con, small_groups, name):
    assert difference(QUERIES[name](spark, SMALL), con, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns and (df.count() > 0 or name == "model_lasso")
