"""Plan properties the scale design depends on, checked on the physical plans."""

import pytest

from tidepool.plans.registry import queries
from conftest import SF_SMALL


def _plan(spark, name):
    df = queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["pv_hourly", "uv_hourly", "hot_items", "hot_pages", "ad_blacklist",
                                  "order_pay_status", "market_by_channel"])
def test_event_type_filter_reaches_the_scan(spark, name):
    plan = _plan(spark, name)
    assert "PushedFilters: [" in plan and "event_type" in plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]


@pytest.mark.parametrize("name", ["hot_items", "hot_items_sql", "hot_pages", "ad_blacklist", "ad_passed_clicks"])
def test_top_n_limits_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in _plan(spark, name)


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_udf_or_cartesian_product(spark, name):
    plan = _plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "pv_hourly")
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert set(c.split(":")[0] for c in schema.split(",")) == {"ts", "event_type"}


@pytest.mark.parametrize("name", ["login_fail_pattern", "order_pattern_paid", "order_pattern_timeout"])
def test_patterns_take_one_shuffle_and_no_join(spark, name):
    plan = _plan(spark, name)
    assert plan.count("Exchange") == 1 and "Join" not in plan and plan.count("Scan parquet") == 1, plan


def test_large_limits_are_sliced_before_the_group_meets(spark):
    from helpers import frame
    from tidepool.operators import keyed, topn
    rows = [(1, i % 2, "x", 1000 + i, i) for i in range(50)]
    df = frame(spark, rows, "user_id long, ad_id long, province string, ts_us long, seq long")
    passed, _ = keyed.click_limit(df, ["user_id", "ad_id"], 5000)
    assert "_slice" in passed._jdf.queryExecution().executedPlan().toString()
    assert passed.count() == 50
    few, warned = keyed.click_limit(df, ["user_id", "ad_id"], 20)
    old, topn.GROUP_LIMIT = topn.GROUP_LIMIT, 2
    try:
        sliced, sliced_warned = keyed.click_limit(df, ["user_id", "ad_id"], 20)
        assert sorted(sliced.collect()) == sorted(few.collect()) and sorted(sliced_warned.collect()) == sorted(warned.collect())
    finally:
        topn.GROUP_LIMIT = old


def test_bursts_start_no_job_before_an_action(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("burst-plan", "")
    try:
        _plan(spark, "login_fail_burst")
        # reading a parquet footer for its schema may run one small job; nothing else does
        assert len(tracker.getJobIdsForGroup("burst-plan")) <= 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_entry_filter_is_pushed(spark):
    from __spark_entry__ import entry
    plan = entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan
