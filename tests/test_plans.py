"""Plan properties the scale design relies on (checked on executed plans)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(spark, "filter_eq")
    assert "EqualTo(event_type,click)" in p
    assert re.search(r"FileScan parquet \[event_id#\d+L,user_id#\d+L,event_type#\d+\]", p)


def test_top_n_limits_before_the_shuffle(spark):
    for name in ["window_topn_url", "sql_window_topn", "table_agg_top2"]:
        assert "WindowGroupLimit" in _plan(spark, name), name


def test_group_counts_are_partial_aggregates(spark):
    for name in ["url_view_count", "word_count", "reduce_count", "window_join", "history_join"]:
        assert "partial_count" in _plan(spark, name), name


def test_per_key_scans_split_hot_keys_only(spark):
    from clickengine.operators.ordered import ordered_scan
    by_key = r"windowspecdefinition\(_oscan_k0#\d+L?, _oscan_n0#\d+, "
    ran = entry.queries()["rolling_count"](spark, SF_SMALL)
    ran.collect()
    p = ran._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # no hot key: when run, one window is left and nothing is carried from bucket to bucket
    assert p.count("Window [") == 1 and re.search(by_key, p) and "_oscan_bcnt" not in p
    df = spark.range(3000).selectExpr("id % 2 AS k", "id")
    p = ordered_scan(df, ["k"], ["id"], F.lit(0), hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    # the row window of hot keys is partitioned by the key surrogate *and* the bucket
    assert re.search(by_key + r"_oscan_bkt#\d+L", p)


def test_no_cartesian_products(spark):
    for name in ["event_timers", "periodic_pv", "behavior_pattern", "interval_join", "late_split"]:
        p = _plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
