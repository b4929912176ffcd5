"""Physical-plan guards for the scale properties the design relies on."""

import re

from pyspark.sql import functions as F

from testdata_paths import SF001
from wattsmith.plans import catalog
from wattsmith.plans.features import FeatureBuilder
from wattsmith.sources import fixtures as fx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def _reset(spark):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_training_plan_shuffles_rows_once(spark):
    """Only the rows' own aggregation and the lag windows shuffle; every small side
    is a size-checked broadcast even with automatic broadcast off."""
    _no_auto_broadcast(spark)
    try:
        plan = _plan(catalog.features_train(spark, SF001))
    finally:
        _reset(spark)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert plan.count("BroadcastHashJoin") >= 12


def _shape(plan):
    return re.findall(r"(\w+Join|Exchange \w+|Window|Sort|HashAggregate)\b", plan)


def test_test_rows_plan_has_no_join_for_the_lags(spark):
    """Rows and history meet in one window exchange; the plan is the same for a few
    rows as for all, and the history is cut by a literal range."""
    _no_auto_broadcast(spark)
    try:
        b = fx.bundle(spark, SF001)
        rows = b.data.drop("target")
        few = rows.filter(F.col("datetime") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
        whole = _plan(FeatureBuilder(b).generate(rows, has_target=False))
        part = _plan(FeatureBuilder(b).generate(few, has_target=False))
    finally:
        _reset(spark)
    assert "SortMergeJoin" not in whole
    assert len(re.findall(r"Exchange hashpartitioning", whole)) == 3
    assert _shape(whole) == _shape(part)
    assert re.search(r"datetime#\d+ >= 20", part)


def test_time_filter_reaches_the_scan(spark, tmp_path):
    from wattsmith.sources.storage import filter_since
    b = fx.bundle(spark, SF001)
    b.data.write.parquet(str(tmp_path / "train.parquet"))
    df = spark.read.parquet(str(tmp_path / "train.parquet"))
    plan = _plan(filter_since(df, "2024-01-15 00:00:00").select("row_id"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(datetime", plan)
    assert "ReadSchema: struct<datetime:timestamp_ntz,row_id:bigint>" in plan


def test_means_read_the_weather_once(spark):
    """Both levels come from one written table of sums, not from two scans."""
    from wattsmith.operators import weather as wx
    mapped = wx.historical_with_county(fx.historical_weather(spark, SF001), fx.station_map(spark, SF001))
    files = wx.hourly_means(mapped).inputFiles()
    assert files and all("/hourly-sums-" in f for f in files)


def test_correlation_matrix_reads_its_input_once(spark):
    from wattsmith.operators.selection import corr_matrix
    df = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b")
    out = corr_matrix(df)
    assert "MapInPandas" not in _plan(out) and out.count() == 3
