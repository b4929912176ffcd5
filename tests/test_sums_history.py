"""Order-free sums against exact fractions; the bucketed history against the window form."""

import math
import re
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from testdata_paths import SF001
from wattsmith.operators import history as hist
from wattsmith.operators import target as tgt
from wattsmith.operators import weather as wx
from wattsmith.operators.sums import exact_mean, exact_sum
from wattsmith.operators.update import upsert
from wattsmith.sources import fixtures as fx


def _sum(spark, values, slices):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(slices)
    return df.agg(exact_sum(F.col("x")).alias("s"), exact_mean(F.col("x")).alias("m")).first()


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=60))
def test_sum_is_exact_in_any_order(spark, values):
    one, other = _sum(spark, values, 1), _sum(spark, values[::-1], 3)
    assert one == other
    want = float(sum(map(Fraction, values)))
    assert one.s == pytest.approx(want, rel=4e-16, abs=len(values) * 2.0 ** -55)


def test_sum_keeps_what_addition_loses(spark):
    values = [1e15, 1e-3, -1e15] * 7 + [0.1] * 10
    got = _sum(spark, values, 4).s
    assert got == pytest.approx(float(sum(map(Fraction, values))), rel=1e-15)


@pytest.mark.parametrize("values, want", [
    ([None, None], None), ([None, 1.5], 1.5), ([math.inf, 1.0], math.inf), ([-0.0], 0.0),
    ([1e300, 1.0], 1e300), ([-(2.0 ** 56), 1.0], 1 - 2.0 ** 56), ([5e-324], 0.0)])
def test_special_values(spark, values, want):
    assert _sum(spark, values, 2).s == want


def test_nan(spark):
    assert math.isnan(_sum(spark, [math.nan, 1.0], 2).s)
    assert math.isnan(_sum(spark, [math.inf, -math.inf], 2).s)


def test_means_are_equal_to_the_bit(spark):
    """Two partitionings, and the two-level roll-up against one direct aggregation."""
    hw = wx.historical_with_county(fx.historical_weather(spark, SF001), fx.station_map(spark, SF001))
    hw = hw.withColumn("temperature", F.col("temperature") / 3).persist()

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)
    ms = wx.measures(hw)
    whole = wx.hourly_means(hw.repartition(7)).filter("level = 1").select("datetime", *ms)
    assert rows(whole) == rows(wx.global_mean(hw.repartition(3))) == rows(wx.global_mean(hw.coalesce(1)))
    local = wx.hourly_means(hw.repartition(5, "temperature")).filter("level = 0").select("county", "datetime", *ms)
    assert rows(local) == rows(wx.local_mean(hw.repartition(2)))
    hw.unpersist()


def _history(spark):
    return fx.energy(spark, SF001).select(*tgt.SEGMENT_TIME_KEYS, "target")


def _sorted(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lags_read_the_buckets_without_an_exchange(spark):
    history = _history(spark)
    table = hist.write_history(history, buckets=5)
    lags = hist.history_lags(spark, table)
    assert "Exchange" not in _plan(lags) and "Bucketed: true" in _plan(lags)
    assert _sorted(lags) == _sorted(tgt.lags_in_place(history, tgt.TARGET_LAGS))
    assert _sorted(hist.read_history(spark, table)) == _sorted(history)
    with pytest.raises(ValueError):
        hist.history_lags(spark, table, [hist.BLOCK_HOURS + 1])


@pytest.mark.parametrize("budget", [None, "1"])
def test_upsert_moves_the_batch_only(spark, budget, monkeypatch):
    history = _history(spark)
    table = hist.write_history(history, buckets=4)
    new = (history.filter(F.dayofmonth("datetime") % 3 == 0).withColumn("target", F.col("target") + 1)
           .unionByName(history.filter("datetime = TIMESTAMP_NTZ'2024-01-05 03:00:00'").withColumn("datetime", F.col("datetime") + F.expr("INTERVAL 900 DAYS"))))
    new = new.unionByName(spark.createDataFrame([(None, 1, 2, 0, None, 7.5)], "county int, is_business int, product_type int, "
                                                "is_consumption int, datetime timestamp_ntz, target double"))
    seen = []
    save = hist._save
    monkeypatch.setattr(hist, "_save", lambda df, *a: (seen.append(_plan(df)), save(df, *a))[1])
    if budget:
        spark.conf.set("wattsmith.broadcastBudgetBytes", budget)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = hist.upsert_history(spark, table, new)
        again = hist.upsert_history(spark, merged, new)
    finally:
        spark.conf.unset("wattsmith.broadcastBudgetBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in seen:
        # The batch moves, as itself and as its hours; the table does not.
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2, plan
        assert ("SortMergeJoin" in plan) == bool(budget)
    want = upsert(history, new, tgt.SEGMENT_TIME_KEYS)
    assert _sorted(hist.read_history(spark, merged)) == _sorted(want) == _sorted(hist.read_history(spark, again))
    lags = hist.history_lags(spark, merged)
    assert "Exchange" not in _plan(lags)
    assert _sorted(lags.filter("datetime IS NOT NULL")) == _sorted(
        tgt.lags_in_place(want.filter("datetime IS NOT NULL"), tgt.TARGET_LAGS))


def test_empty_history(spark):
    table = hist.write_history(_history(spark).limit(0), buckets=2)
    assert hist.history_lags(spark, table).count() == 0
    merged = hist.upsert_history(spark, table, _history(spark).limit(3))
    assert hist.read_history(spark, merged).count() == 3
