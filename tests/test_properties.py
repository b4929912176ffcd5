"""Properties: fused lags equal per-lag joins, upserts are idempotent, folds equal
the row-position definition, streamed updates equal the batch update."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from testdata_paths import SF001, SF01
from wattsmith.operators import update as upd
from wattsmith.operators.folds import assign_folds, ordered_positions
from wattsmith.plans import catalog
from wattsmith.sources import fixtures as fx
from wattsmith.sources.schemas import UPDATE_KEYS


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fused_equals_plain_lags(spark):
    fused = catalog.target_lags(spark, SF01)
    plain = catalog.target_lags_plain(spark, SF01)
    assert _same(fused, plain)


def test_window_lag_equals_join_lag(spark):
    w = catalog.target_lag_range_frame(spark, SF01)
    j = catalog.target_lags(spark, SF01).select("row_id", "target_48h")
    assert _same(w, j)


def test_upsert_idempotent_and_newest_wins(spark):
    old, new = catalog.batches(spark, SF001, "client")
    keys = UPDATE_KEYS["client"]
    once = upd.upsert(old, new, keys)
    twice = upd.upsert(once, new, keys)
    assert _same(once, twice)
    assert once.count() == once.select(*keys).distinct().count()
    # rows of the new batch replace overlapping old rows
    joined = once.join(new.select(*keys, F.col("eic_count").alias("n")), keys)
    assert joined.filter(F.col("eic_count") != F.col("n")).count() == 0


def test_update_tables_bundle(spark):
    b = fx.bundle(spark, SF001)
    old_t, new_t = catalog.batches(spark, SF001, "target")
    old = b.with_tables(target=old_t)
    out = upd.update_tables(old, new_target=new_t)
    assert out.target.count() == b.target.count()


def _brute_folds(df, k=6):
    w = Window.orderBy("datetime", "row_id")
    n = df.count()
    t = n // (k + 1)
    first = n - k * t
    pos = F.row_number().over(w) - 1
    return df.select("row_id", F.when(pos < first, -1).otherwise(
        F.floor((pos - first) / t)).cast("int").alias("fold"))


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_folds_match_row_positions(spark, sf):
    rows = catalog._fold_rows(spark, sf)
    got = assign_folds(rows).select("row_id", "fold")
    assert _same(got, _brute_folds(rows))
    # every test row is later than every training row of its fold
    f = got.join(rows, "row_id")
    for i in range(6):
        tmin = f.filter(F.col("fold") == i).agg(F.min("datetime")).first()[0]
        tmax = f.filter(F.col("fold") < i).agg(F.max("datetime")).first()[0]
        assert tmax <= tmin


def test_folds_with_one_huge_hour(spark):
    """A third of the rows in one hour: ranks inside it come from the range sort."""
    base = spark.range(0, 3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 05:00:00"))
         .otherwise(F.format_string("2024-01-%02d 00:00:00", (F.col("id") % 20 + 2).cast("int")))
         .cast("timestamp_ntz").alias("datetime"))
    assert _same(assign_folds(base).select("row_id", "fold"), _brute_folds(base))


def test_ordered_positions_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    pos = ordered_positions(df, ["k"], num_partitions=7)
    got = pos.select("k", "pos")
    want = df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("pos"))
    assert _same(got, want)


def test_stream_equals_batch(spark):
    streamed = catalog.stream_update(spark, SF001)
    batch = catalog._update("target")(spark, SF001)
    assert _same(streamed.select(*batch.columns), batch)


def test_over_budget_sides_fall_back_to_shuffle_joins(spark):
    """With a 1-byte broadcast budget every small side stays a shuffle join; the
    feature table must not change."""
    want = catalog.features_train(spark, SF001)
    spark.conf.set("wattsmith.broadcastBudgetBytes", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalog.features_train(spark, SF001)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert _same(got, want)
    finally:
        spark.conf.unset("wattsmith.broadcastBudgetBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_parquet_inputs_and_scratch_cleanup(spark, tmp_path):
    from test_features import _write_inputs
    from wattsmith.operators.joins import drop_scratch, scratch_root
    from wattsmith.plans.features import FeatureBuilder
    from wattsmith.sources import schemas as S
    from wattsmith.sources.readers import read_input
    from wattsmith.sources.storage import TableBundle
    csv, pq = tmp_path / "csv", tmp_path / "pq"
    csv.mkdir()
    pq.mkdir()
    _write_inputs(str(csv))
    for name in ["train", "client", "gas_prices", "electricity_prices", "forecast_weather",
                 "historical_weather", "weather_station_to_county_mapping"]:
        read_input(spark, str(csv), name, "csv").write.parquet(
            str(pq / f"{S.FILE_NAMES[name]}.parquet"))
    a = TableBundle.load(spark, str(csv), "csv")
    b = TableBundle.load(spark, str(pq), "parquet")
    want = FeatureBuilder(a).generate(a.data)
    got = FeatureBuilder(b).generate(b.data)
    assert _same(got.select(*want.columns), want)
    drop_scratch(spark)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    assert not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def test_row_scope_gives_same_test_features(spark):
    from wattsmith.plans.features import FeatureBuilder
    from wattsmith.sources.storage import preprocess_test
    b = fx.bundle(spark, SF01)
    test = (b.data.filter(F.col("datetime") >= F.lit("2024-01-28 00:00:00").cast("timestamp_ntz"))
            .drop("target").withColumnRenamed("datetime", "prediction_datetime"))
    rows = preprocess_test(test)
    scoped = FeatureBuilder(b).generate(rows, has_target=False, scope=True)
    full = FeatureBuilder(b).generate(rows, has_target=False, scope=False)
    assert scoped.count() == rows.count()
    assert _same(scoped, full)


def test_fixtures_independent_of_session_time_zone(spark):
    want = catalog.target_lags(spark, SF001)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = catalog.target_lags(spark, SF001)
        assert _same(got, want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", ["client", "forecast_weather", "target"])
def test_unique_upsert_equals_full_dedupe(spark, name):
    old, new = catalog.batches(spark, SF001, name)
    keys = UPDATE_KEYS[name]
    base = upd.upsert(old, old.limit(0), keys)            # unique by construction
    full = upd.upsert(base, new, keys)
    fast = upd.upsert(base, new, keys, current_unique=True)
    assert _same(fast, full)
    again = upd.upsert(fast, new, keys, current_unique=True)
    assert _same(again, full)


def test_assert_unique(spark):
    old, new = catalog.batches(spark, SF001, "target")
    keys = UPDATE_KEYS["target"]
    upd.assert_unique(old, keys, "old")
    with pytest.raises(ValueError):
        upd.assert_unique(old.unionByName(new), keys, "union")


def test_lag_strategies_give_same_features(spark):
    from wattsmith.plans.features import FeatureBuilder
    b = fx.bundle(spark, SF01)
    auto = FeatureBuilder(b).generate(b.data)                      # in place
    fused = FeatureBuilder(b, lag_strategy="fused").generate(b.data)
    plain = FeatureBuilder(b, lag_strategy="plain").generate(b.data)
    assert _same(auto, fused.select(*auto.columns))
    assert _same(auto, plain.select(*auto.columns))
