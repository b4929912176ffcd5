"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the views over the driver's tables (``sources.fixtures``). DOUBLE
results are rounded to 6 decimals so the DuckDB oracle (different summation
order) compares equal; FLOAT results are left as computed.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.rowwise import segment_numeric
from ..operators import client as client_op
from ..operators import folds as folds_op
from ..operators import selection as sel
from ..operators import target as tgt
from ..operators import update as upd
from ..operators import weather as wx
from ..sources import fixtures as fx
from ..sources import schemas as S
from ..sources.readers import enforce_schema
from ..operators.joins import SmallSide, materialize
from ..sources.storage import filter_since, preprocess_test
from .features import FeatureBuilder, add_holiday_flag, downcast_floats

DIGITS = 6


def round6(c):
    """Round to 6 decimals through DECIMAL(38,10): ties are decided on the decimal
    value the same way in Spark and in the oracle, and -0.0 becomes 0.0."""
    return F.round(c.cast("decimal(38,10)"), DIGITS).cast("double")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[round6(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _rows(spark, sf):
    """Prediction rows: the energy view with its keys (target kept)."""
    return fx.energy(spark, sf).select("row_id", "datetime", "county", "is_business",
                                       "product_type", "is_consumption", "target")


def _base(spark, sf):
    return _rows(spark, sf).drop("target")


# --- scans and schema (S1-S11, P1-P4, P10) ---------------------------------

def scan_energy(spark, sf):
    return rounded(enforce_schema(fx.energy(spark, sf), S.SCHEMAS["train"]))


def scan_energy_csv(spark, sf):
    """The CSV path: the view is written as ``train.csv`` (header, no schema) and
    scanned back with the explicit schema and column list."""
    from ..sources.readers import read_input
    root = _scratch(spark, "csv")
    (fx.energy(spark, sf).select(*S.DATA_COLS).write.option("header", True)
     .csv(f"{root}/train.csv"))
    return rounded(read_input(spark, root, "train", "csv", S.DATA_COLS))


def scan_client(spark, sf):
    return rounded(enforce_schema(fx.client(spark, sf), S.SCHEMAS["client"]))


def scan_gas(spark, sf):
    return rounded(enforce_schema(fx.gas_prices(spark, sf), S.SCHEMAS["gas_prices"]))


def scan_electricity(spark, sf):
    return rounded(enforce_schema(fx.electricity_prices(spark, sf),
                                  S.SCHEMAS["electricity_prices"]))


def scan_forecast(spark, sf):
    df = fx.forecast_weather(spark, sf)
    return rounded(enforce_schema(df, S.SCHEMAS["forecast_weather"],
                                  [c for c in S.FORECAST_WEATHER_COLS if c in df.columns]))


def scan_historical(spark, sf):
    df = fx.historical_weather(spark, sf)
    return rounded(enforce_schema(df, S.SCHEMAS["historical_weather"],
                                  [c for c in S.HISTORICAL_WEATHER_COLS if c in df.columns]))


def scan_stations(spark, sf):
    return enforce_schema(fx.station_map(spark, sf),
                          S.SCHEMAS["weather_station_to_county_mapping"])


def enforce_schema_q(spark, sf):
    """A batch that arrives as text is cast back to the saved client schema."""
    as_text = fx.client(spark, sf).select(*[F.col(c).cast("string").alias(c)
                                            for c in S.CLIENT_COLS])
    return rounded(enforce_schema(as_text, S.SCHEMAS["client"]))


def preprocess_test_q(spark, sf):
    test = _base(spark, sf).withColumnRenamed("datetime", "prediction_datetime")
    return preprocess_test(test)


def target_history_q(spark, sf):
    return rounded(fx.bundle(spark, sf).target)


def filter_since_q(spark, sf):
    return rounded(filter_since(_rows(spark, sf), "2024-01-15 00:00:00"))


# --- weather (J2-J8, A1-A4, P11-P13) ---------------------------------------

def _stations(spark, sf):
    return fx.station_map(spark, sf)


def forecast_station_join(spark, sf):
    return rounded(wx.map_stations(fx.forecast_weather(spark, sf), _stations(spark, sf)))


def historical_station_join(spark, sf):
    return rounded(wx.map_stations(fx.historical_weather(spark, sf), _stations(spark, sf)))


def forecast_horizon(spark, sf):
    return rounded(wx.forecast_with_county(fx.forecast_weather(spark, sf), _stations(spark, sf)))


def forecast_all_horizons(spark, sf):
    return rounded(wx.forecast_with_county(fx.forecast_weather(spark, sf), _stations(spark, sf),
                                           horizon=None))


def _fw(spark, sf):
    return wx.forecast_with_county(fx.forecast_weather(spark, sf), _stations(spark, sf))


def _hw(spark, sf):
    return wx.historical_with_county(fx.historical_weather(spark, sf), _stations(spark, sf))


def forecast_global_mean(spark, sf):
    return rounded(wx.global_mean(_fw(spark, sf)))


def forecast_local_mean(spark, sf):
    return rounded(wx.local_mean(_fw(spark, sf)))


def historical_global_mean(spark, sf):
    return rounded(wx.global_mean(_hw(spark, sf)))


def historical_local_mean(spark, sf):
    return rounded(wx.local_mean(_hw(spark, sf)))


def lineitem_region_means(spark, sf):
    """The weather-means operator on the larger stand-in tables: shipments are the
    readings, suppliers the stations, a supplier's nation's region the county.
    Station map (supplier x nation, a size-checked broadcast), then global and
    per-region hourly means of four measures in one grouping-sets pass."""
    import os
    li = spark.read.parquet(os.path.join(sf, "lineitem.parquet"))
    ts = F.col("l_shipdate").cast("timestamp_ntz")
    rows = li.select(
        F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                             F.lit(0), F.lit(0)).alias("datetime"),
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    sup = spark.read.parquet(os.path.join(sf, "supplier.parquet"))
    nat = spark.read.parquet(os.path.join(sf, "nation.parquet"))
    stations = SmallSide(sup.join(nat, sup.s_nationkey == nat.n_nationkey)
                         .select(F.col("s_suppkey").alias("l_suppkey"),
                                 F.col("n_regionkey").alias("county")), name="suppliers")
    mapped = rows.join(stations.side(), "l_suppkey", "left").drop("l_suppkey")
    return rounded(wx.hourly_means(mapped))


def forecast_means_grouping_sets(spark, sf):
    """Global + local forecast means from one grouping-sets pass (level 1 = global)."""
    return rounded(wx.hourly_means(_fw(spark, sf)))


def _weather_join(spark, sf, step):
    base = _base(spark, sf)
    out = step(base)
    new = [c for c in out.columns if c not in base.columns]
    return rounded(out.select("row_id", *new))


def forecast_global_lags(spark, sf):
    side = wx.global_side(wx.means_side(_fw(spark, sf), "forecast_means"))
    return _weather_join(spark, sf, lambda b: wx.join_lagged(
        b, side, ["datetime"], wx.FORECAST_LAGS, "_forecast_{h}h"))


def forecast_local_lags(spark, sf):
    side = wx.local_side(wx.means_side(_fw(spark, sf), "forecast_means"))
    return _weather_join(spark, sf, lambda b: wx.join_lagged(
        b, side, ["county", "datetime"], wx.FORECAST_LAGS, "_forecast_local_{h}h"))


def historical_global_lags(spark, sf):
    side = wx.global_side(wx.means_side(_hw(spark, sf), "historical_means"))
    return _weather_join(spark, sf, lambda b: wx.join_lagged(
        b, side, ["datetime"], wx.HISTORICAL_LAGS, "_historical_{h}h"))


def historical_local_lags(spark, sf):
    side = wx.local_side(wx.means_side(_hw(spark, sf), "historical_means"))
    return _weather_join(spark, sf, lambda b: wx.join_lagged(
        b, side, ["county", "datetime"], wx.HISTORICAL_LAGS, "_historical_local_{h}h"))


def historical_lag24_morning(spark, sf):
    side = wx.global_side(wx.means_side(_hw(spark, sf), "historical_means"))
    return _weather_join(spark, sf, lambda b: wx.join_lagged(
        b, side, ["datetime"], [wx.HISTORICAL_MORNING_LAG], "_historical_{h}h",
        transform=wx.morning_only))


def weather_features(spark, sf):
    """Both weather steps on the prediction rows, with the names their suffixes give."""
    stations = wx.station_side(_stations(spark, sf))
    return _weather_join(spark, sf, lambda b: wx.add_historical_features(
        wx.add_forecast_features(b, fx.forecast_weather(spark, sf), stations),
        fx.historical_weather(spark, sf), stations))


# --- client (J1) -----------------------------------------------------------

def client_lag2d(spark, sf):
    base = _base(spark, sf).withColumn("date", F.col("datetime").cast("date"))
    return rounded(client_op.add_client_features(base, fx.client(spark, sf))
                   .select("row_id", "eic_count", "installed_capacity"))


# --- target (A5-A8, J9-J11, F17, W3) ---------------------------------------

def _history(spark, sf):
    return fx.bundle(spark, sf).target


def target_type_sum(spark, sf):
    return rounded(tgt.type_sum(_history(spark, sf)))


def target_county_type_sum(spark, sf):
    return rounded(tgt.county_type_sum(_history(spark, sf)))


def _lag_cols(df, prefix, lags):
    return [f"{prefix}_{h}h" for h in lags]


def target_lags(spark, sf):
    """The 13 lags of rows that are not the history: bucketed windows over both."""
    out = tgt.lags_by_windows(_base(spark, sf), _history(spark, sf), tgt.TARGET_LAGS)
    return rounded(out.select("row_id", *_lag_cols(out, "target", tgt.TARGET_LAGS)))


def target_lags_fused(spark, sf):
    out = tgt.join_lags_fused(_base(spark, sf), _history(spark, sf), tgt.LAG_JOIN_KEYS,
                              tgt.TARGET_LAGS, "target")
    return rounded(out.select("row_id", *_lag_cols(out, "target", tgt.TARGET_LAGS)))


def target_lags_plain(spark, sf):
    out = tgt.join_lags_plain(_base(spark, sf), _history(spark, sf).select(
        *tgt.SEGMENT_TIME_KEYS, "target"), tgt.SEGMENT_TIME_KEYS, tgt.TARGET_LAGS, "target")
    return rounded(out.select("row_id", *_lag_cols(out, "target", tgt.TARGET_LAGS)))


def target_type_sum_lags(spark, sf):
    side, _ = tgt.sum_sides(_history(spark, sf).select(*tgt.SEGMENT_TIME_KEYS, "target"))
    out = _base(spark, sf).join(side.side(), on=tgt.TYPE_SUM_KEYS, how="left")
    return rounded(out.select("row_id", *_lag_cols(out, "target_all_type_sum", tgt.SUM_LAGS)))


def target_county_type_sum_lags(spark, sf):
    _, side = tgt.sum_sides(_history(spark, sf).select(*tgt.SEGMENT_TIME_KEYS, "target"))
    out = _base(spark, sf).join(side.side(), on=tgt.COUNTY_TYPE_SUM_KEYS, how="left")
    return rounded(out.select("row_id", *_lag_cols(out, "target_all_county_type_sum",
                                                   tgt.SUM_LAGS)))


def _target_features(spark, sf):
    return tgt.add_target_features(_base(spark, sf), _history(spark, sf))


def target_row_mean(spark, sf):
    return rounded(_target_features(spark, sf).select("row_id", "target_mean"))


def target_row_std(spark, sf):
    return rounded(_target_features(spark, sf).select("row_id", "target_std"))


def target_ratios(spark, sf):
    names = [f"{p}_ratio_{n}_{d}" for p, n, d in tgt.RATIOS]
    return rounded(_target_features(spark, sf).select("row_id", *names))


def target_lag_range_frame(spark, sf):
    data = fx.bundle(spark, sf).data
    return rounded(tgt.lag_by_range_frame(data, 48).select("row_id", "target_48h"))


# --- calendar and scalar functions (F1-F21, J12, P18, P20) -----------------

def calendar_features(spark, sf):
    return _base(spark, sf).select("row_id", *[v.alias(k) for k, v in
                                               cal.calendar_columns().items()])


def segment_key(spark, sf):
    return _base(spark, sf).select("row_id", cal.segment_column().alias("segment"))


def cyclic_features(spark, sf):
    c = cal.calendar_columns()
    return rounded(_base(spark, sf).select(
        "row_id", *[v.alias(k) for k, v in cal.cyclic_columns(c["dayofyear"], c["hour"]).items()]))


def feature_date(spark, sf):
    return _base(spark, sf).select("row_id", F.col("datetime").cast("date").alias("date"))


def holiday_calendar(spark, sf):
    return cal.holiday_dates(_base(spark, sf).select(F.year("datetime").alias("year")))


def holiday_flag(spark, sf):
    base = _base(spark, sf).withColumn("date", F.col("datetime").cast("date"))
    return add_holiday_flag(base, cal.holiday_dates(
        base.select(F.year("datetime").alias("year")))).select("row_id", "is_holiday")


def holiday_expr(spark, sf):
    """The same flag from the per-row expression (what the feature build uses)."""
    base = _base(spark, sf)
    return base.select("row_id", cal.is_ee_holiday(F.col("datetime").cast("date"))
                       .alias("is_holiday"))


def segment_numeric_q(spark, sf):
    return _base(spark, sf).select("row_id", segment_numeric(cal.segment_column())
                                   .alias("segment_numeric"))


def downcast_float(spark, sf):
    return downcast_floats(fx.historical_weather(spark, sf), keep=())


# --- full feature table ----------------------------------------------------

def features_train(spark, sf):
    b = fx.bundle(spark, sf)
    return FeatureBuilder(b).generate(b.data)


def _last_days(b, days: int = 2):
    """The rows of the data's last ``days`` calendar days, without the target."""
    last = b.data.agg(F.max("datetime").cast("date")).first()[0]
    first = F.date_add(F.lit(last), 1 - days).cast("timestamp_ntz")
    return b.data.filter(F.col("datetime") >= first).drop("target")


def features_test(spark, sf):
    """Test rows (no target) from the last two days, through the test-row path."""
    b = fx.bundle(spark, sf)
    test = _last_days(b).withColumnRenamed("datetime", "prediction_datetime")
    return FeatureBuilder(b).generate(preprocess_test(test), has_target=False)


# --- incremental update (U1-U7) --------------------------------------------

_MEASURES = {
    "client": ["eic_count", "installed_capacity"],
    "gas_prices": ["lowest_price_per_mwh", "highest_price_per_mwh"],
    "electricity_prices": ["euros_per_mwh"],
    "forecast_weather": ["temperature", "dewpoint", "snowfall"],
    "historical_weather": ["temperature", "rain", "snowfall", "surface_pressure"],
    "target": ["target"],
}
_TIME = {"client": "date", "gas_prices": "forecast_date", "electricity_prices": "forecast_date",
         "forecast_weather": "forecast_datetime", "historical_weather": "datetime",
         "target": "datetime"}
_VIEWS = {"client": fx.client, "gas_prices": fx.gas_prices,
          "electricity_prices": fx.electricity_prices, "forecast_weather": fx.forecast_weather,
          "historical_weather": fx.historical_weather,
          "target": lambda s, d: fx.bundle(s, d).target}


def batches(spark, sf, name):
    df = _VIEWS[name](spark, sf)
    return fx.split_batches(df, _TIME[name], _MEASURES[name])


def target_key_duplicates(spark, sf):
    """Repeated (segment, hour) keys in the history: the lag joins need none."""
    return upd.duplicate_keys(_history(spark, sf), S.UPDATE_KEYS["target"])


def client_key_duplicates(spark, sf):
    """Repeated (date, county, is_business, product_type) in the merged client table:
    the union of both batches before the upsert has them, the upsert removes them."""
    old, new = batches(spark, sf, "client")
    keys = S.UPDATE_KEYS["client"]
    return upd.duplicate_keys(old.unionByName(new), keys)


def union_batches_q(spark, sf):
    old, new = batches(spark, sf, "target")
    return rounded(upd.union_batches(old, new).withColumnRenamed(upd.SEQ, "batch"))


def _update(name):
    def q(spark, sf):
        old, new = batches(spark, sf, name)
        return rounded(upd.upsert(old, new, S.UPDATE_KEYS[name]))
    q.__name__ = f"update_{name}"
    return q


# --- selection (A9, T1, T2, P21, P23) ---------------------------------------

def _train(spark, sf):
    return features_train(spark, sf)


def corr_with_target_q(spark, sf):
    return rounded(sel.corr_with_target(_train(spark, sf)))


def corr_ranked(spark, sf):
    return rounded(sel.rank_by_abs_corr(sel.corr_with_target(_train(spark, sf))))


def topk_features(spark, sf):
    return rounded(sel.top_k_features(sel.corr_with_target(_train(spark, sf))))


def categorical_as_string(spark, sf):
    df = _train(spark, sf).select("row_id", *S.CATEGORICAL_COLS)
    return sel.categoricals_as_string(df)


# --- folds and baseline error (W2, A11) ---------------------------------------

def _fold_rows(spark, sf):
    return _rows(spark, sf).filter(F.col("target").isNotNull())


def ts_folds(spark, sf):
    return folds_op.assign_folds(_fold_rows(spark, sf)).select("row_id", "fold")


def mae_baseline(spark, sf):
    """MAE per fold of the 7-day-ago value used as the forecast (rows where it exists)."""
    rows = _fold_rows(spark, sf)
    lagged = tgt.join_lags_fused(rows, _history(spark, sf), tgt.LAG_JOIN_KEYS, [168], "target")
    folds = folds_op.assign_folds(rows).select("row_id", "fold")
    j = lagged.join(folds, "row_id").filter(F.col("target_168h").isNotNull())
    return rounded(j.groupBy("fold").agg(
        F.avg(F.abs(F.col("target") - F.col("target_168h"))).alias("mae"),
        F.count(F.lit(1)).alias("n")))


# --- matrix, index, round trips, stream (A9 full, P17, S12-S16, U8) ----------------

def corr_matrix_q(spark, sf):
    return rounded(sel.corr_matrix(_train(spark, sf)))


def categorical_index(spark, sf):
    """StringIndexer (frequency order, ties alphabetical) fitted on the training rows."""
    from pyspark.ml.feature import StringIndexer
    df = _train(spark, sf).select("row_id", *[F.col(c).cast("string").alias(c)
                                               for c in S.CATEGORICAL_COLS])
    df = materialize(df, "categories")
    model = StringIndexer(inputCols=S.CATEGORICAL_COLS, handleInvalid="keep",
                          outputCols=[f"{c}_index" for c in S.CATEGORICAL_COLS]).fit(df)
    return model.transform(df).select("row_id", *[f"{c}_index" for c in S.CATEGORICAL_COLS])


def _scratch(spark, name):
    from ..operators.joins import scratch_path
    return scratch_path(spark, name)


def features_roundtrip(spark, sf):
    """Feature table written as Parquet (partitioned by year, month) and read back."""
    from ..sources.readers import read_features, write_features
    path = _scratch(spark, "features")
    write_features(_train(spark, sf), path, partition_by=["year", "month"])
    return read_features(spark, path)


def _updated_by_stream(spark, sf, replay: bool):
    from ..streaming.updates import init_table, start_update_stream, updated
    old, new = batches(spark, sf, "target")
    root, keys = _scratch(spark, "stream"), S.UPDATE_KEYS["target"]
    init_table(old, f"{root}/table", keys)
    new.write.mode("overwrite").parquet(f"{root}/incoming")

    def run(checkpoint):
        start_update_stream(spark, f"{root}/incoming", new.schema, keys, f"{root}/table",
                            f"{root}/{checkpoint}").awaitTermination()
    run("checkpoint")
    if replay:
        run("checkpoint")
        run("new-checkpoint")
    return rounded(updated(spark, f"{root}/table", keys))


def stream_update(spark, sf):
    """The target update run as a stream: the base is the old batch, the new
    batch arrives as files, one availableNow run adds it (newest wins)."""
    return _updated_by_stream(spark, sf, replay=False)


def stream_update_replayed(spark, sf):
    """The same, run again from its checkpoint and once more from a new one, which
    adds all files again: the table must not change."""
    return _updated_by_stream(spark, sf, replay=True)


# Trees beyond the best count that a registered model query grows before it settles.
PATIENCE = 5


def _profile(name):
    """The whole profile; its 500 trees are the ceiling of ``PATIENCE``."""
    from .training import profile
    return profile(name)


def _model_rows(spark, sf):
    """Training features with the time helpers kept (folds order by datetime), written
    once: every stage of the model reads them. The model stage leaves datetime, date,
    hour and dayofyear out of its inputs."""
    b = fx.bundle(spark, sf)
    return materialize(FeatureBuilder(b).generate(b.data, drop_helpers=False), "features")


def assemble(spark, sf):
    """The assembled model input, one column per element of the vector: sentinel-filled
    numerics (``__x``) and the indexed segment (``__i``)."""
    from pyspark.ml.functions import vector_to_array
    from .training import build_pipeline
    df = _model_rows(spark, sf)
    *stages, _ = build_pipeline(df, _profile("lightgbm")).getStages()
    out = Pipeline(stages=stages).fit(df).transform(df).select(
        "row_id", vector_to_array("features").alias("v"))
    names = stages[-1].getInputCols()
    return rounded(out.select("row_id", *[F.col("v")[i].alias(n) for i, n in enumerate(names)]))


def gbt_predict(spark, sf):
    from .training import fit, predict
    df = _model_rows(spark, sf)
    return predict(fit(df, _profile("lightgbm"), PATIENCE), df)


def gbt_predict_cat(spark, sf):
    from .training import fit, predict
    df = _model_rows(spark, sf)
    return predict(fit(df, _profile("xgboost"), PATIENCE, categorical=True), df)


def gbt_quality(spark, sf):
    """Of a model fitted on the rows before the last time block: rows, predictions
    missing, whether its error on the rows it learned from is under that of their mean,
    and on the block under that of the value a week earlier (where there is one)."""
    from .training import fit, with_late_block
    df = with_late_block(_model_rows(spark, sf))
    early = df.filter("NOT late").drop("late")
    scored = fit(early, _profile("lightgbm"), PATIENCE).transform(df)
    mean = early.agg(F.avg("target")).first()[0]
    known, week = ~F.col("late"), F.col("late") & F.col("target_168h").isNotNull()

    def error(of, where):
        return F.avg(F.when(where, F.abs(F.col("target") - of)))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction").isNull()).alias("n_missing"),
        F.count_if("late").alias("n_held_out"),
        (error(F.col("prediction"), known) < error(F.lit(mean), known)).alias("beats_mean"),
        (error(F.col("prediction"), week) < error(F.col("target_168h"), week)).alias("beats_lag168"))


def cv_mae(spark, sf):
    from .training import cross_validate
    return cross_validate(_model_rows(spark, sf), _profile("lightgbm"), patience=PATIENCE)


def cv_blocks_q(spark, sf):
    """What each fold tests and trains on, and the error of the value a week earlier."""
    from .training import cv_blocks
    return rounded(cv_blocks(folds_op.assign_folds(_model_rows(spark, sf))))


def score_new(spark, sf):
    """Fit on the old rows, apply a new batch of every table, score the test rows."""
    from .training import fit, predict
    b = fx.bundle(spark, sf)
    cut = F.lit(fx.CUT_OLD).cast("timestamp_ntz")
    old_b = b.with_tables(data=b.data.filter(F.col("datetime") < cut),
                          target=b.target.filter(F.col("datetime") < cut))
    # Helpers kept: the tree count is chosen on the last rows by datetime.
    train = materialize(FeatureBuilder(old_b).generate(old_b.data, drop_helpers=False), "features")
    new_target = b.target.filter(F.col("datetime") >= cut)
    updated = upd.update_tables(old_b, new_target=new_target)
    return predict(fit(train, _profile("lightgbm"), PATIENCE),
                   FeatureBuilder(updated).generate(_last_days(b), has_target=False))


def scored_rows(spark, sf):
    """Which rows ``score_new`` gives a prediction."""
    return score_new(spark, sf).select("row_id", F.col("prediction").isNotNull().alias("scored"))


def stream_score(spark, sf):
    """Scoring as a stream: a model fitted on the training rows scores test-row
    files (the last two days) micro-batch by micro-batch."""
    from ..streaming.scoring import start_scoring_stream
    from .runs import save_model
    from .training import fit
    root = _scratch(spark, "stream-score")
    save_model(fit(_model_rows(spark, sf), _profile("lightgbm"), PATIENCE), f"{root}/model")
    b = fx.bundle(spark, sf)
    test = _last_days(b).withColumnRenamed("datetime", "prediction_datetime")
    test.write.parquet(f"{root}/incoming")
    q = start_scoring_stream(spark, lambda s: fx.bundle(s, sf), f"{root}/model",
                             f"{root}/incoming", test.schema, f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("row_id", "prediction")


def stream_scored_rows(spark, sf):
    """Which rows the scoring stream gives a prediction."""
    return stream_score(spark, sf).select("row_id", F.col("prediction").isNotNull().alias("scored"))


def runs_table(spark, sf):
    """Fit, score, save the model, record the run, and add its error to the record by
    the run's id; return that record."""
    from pyspark.sql.functions import col
    from .runs import add_metrics, log_run, read_runs, save_model
    from .training import fit, mae, tree_counts
    df = _model_rows(spark, sf)
    params = _profile("lightgbm")
    model = fit(df, params, PATIENCE)
    root = _scratch(spark, "runs")
    path = save_model(model, f"{root}/model")
    run_id = log_run(spark, f"{root}/runs", "gbt",
                     params | {"n_features": 60, "is_holiday": True, "trees": tree_counts(model)},
                     {}, {"experiment": "gbt"}, df, path)
    add_metrics(spark, f"{root}/runs", run_id,
                {"mean_absolute_error": mae(model.transform(df)).first()["mae"]})
    return read_runs(spark, f"{root}/runs").filter(col("run_id") == run_id).select(
        "run_id", "model", "params", "metrics", "tags", "input_example", "model_path")


def runs_record(spark, sf):
    """The parts of that record that do not depend on the fit."""
    return runs_table(spark, sf).select(
        "model", F.col("params")["n_features"].alias("n_features"),
        F.col("params")["maxDepth"].alias("max_depth"), F.col("tags")["experiment"].alias("experiment"),
        F.size("input_example").cast("long").alias("n_examples"),
        F.map_contains_key("metrics", "mean_absolute_error").alias("has_error"))


def presented(df: DataFrame, as_double: tuple[str, ...] = ()) -> DataFrame:
    """Value types both engines hand to a comparison the same way: DATE columns as
    midnight TIMESTAMP_NTZ, and the integer columns that can hold NULL (a county
    from the station map, a count from a left join) as DOUBLE, which pandas shows
    identically for both. The library itself keeps DATE and INT."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz").alias(f.name)
        elif f.name in as_double:
            c = c.cast("double").alias(f.name)
        out.append(c)
    return df.select(*out)


def _presenting(fn, as_double=()):
    def q(spark, sf):
        return presented(fn(spark, sf), as_double)
    q.__name__ = fn.__name__
    q.__doc__ = fn.__doc__
    return q


# Registered queries whose result has a DATE column (see ``presented``).
DATE_COLUMNS = {"scan_client": "date", "scan_gas": "forecast_date", "enforce_schema": "date",
                "feature_date": "date", "holiday_calendar": "date", "update_client": "date",
                "update_gas_prices": "forecast_date", "client_key_duplicates": "date"}


# Registered queries whose result has an integer column that can be NULL.
NULLABLE_INTS = {"scan_stations": ("county",), "forecast_station_join": ("county",),
                 "historical_station_join": ("county",), "forecast_horizon": ("county",),
                 "forecast_all_horizons": ("county",),
                 "forecast_means_grouping_sets": ("county",),
                 "lineitem_region_means": ("county",), "client_lag2d": ("eic_count",),
                 "features_train": ("eic_count",), "features_test": ("eic_count",),
                 "features_roundtrip": ("eic_count",)}


def registry() -> dict:
    q = {
        "scan_energy": scan_energy, "scan_energy_csv": scan_energy_csv, "scan_client": scan_client, "scan_gas": scan_gas,
        "scan_electricity": scan_electricity, "scan_forecast": scan_forecast,
        "scan_historical": scan_historical, "scan_stations": scan_stations,
        "enforce_schema": enforce_schema_q, "preprocess_test": preprocess_test_q,
        "target_history": target_history_q, "filter_since": filter_since_q,
        "forecast_station_join": forecast_station_join,
        "historical_station_join": historical_station_join,
        "forecast_horizon": forecast_horizon, "forecast_all_horizons": forecast_all_horizons,
        "forecast_global_mean": forecast_global_mean, "forecast_local_mean": forecast_local_mean,
        "historical_global_mean": historical_global_mean,
        "historical_local_mean": historical_local_mean,
        "forecast_means_grouping_sets": forecast_means_grouping_sets,
        "lineitem_region_means": lineitem_region_means,
        "forecast_global_lags": forecast_global_lags, "forecast_local_lags": forecast_local_lags,
        "historical_global_lags": historical_global_lags,
        "historical_local_lags": historical_local_lags,
        "historical_lag24_morning": historical_lag24_morning,
        "weather_features": weather_features,
        "client_lag2d": client_lag2d,
        "target_type_sum": target_type_sum, "target_county_type_sum": target_county_type_sum,
        "target_lags": target_lags, "target_lags_plain": target_lags_plain,
        "target_lags_fused": target_lags_fused,
        "target_type_sum_lags": target_type_sum_lags,
        "target_county_type_sum_lags": target_county_type_sum_lags,
        "target_row_mean": target_row_mean, "target_row_std": target_row_std,
        "target_ratios": target_ratios, "target_lag_range_frame": target_lag_range_frame,
        "calendar_features": calendar_features, "segment_key": segment_key,
        "cyclic_features": cyclic_features, "feature_date": feature_date,
        "holiday_calendar": holiday_calendar, "holiday_flag": holiday_flag,
        "holiday_expr": holiday_expr,
        "segment_numeric": segment_numeric_q, "downcast_float": downcast_float,
        "features_train": features_train, "features_test": features_test,
        "union_batches": union_batches_q,
        "target_key_duplicates": target_key_duplicates,
        "client_key_duplicates": client_key_duplicates,
        "corr_with_target": corr_with_target_q, "corr_ranked": corr_ranked,
        "topk_features": topk_features, "categorical_as_string": categorical_as_string,
        "ts_folds": ts_folds, "mae_baseline": mae_baseline,
        "corr_matrix": corr_matrix_q, "categorical_index": categorical_index,
        "features_roundtrip": features_roundtrip, "stream_update": stream_update,
        "assemble": assemble, "gbt_predict": gbt_predict, "gbt_predict_cat": gbt_predict_cat,
        "cv_mae": cv_mae, "score_new": score_new, "runs_table": runs_table,
        "stream_score": stream_score, "stream_update_replayed": stream_update_replayed,
        "gbt_quality": gbt_quality, "cv_blocks": cv_blocks_q, "scored_rows": scored_rows,
        "stream_scored_rows": stream_scored_rows, "runs_record": runs_record,
    }
    for name in ["client", "gas_prices", "electricity_prices", "forecast_weather",
                 "historical_weather", "target"]:
        q[f"update_{name}"] = _update(name)
    return {k: _presenting(v, NULLABLE_INTS.get(k, ())) if k in DATE_COLUMNS or k in NULLABLE_INTS
            else v for k, v in q.items()}
