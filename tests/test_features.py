"""Full-width inputs (every column the source data has) read from CSV with the
explicit schemas, through the whole feature build: names, counts, leakage rules."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattsmith.plans.features import FeatureBuilder
from wattsmith.sources import schemas as S
from wattsmith.sources.storage import TableBundle, preprocess_test

HOURS = 24 * 16
START = dt.datetime(2023, 3, 20)   # crosses the Mar 26 DST date of Europe


def _write_inputs(root):
    rng = np.random.default_rng(7)
    times = [START + dt.timedelta(hours=h) for h in range(HOURS)]
    segs = [(c, b, p, k) for c in (0, 1) for b in (0, 1) for p in (1, 3) for k in (0, 1)]
    rows, rid = [], 0
    for t in times:
        for c, b, p, k in segs:
            target = None if rid % 97 == 0 else float(rng.integers(0, 1000)) / 10
            rows.append((target, c, b, p, k, t, rid))
            rid += 1
    pd.DataFrame(rows, columns=S.DATA_COLS).to_csv(f"{root}/train.csv", index=False)
    days = sorted({t.date() for t in times})
    pd.DataFrame([(p, c, int(rng.integers(1, 50)), float(rng.integers(1, 900)), b, d)
                  for d in days for c in (0, 1) for b in (0, 1) for p in (1, 3)],
                 columns=S.CLIENT_COLS).to_csv(f"{root}/client.csv", index=False)
    pd.DataFrame([(d, 1.0, 2.0) for d in days], columns=S.GAS_PRICES_COLS).to_csv(
        f"{root}/gas_prices.csv", index=False)
    pd.DataFrame([(t, 5.0) for t in times], columns=S.ELECTRICITY_PRICES_COLS).to_csv(
        f"{root}/electricity_prices.csv", index=False)
    stations = [(57.6, 21.7, 0), (57.9, 21.7, 1), (58.2, 22.2, None)]
    fc_measures = [c for c in S.FORECAST_WEATHER_COLS
                   if c not in ("latitude", "longitude", "hours_ahead", "forecast_datetime")]
    fw = []
    for t in times:
        for lat, lon, _ in stations:
            for ha in (21, 22, 45, 46):
                vals = {m: float(rng.normal()) for m in fc_measures}
                fw.append({"latitude": lat, "longitude": lon, "hours_ahead": ha,
                           "forecast_datetime": t, **vals})
    pd.DataFrame(fw)[S.FORECAST_WEATHER_COLS].to_csv(f"{root}/forecast_weather.csv", index=False)
    hw_measures = [c for c in S.HISTORICAL_WEATHER_COLS
                   if c not in ("latitude", "longitude", "datetime")]
    hw = [{"datetime": t, "latitude": lat, "longitude": lon,
           **{m: float(rng.normal()) for m in hw_measures}}
          for t in times for lat, lon, _ in stations]
    pd.DataFrame(hw)[S.HISTORICAL_WEATHER_COLS].to_csv(f"{root}/historical_weather.csv",
                                                       index=False)
    pd.DataFrame([(lon, lat, c) for lat, lon, c in stations], columns=S.LOCATION_COLS).astype(
        {"county": "Int64"}).to_csv(f"{root}/weather_station_to_county_mapping.csv", index=False)
    return len(rows), sum(r[0] is not None for r in rows)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))
    n, n_target = _write_inputs(root)
    return root, n, n_target


@pytest.fixture(scope="module")
def features(spark, inputs):
    root, _, _ = inputs
    tables = TableBundle.load(spark, root, "csv", since="2022-01-01 00:00:00")
    return FeatureBuilder(tables).generate(tables.data).cache()


def expected_names():
    fc = [c for c in S.FORECAST_WEATHER_COLS
          if c not in ("latitude", "longitude", "hours_ahead", "forecast_datetime")]
    hc = [c for c in S.HISTORICAL_WEATHER_COLS if c not in ("latitude", "longitude", "datetime")]
    names = ["county", "is_business", "product_type", "is_consumption", "segment",
             "day", "weekday", "month", "year", "sin(dayofyear)", "cos(dayofyear)",
             "sin(hour)", "cos(hour)", "eic_count", "installed_capacity"]
    names += fc + [f"{m}_forecast_local_0h" for m in fc]
    names += [f"{m}_forecast_168h" for m in fc] + [f"{m}_forecast_local_168h" for m in fc]
    names += [f"{m}_historical_48h" if m in fc else m for m in hc]
    names += [f"{m}_historical_local_48h" for m in hc]
    names += [f"{m}_historical_168h" for m in hc] + [f"{m}_historical_local_168h" for m in hc]
    names += [f"{m}_historical_24h" for m in hc]
    names += [f"target_{h}h" for h in range(48, 337, 24)]
    names += [f"target_all_type_sum_{h}h" for h in (48, 72, 168, 336)]
    names += [f"target_all_county_type_sum_{h}h" for h in (48, 72, 168, 336)]
    names += ["target_mean", "target_std"]
    names += ["target_ratio_168_336", "target_ratio_48_216", "target_ratio_72_240",
              "target_ratio_48_72", "target_all_type_sum_ratio_48_72",
              "target_all_type_sum_ratio_168_336", "target_all_county_type_sum_ratio_48_72",
              "target_all_county_type_sum_ratio_168_336", "is_holiday"]
    return names


def test_schema_golden(features):
    names = expected_names()
    assert len(names) == 165 and len(set(names)) == 165
    assert set(features.columns) == set(names) | {"target", "row_id"}
    types = dict(features.dtypes)
    assert types["target"] == "double"
    assert types["temperature"] == "float" and types["target_48h"] == "float"
    assert types["is_holiday"] == "boolean" and types["segment"] == "string"


def test_row_count_and_no_fanout(features, inputs):
    _, _, n_target = inputs
    assert features.count() == n_target
    assert features.select("row_id").distinct().count() == n_target


def test_lags_never_leak(features, spark, inputs):
    """target_48h of a row is exactly the target 48 hours earlier in its segment."""
    root, _, _ = inputs
    raw = spark.read.schema(S.SCHEMAS["train"]).option("header", True).csv(f"{root}/train.csv")
    keys = ["county", "is_business", "product_type", "is_consumption"]
    prev = raw.select(*keys, (F.col("datetime") + F.expr("INTERVAL 48 HOURS")).alias("datetime"),
                      F.col("target").cast("float").alias("expect"))
    f = features.select("row_id", "target_48h")
    j = raw.select("row_id", *keys, "datetime").join(f, "row_id").join(
        prev, keys + ["datetime"], "left")
    bad = j.filter(~F.col("target_48h").eqNullSafe(F.col("expect"))).count()
    assert bad == 0


def test_forecast_horizon_window(spark, inputs):
    from wattsmith.operators.weather import forecast_with_county
    root, _, _ = inputs
    t = TableBundle.load(spark, root, "csv")
    kept = forecast_with_county(t.forecast_weather.withColumn("ha", F.col("hours_ahead")),
                                t.station_map)
    assert {r.ha for r in kept.select("ha").distinct().collect()} == {22, 45}
    every = forecast_with_county(t.forecast_weather.withColumn("ha", F.col("hours_ahead")),
                                 t.station_map, horizon=None)
    assert {r.ha for r in every.select("ha").distinct().collect()} == {21, 22, 45, 46}


def test_morning_lag_only_to_hour_10(features, spark):
    rows = features.select(F.col("temperature_historical_24h").isNotNull().alias("has"),
                           F.col("sin(hour)"), F.col("cos(hour)")).collect()
    for r in rows:
        hour = round(np.degrees(np.arctan2(r["sin(hour)"], r["cos(hour)"])) / 15) % 24
        if hour > 10:
            assert not r.has


def test_test_rows_path(spark, inputs):
    root, _, _ = inputs
    t = TableBundle.load(spark, root, "csv")
    test = (t.data.filter(F.col("datetime") >= F.lit("2023-04-04 00:00:00").cast("timestamp_ntz"))
            .drop("target").withColumnRenamed("datetime", "prediction_datetime"))
    out = FeatureBuilder(t).generate(preprocess_test(test), has_target=False)
    assert "target" not in out.columns
    assert out.count() == test.count()
    assert len(out.columns) == 166


def test_csv_columns_matched_by_name(spark, tmp_path):
    """Extra columns and another column order in the file (as the source data has)."""
    from wattsmith.sources.readers import read_input
    pd.DataFrame({"county": [1, 2], "is_business": [0, 1], "product_type": [3, 1],
                  "target": [1.5, None], "is_consumption": [0, 1],
                  "datetime": ["2023-01-01 00:00:00", "2023-01-01 01:00:00"],
                  "data_block_id": [0, 0], "row_id": [10, 11], "prediction_unit_id": [5, 6]}
                 ).to_csv(tmp_path / "train.csv", index=False)
    df = read_input(spark, str(tmp_path), "train", "csv", S.DATA_COLS)
    assert df.columns == S.DATA_COLS
    assert dict(df.dtypes)["datetime"] == "timestamp_ntz"
    rows = df.orderBy("row_id").collect()
    assert rows[0].target == 1.5 and rows[1].target is None and rows[1].county == 2


def test_feature_table_csv_handoff_and_saved_schemas(spark, features, inputs, tmp_path):
    """S12/S13: the feature table written as CSV and read back with its schema;
    S10: the schemas captured at load are the explicit ones."""
    from wattsmith.sources.readers import read_features, write_features
    root, _, _ = inputs
    path = str(tmp_path / "features_csv")
    write_features(features, path, fmt="csv")
    back = read_features(spark, path, fmt="csv", schema=features.schema)
    assert back.count() == features.count()
    assert back.select("row_id", "target", "segment").exceptAll(
        features.select("row_id", "target", "segment")).count() == 0
    t = TableBundle.load(spark, root, "csv")
    saved = t.schemas()
    assert [f.name for f in saved["client"].fields] == S.CLIENT_COLS
    assert dict((f.name, f.dataType.simpleString()) for f in saved["target"].fields)[
        "datetime"] == "timestamp_ntz"
