"""Explicit schemas of the seven input tables, the target history and test rows.

Types are ours (the inputs are CSVs read without inference). Time columns are
TIMESTAMP_NTZ so that hour shifts are wall-clock arithmetic whatever the session
time zone is.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Input column names, in file order (they must equal the source
# data's headers).
# ---------------------------------------------------------------------------
DATA_COLS = ["target", "county", "is_business", "product_type", "is_consumption",
             "datetime", "row_id"]
CLIENT_COLS = ["product_type", "county", "eic_count", "installed_capacity",
               "is_business", "date"]
GAS_PRICES_COLS = ["forecast_date", "lowest_price_per_mwh", "highest_price_per_mwh"]
ELECTRICITY_PRICES_COLS = ["forecast_date", "euros_per_mwh"]
FORECAST_WEATHER_COLS = ["latitude", "longitude", "hours_ahead", "temperature", "dewpoint",
                         "cloudcover_high", "cloudcover_low", "cloudcover_mid",
                         "cloudcover_total", "10_metre_u_wind_component",
                         "10_metre_v_wind_component", "forecast_datetime",
                         "direct_solar_radiation", "surface_solar_radiation_downwards",
                         "snowfall", "total_precipitation"]
HISTORICAL_WEATHER_COLS = ["datetime", "temperature", "dewpoint", "rain", "snowfall",
                           "surface_pressure", "cloudcover_total", "cloudcover_low",
                           "cloudcover_mid", "cloudcover_high", "windspeed_10m",
                           "winddirection_10m", "shortwave_radiation",
                           "direct_solar_radiation", "diffuse_radiation", "latitude",
                           "longitude"]
LOCATION_COLS = ["longitude", "latitude", "county"]
TARGET_COLS = ["target", "county", "is_business", "product_type", "is_consumption",
               "datetime"]
# Segment keys and the categorical feature columns.
SEGMENT_KEYS = ["county", "is_business", "product_type", "is_consumption"]
CATEGORICAL_COLS = ["county", "is_business", "product_type", "is_consumption", "segment"]
# Natural keys the incremental update deduplicates on.
UPDATE_KEYS = {
    "client": ["date", "county", "is_business", "product_type"],
    "gas_prices": ["forecast_date"],
    "electricity_prices": ["forecast_date"],
    "forecast_weather": ["forecast_datetime", "latitude", "longitude", "hours_ahead"],
    "historical_weather": ["datetime", "latitude", "longitude"],
    "target": ["datetime", "county", "is_business", "product_type", "is_consumption"],
}
# ---------------------------------------------------------------------------

_I, _L, _D = T.IntegerType(), T.LongType(), T.DoubleType()
_TS, _DATE = T.TimestampNTZType(), T.DateType()

_TYPES = {
    "target": _D, "county": _I, "is_business": _I, "product_type": _I,
    "is_consumption": _I, "datetime": _TS, "row_id": _L, "eic_count": _I,
    "installed_capacity": _D, "date": _DATE, "lowest_price_per_mwh": _D,
    "highest_price_per_mwh": _D, "euros_per_mwh": _D, "latitude": _D, "longitude": _D,
    "hours_ahead": _I, "forecast_datetime": _TS, "prediction_datetime": _TS,
}


def _struct(cols, overrides=None, nullable=True):
    overrides = overrides or {}
    return T.StructType([T.StructField(c, overrides.get(c, _TYPES.get(c, _D)), nullable)
                         for c in cols])


SCHEMAS: dict[str, T.StructType] = {
    "train": _struct(DATA_COLS),
    "client": _struct(CLIENT_COLS),
    "gas_prices": _struct(GAS_PRICES_COLS, {"forecast_date": _DATE}),
    "electricity_prices": _struct(ELECTRICITY_PRICES_COLS, {"forecast_date": _TS}),
    "forecast_weather": _struct(FORECAST_WEATHER_COLS),
    "historical_weather": _struct(HISTORICAL_WEATHER_COLS),
    "weather_station_to_county_mapping": _struct(LOCATION_COLS),
    "target": _struct(TARGET_COLS),
    "test": _struct(["county", "is_business", "product_type", "is_consumption",
                     "prediction_datetime", "row_id"]),
}

# File names of the raw inputs, keyed like SCHEMAS.
FILE_NAMES = {
    "train": "train", "client": "client", "gas_prices": "gas_prices",
    "electricity_prices": "electricity_prices", "forecast_weather": "forecast_weather",
    "historical_weather": "historical_weather",
    "weather_station_to_county_mapping": "weather_station_to_county_mapping",
    "target": "revealed_targets", "test": "test",
}
