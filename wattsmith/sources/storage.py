"""The bundle of input tables a feature build reads (held as lazy DataFrames)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .readers import enforce_schema, read_input

# Fixed value: training rows start at this timestamp.
TRAIN_START = "2022-01-01 00:00:00"


def filter_since(df: DataFrame, start: str = TRAIN_START, col: str = "datetime") -> DataFrame:
    """Keep rows at or after ``start`` (a literal compare, so it is pushed to the scan)."""
    return df.filter(F.col(col) >= F.lit(start).cast("timestamp_ntz"))


def target_history(data: DataFrame) -> DataFrame:
    return data.select(*S.TARGET_COLS)


def cast_latlon(df: DataFrame) -> DataFrame:
    """Station coordinates are compared as FLOAT on both sides of the station join."""
    return df.withColumns({"latitude": F.col("latitude").cast("float"),
                           "longitude": F.col("longitude").cast("float")})


@dataclass(frozen=True)
class TableBundle:
    data: DataFrame
    client: DataFrame
    gas_prices: DataFrame
    electricity_prices: DataFrame
    forecast_weather: DataFrame
    historical_weather: DataFrame
    station_map: DataFrame
    target: DataFrame
    # True while ``target`` is the projection of ``data`` (then training rows can
    # take their lags from their own series).
    target_is_data: bool = False

    @classmethod
    def from_frames(cls, data, client, gas_prices, electricity_prices, forecast_weather,
                    historical_weather, station_map, target=None, since=TRAIN_START):
        data = filter_since(data, since) if since else data
        return cls(data=data, client=client, gas_prices=gas_prices,
                   electricity_prices=electricity_prices,
                   forecast_weather=forecast_weather,
                   historical_weather=historical_weather,
                   station_map=cast_latlon(station_map),
                   target=target if target is not None else target_history(data),
                   target_is_data=target is None)

    @classmethod
    def load(cls, spark: SparkSession, root: str, fmt: str = "csv",
             since: str = TRAIN_START) -> "TableBundle":
        """Scan the seven inputs under ``root`` with their explicit schemas."""
        r = lambda name, cols: read_input(spark, root, name, fmt, cols)
        return cls.from_frames(
            data=r("train", S.DATA_COLS),
            client=r("client", S.CLIENT_COLS),
            gas_prices=r("gas_prices", S.GAS_PRICES_COLS),
            electricity_prices=r("electricity_prices", S.ELECTRICITY_PRICES_COLS),
            forecast_weather=r("forecast_weather", S.FORECAST_WEATHER_COLS),
            historical_weather=r("historical_weather", S.HISTORICAL_WEATHER_COLS),
            station_map=r("weather_station_to_county_mapping", S.LOCATION_COLS),
            since=since,
        )

    def with_tables(self, **tables: DataFrame) -> "TableBundle":
        if "target" in tables or "data" in tables:
            tables["target_is_data"] = False
        return replace(self, **tables)

    def schemas(self) -> dict:
        """Schemas captured at load time, used to enforce types on new batches."""
        return {"client": self.client.schema, "gas_prices": self.gas_prices.schema,
                "electricity_prices": self.electricity_prices.schema,
                "forecast_weather": self.forecast_weather.schema,
                "historical_weather": self.historical_weather.schema,
                "target": self.target.schema, "data": self.data.schema}


def preprocess_test(test: DataFrame, data_schema=None) -> DataFrame:
    """Test rows: rename ``prediction_datetime`` and cast to the training schema
    (every data column but ``target``)."""
    if "prediction_datetime" in test.columns:
        test = test.withColumnRenamed("prediction_datetime", "datetime")
    schema = data_schema or S.SCHEMAS["train"]
    cols = [c for c in S.DATA_COLS if c != "target"]
    return enforce_schema(test, schema, cols)
