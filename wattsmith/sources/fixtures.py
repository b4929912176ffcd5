"""Input tables derived from the driver's ``events`` table.

The real inputs (meter targets, client snapshots, prices, weather, station map)
are not in the test data, so each is a Spark view over ``events`` with the same
columns and key structure. Everything is a plain projection/aggregate over the
scan, so it scales with ``events`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import TableBundle


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    ts = F.col("ts").cast("timestamp_ntz")
    etype = F.col("event_type")
    return ev.select(
        "event_id", ts.alias("ts"), "user_id", "value",
        # hour truncation from wall-clock parts: no session time zone involved
        F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                             F.lit(0), F.lit(0)).alias("datetime"),
        ts.cast("date").alias("date"),
        (F.col("user_id") % 3).cast("int").alias("county"),
        F.when(etype.isin("purchase", "signup"), 1).otherwise(0).alias("is_business"),
        F.when(etype == "click", 0).when(etype == "view", 1).when(etype == "purchase", 2)
         .when(etype == "signup", 3).otherwise(4).alias("product_type"),
        (F.col("event_id") % 2).cast("int").alias("is_consumption"),
        (F.col("user_id") % 24).cast("int").alias("station"),
        ((F.col("event_id") % 48).cast("int") + 1).alias("hours_ahead"),
    )


def _be(spark, sf_dir, be):
    return be if be is not None else base_events(spark, sf_dir)


def _latlon() -> list[Column]:
    # 24 stations on an 8 x 3 grid; same expression text as the oracle SQL.
    return [F.expr("CAST(57.6 + 0.3 * (station % 8) AS FLOAT)").alias("latitude"),
            F.expr("CAST(21.7 + 0.5 * floor(station / 8) AS FLOAT)").alias("longitude")]


def energy(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    keys = ["datetime", "county", "is_business", "product_type", "is_consumption"]
    return (_be(spark, sf_dir, be).groupBy(*keys)
            .agg(F.min("event_id").alias("row_id"), F.sum("value").alias("_sum"))
            .select(*keys, "row_id",
                    F.when(F.col("row_id") % 50 == 0, F.lit(None).cast("double"))
                     .otherwise(F.col("_sum")).alias("target")))


def client(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    return (base_events(spark, sf_dir)
            .groupBy("date", "county", "is_business", "product_type")
            .agg(F.countDistinct("user_id").cast("int").alias("eic_count"),
                 F.sum("value").alias("installed_capacity")))


def station_map(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    return (_be(spark, sf_dir, be).select("station").distinct()
            .select(*_latlon(),
                    F.when(F.col("station") < 18, F.col("station") % 3).cast("int")
                     .alias("county"))
            .distinct())


def historical_weather(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    return (_be(spark, sf_dir, be).groupBy("datetime", "station")
            .agg(F.avg("value").alias("temperature"), F.max("value").alias("rain"),
                 F.min("value").alias("snowfall"),
                 F.count(F.lit(1)).cast("double").alias("surface_pressure"))
            .select("datetime", *_latlon(), "temperature", "rain", "snowfall",
                    "surface_pressure"))


def forecast_weather(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    return (_be(spark, sf_dir, be).groupBy("datetime", "station", "hours_ahead")
            .agg(F.avg("value").alias("temperature"), F.max("value").alias("dewpoint"),
                 F.min("value").alias("snowfall"))
            .select(F.col("datetime").alias("forecast_datetime"), *_latlon(),
                    "hours_ahead", "temperature", "dewpoint", "snowfall"))


def gas_prices(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    return (_be(spark, sf_dir, be).groupBy("date")
            .agg(F.min("value").alias("lowest_price_per_mwh"),
                 F.max("value").alias("highest_price_per_mwh"))
            .withColumnRenamed("date", "forecast_date"))


def electricity_prices(spark: SparkSession, sf_dir: str, be: DataFrame | None = None) -> DataFrame:
    return (_be(spark, sf_dir, be).groupBy("datetime")
            .agg(F.avg("value").alias("euros_per_mwh"))
            .withColumnRenamed("datetime", "forecast_date"))


def bundle(spark: SparkSession, sf_dir: str) -> TableBundle:
    """All inputs as one bundle, same shape as ``TableBundle.load`` gives for CSVs."""
    be = base_events(spark, sf_dir)
    return TableBundle.from_frames(
        data=energy(spark, sf_dir, be).select("target", "county", "is_business",
                                              "product_type", "is_consumption",
                                              "datetime", "row_id"),
        client=client(spark, sf_dir, be),
        gas_prices=gas_prices(spark, sf_dir, be),
        electricity_prices=electricity_prices(spark, sf_dir, be),
        forecast_weather=forecast_weather(spark, sf_dir, be),
        historical_weather=historical_weather(spark, sf_dir, be),
        station_map=station_map(spark, sf_dir, be),
    )


# Old/new batch split for the incremental-update checks: old = before CUT_OLD,
# new = from CUT_NEW (two days overlap); every measure in the new half is bumped
# by NEW_BUMP so that "newest wins" is visible in the result.
CUT_OLD = "2024-01-27 00:00:00"
CUT_NEW = "2024-01-25 00:00:00"
NEW_BUMP = 1000


def split_batches(df: DataFrame, time_col: str, measures: list[str]) -> tuple[DataFrame, DataFrame]:
    t = F.col(time_col).cast("timestamp_ntz")
    old = df.filter(t < F.lit(CUT_OLD).cast("timestamp_ntz"))
    types = dict(df.dtypes)
    new = df.filter(t >= F.lit(CUT_NEW).cast("timestamp_ntz")).select(
        *[(F.col(f"`{c}`") + F.lit(NEW_BUMP)).cast(types[c]).alias(c) if c in measures
          else F.col(f"`{c}`") for c in df.columns])
    return old, new
