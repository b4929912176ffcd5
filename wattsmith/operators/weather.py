"""Weather: station -> county mapping, global/local hourly means, shifted joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import cast_latlon
from .joins import SmallSide, left_join, materialize, shift_hours
from .sums import exact_mean, joined, parts

# Forecast horizon kept (hours ahead, inclusive) and the lags
# (hours) at which each weather mean is joined.
FORECAST_HORIZON = (22, 45)
FORECAST_LAGS = [0, 7 * 24]
HISTORICAL_LAGS = [2 * 24, 7 * 24]
HISTORICAL_MORNING_LAG = 24
HISTORICAL_MORNING_LAST_HOUR = 10

_KEYS = {"datetime", "county", "latitude", "longitude", "hours_ahead"}


def measures(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in _KEYS]


def station_side(station_map: DataFrame) -> SmallSide:
    """The station map, materialised once and broadcast if its size allows."""
    return SmallSide(cast_latlon(station_map).select("longitude", "latitude", "county"),
                     name="stations")


def map_stations(weather: DataFrame, stations: SmallSide | DataFrame) -> DataFrame:
    """Attach ``county`` by (longitude, latitude) as FLOAT; unmapped stations keep NULL."""
    right = stations.side() if isinstance(stations, SmallSide) else \
        cast_latlon(stations).select("longitude", "latitude", "county")
    return (cast_latlon(weather).join(right, on=["longitude", "latitude"], how="left")
            .drop("longitude", "latitude"))


def forecast_with_county(forecast: DataFrame, stations, horizon=FORECAST_HORIZON) -> DataFrame:
    """Forecast rows in the horizon window, renamed to ``datetime``, with county.

    ``horizon=None`` keeps every row with a non-null ``hours_ahead`` (the literal
    reading of the source filter, whose operator precedence defeats the range).
    """
    f = forecast.withColumnRenamed("forecast_datetime", "datetime")
    h = F.col("hours_ahead")
    f = f.filter(h.between(*horizon) if horizon else h.isNotNull()).drop("hours_ahead")
    return map_stations(f, stations)


def historical_with_county(historical: DataFrame, stations) -> DataFrame:
    return map_stations(historical, stations)


def global_mean(weather: DataFrame) -> DataFrame:
    """Hourly mean of every measure over all stations (mapped or not)."""
    return weather.groupBy("datetime").agg(*[exact_mean(F.col(f"`{m}`")).alias(m) for m in measures(weather)])


def local_mean(weather: DataFrame) -> DataFrame:
    """Hourly mean of every measure per county, over mapped stations only."""
    return (weather.filter(F.col("county").isNotNull()).groupBy("county", "datetime")
            .agg(*[exact_mean(F.col(f"`{m}`")).alias(m) for m in measures(weather)]))


def hourly_means(weather: DataFrame) -> DataFrame:
    """Global and per-county hourly means from one aggregation of the raw rows.

    Sums and counts per (county, hour) first, written once; both levels read that table,
    so the raw rows are scanned, expanded and shuffled no more than once. (Left lazy, the
    filter on the county would be pushed below one of two copies of the aggregate.) Sums
    are kept in parts that add exactly, so the means are those of ``global_mean`` and
    ``local_mean`` to the last bit, whatever the order of the rows.
    ``level`` 1 rows are the global means, over all stations; ``level`` 0 the
    per-county means, without the unmapped stations (NULL county).
    """
    ms = measures(weather)
    sums = [F.sum(p).alias(f"_s{i}_{j}") for i, m in enumerate(ms) for j, p in enumerate(parts(F.col(f"`{m}`")))]
    counts = [F.count(f"`{m}`").alias(f"_n{i}") for i, m in enumerate(ms)]
    hourly = materialize(weather.groupBy("county", "datetime").agg(*sums, *counts), "hourly-sums")
    whole = hourly.groupBy("datetime").agg(*[F.sum(c).alias(c) for c in hourly.columns if c.startswith("_")])
    means = [F.try_divide(joined([F.col(f"_s{i}_{j}") for j in range(5)]), F.col(f"_n{i}")).alias(m)
             for i, m in enumerate(ms)]

    def level(df, county, n):
        return df.select(county, "datetime", *means, F.lit(n).cast("byte").alias("level"))
    kind = hourly.schema["county"].dataType
    return level(hourly.filter(F.col("county").isNotNull()), F.col("county"), 0).unionByName(
        level(whole, F.lit(None).cast(kind).alias("county"), 1))


def means_side(weather: DataFrame, name: str) -> SmallSide:
    """Materialise ``hourly_means`` once; global and local sides derive from it."""
    return SmallSide(hourly_means(weather), name=name, counts={"whole": F.col("level") == 1})


def global_side(means: SmallSide) -> SmallSide:
    return means.derive(lambda d: d.filter(F.col("level") == 1).drop("county", "level"),
                        rows=means.counted.get("whole"))


def local_side(means: SmallSide) -> SmallSide:
    own = means.rows - means.counted["whole"] if "whole" in means.counted else None
    return means.derive(lambda d: d.filter(F.col("level") == 0).drop("level"), rows=own)


def join_lagged(features: DataFrame, side: SmallSide, keys: list[str], lags: list[int],
                suffix_fmt: str, transform=None) -> DataFrame:
    for h in lags:
        def shifted(df, h=h):
            df = shift_hours(df, h)
            return transform(df) if transform else df
        right = side.side(shifted)
        features = left_join(features, right, keys, suffix_fmt.format(h=h))
    return features


def add_forecast_features(features: DataFrame, forecast: DataFrame, stations,
                          horizon=FORECAST_HORIZON, lags=FORECAST_LAGS, scope=None) -> DataFrame:
    fw = forecast_with_county(forecast, stations, horizon)
    if scope is not None:
        fw = scope.restrict_hours(fw, lags)
    means = means_side(fw, "forecast_means")
    g, loc = global_side(means), local_side(means)
    for h in lags:
        features = join_lagged(features, g, ["datetime"], [h], "_forecast_{h}h")
        features = join_lagged(features, loc, ["county", "datetime"], [h], "_forecast_local_{h}h")
    return features


def morning_only(df: DataFrame) -> DataFrame:
    """Rows whose (shifted) hour is at most 10; the shift is whole days, so the hour
    is the same before and after it."""
    return df.filter(F.hour("datetime") <= HISTORICAL_MORNING_LAST_HOUR)


def add_historical_features(features: DataFrame, historical: DataFrame, stations,
                            lags=HISTORICAL_LAGS, scope=None) -> DataFrame:
    hw = historical_with_county(historical, stations)
    if scope is not None:
        hw = scope.restrict_hours(hw, list(lags) + [HISTORICAL_MORNING_LAG])
    means = means_side(hw, "historical_means")
    g, loc = global_side(means), local_side(means)
    for h in lags:
        features = join_lagged(features, g, ["datetime"], [h], "_historical_{h}h")
        features = join_lagged(features, loc, ["county", "datetime"], [h],
                               "_historical_local_{h}h")
    features = join_lagged(features, g, ["datetime"], [HISTORICAL_MORNING_LAG],
                           "_historical_{h}h", transform=morning_only)
    return features


__all__ = ["FORECAST_HORIZON", "FORECAST_LAGS", "HISTORICAL_LAGS", "SmallSide",
           "add_forecast_features", "add_historical_features", "forecast_with_county",
           "global_mean", "historical_with_county", "hourly_means", "local_mean",
           "map_stations", "station_side"]
