"""The feature build: one lazy plan from the prediction rows to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import add_general_features, is_ee_holiday
from ..functions.holidays import is_holiday, rules_for
from ..operators.client import add_client_features
from ..operators.joins import SmallSide
from ..operators.scope import RowScope
from ..operators.target import add_target_features
from ..operators.weather import (FORECAST_HORIZON, add_forecast_features,
                                 add_historical_features, station_side)
from ..sources.storage import TableBundle

# Fixed value: helper columns dropped at the end of the build.
DROPPED_HELPERS = ["date", "datetime", "hour", "dayofyear"]


def downcast_floats(df: DataFrame, keep: tuple[str, ...] = ("target",)) -> DataFrame:
    """Every DOUBLE column to FLOAT (except ``keep``), in one projection."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("float").alias(f.name)
        if isinstance(f.dataType, T.DoubleType) and f.name not in keep else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def add_holiday_flag(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """``is_holiday`` = the row's ``date`` is in ``holidays(date)`` (a left join to a
    small dimension instead of a per-row lookup)."""
    side = SmallSide(holidays.select("date").distinct().withColumn("is_holiday", F.lit(True)))
    return (df.join(side.side(), on="date", how="left")
            .withColumn("is_holiday", F.coalesce(F.col("is_holiday"), F.lit(False))))


class FeatureBuilder:
    """Builds the feature table from a :class:`TableBundle`.

    ``lag_strategy``: "auto" (default: "in_place" for training rows that are the
    history itself, else "windows"), "in_place" (bucketed windows over the rows' own
    series, no join), "windows" (the same over rows and history together), "fused"
    (history fanned out once for all 13 lags, one join) or "plain" (one join per
    lag); all give the same rows. ``horizon``: forecast hours kept,
    ``None`` for every non-null horizon.
    """

    def __init__(self, tables: TableBundle, lag_strategy: str = "auto",
                 horizon=FORECAST_HORIZON, holidays: DataFrame | None = None):
        self.tables = tables
        self.lag_strategy = lag_strategy
        self.horizon = horizon
        self.holidays = holidays
        self._stations = None

    def stations(self) -> SmallSide:
        if self._stations is None:
            self._stations = station_side(self.tables.station_map)
        return self._stations

    # The steps, each DataFrame -> DataFrame, in the order the features are built.
    def general(self, df: DataFrame) -> DataFrame:
        return add_general_features(df)

    def client(self, df: DataFrame) -> DataFrame:
        return add_client_features(df, self.tables.client)

    def forecast(self, df: DataFrame, scope=None) -> DataFrame:
        return add_forecast_features(df, self.tables.forecast_weather, self.stations(),
                                     horizon=self.horizon, scope=scope)

    def historical(self, df: DataFrame, scope=None) -> DataFrame:
        return add_historical_features(df, self.tables.historical_weather, self.stations(),
                                       scope=scope)

    def target(self, df: DataFrame, scope=None, strategy: str | None = None) -> DataFrame:
        return add_target_features(df, self.tables.target,
                                   strategy=strategy or self.lag_strategy, scope=scope)

    def generate(self, rows: DataFrame, country: str = "EE", has_target: bool = True,
                 drop_helpers: bool = True, scope: bool | None = None) -> DataFrame:
        """Feature table for ``rows`` (training rows with ``target``, or test rows).

        ``target`` is carried through as a column (never re-attached by position) and
        stays DOUBLE; rows with a NULL target are dropped when ``has_target``.
        ``scope``: cut every source down to what the rows can look up (see
        ``operators.scope``). Default: on for test rows, off for training rows (which
        are the history itself).
        """
        with_target = "target" in rows.columns
        use_scope = (not has_target) if scope is None else scope
        sc = RowScope.probe(rows) if use_scope else None
        df = rows.withColumn("date", F.col("datetime").cast("date"))
        df = self.general(df)
        order = {"general": df.columns}
        # The target lags are the one step that shuffles the rows (windows over their
        # own series, or over them and the history), so they run first, while the
        # rows are narrow; every later
        # join is a size-checked broadcast and adds its columns map-side.
        strategy = self.lag_strategy
        if strategy == "auto":
            is_history = (rows is self.tables.data and self.tables.target_is_data
                          and with_target)
            strategy = "in_place" if is_history else "windows"
        df = self.target(df, sc, strategy)
        order["target"] = [c for c in df.columns if c not in order["general"]]
        df = self.client(df)
        df = self.forecast(df, sc)
        df = self.historical(df, sc)
        seen = set(order["general"]) | set(order["target"])
        rest = [c for c in df.columns if c not in seen]
        df = df.select(*[F.col(f"`{c}`") for c in order["general"] + rest + order["target"]])
        df = downcast_floats(df)
        if self.holidays is not None:
            df = add_holiday_flag(df, self.holidays)
        elif country == "EE":
            df = df.withColumn("is_holiday", is_ee_holiday(F.col("date")))
        else:
            df = df.withColumn("is_holiday", is_holiday(F.col("date"), rules_for(country)))
        if drop_helpers:
            df = df.drop(*DROPPED_HELPERS)
        if with_target and has_target:
            df = df.na.drop(subset=["target"])
        return df


def generate_features(tables: TableBundle, rows: DataFrame | None = None, **kw) -> DataFrame:
    builder = FeatureBuilder(tables, **{k: kw.pop(k) for k in ("lag_strategy", "horizon", "holidays")
                                        if k in kw})
    return builder.generate(tables.data if rows is None else rows, **kw)
