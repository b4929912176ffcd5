"""Row scope: restrict each source to the hours a set of prediction rows can use.

Scoring a day of new rows must not aggregate years of weather or look through the
whole target history. One aggregate gives the rows' first and last hour; every
source is then cut to the hours its lags reach back to from there, by a literal
compare that reaches the scan. The joins return exactly what they would on the
full sources, the plan is the same for any number of rows, and nothing is
collected but the two hours.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RowScope:
    def __init__(self, first: dt.datetime | None, last: dt.datetime | None):
        self.first, self.last = first, last

    @classmethod
    def probe(cls, rows: DataFrame) -> "RowScope":
        return cls(*rows.agg(F.min("datetime"), F.max("datetime")).first())

    def restrict_hours(self, df: DataFrame, lags: list[int]) -> DataFrame:
        """The rows of ``df`` that ``lags`` (hours) can reach back to."""
        if self.first is None:  # no row has a time, so nothing is looked up
            return df.filter(F.lit(False))
        def at(t, h):
            return F.lit((t - dt.timedelta(hours=h)).isoformat(sep=" ")).cast("timestamp_ntz")
        return df.filter(F.col("datetime").between(at(self.first, max(lags)), at(self.last, min(lags))))
