"""Client snapshot features: the snapshot published two days after ``date``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import SmallSide

# Fixed value: the client table for day D is available to rows of day D + 2.
CLIENT_DELAY_DAYS = 2
CLIENT_KEYS = ["county", "is_business", "product_type", "date"]


def shifted_client(client: DataFrame, days: int = CLIENT_DELAY_DAYS) -> DataFrame:
    return client.withColumn("date", F.date_add(F.col("date"), days))


def add_client_features(features: DataFrame, client: DataFrame) -> DataFrame:
    """Left join on (county, is_business, product_type, date) to the shifted snapshot.

    The client table is per day x segment (bounded by the calendar), so it is
    materialised and broadcast when its measured size allows."""
    side = SmallSide(shifted_client(client).select(*CLIENT_KEYS, "eic_count",
                                                   "installed_capacity"))
    return features.join(side.side(), on=CLIENT_KEYS, how="left")
