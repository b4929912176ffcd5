"""Incremental update: union a new batch into a table and keep one row per key.

"Newest wins": every row carries its batch sequence number and the row with the
highest one is kept. The choice is ``max_by`` per column under one order, the
sequence number and then a hash of the row, so Spark keeps fixed-width columns in a
hash aggregate, combines map-side before the shuffle, and takes all columns from
the same row; a hot key never lands whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.readers import enforce_schema
from ..sources.schemas import UPDATE_KEYS
from .joins import SmallSide

SEQ = "_batch_seq"
_ORDER = "_row_order"


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (one partial-aggregated
    pass). The fused lags and the key-unique upsert assume this is empty."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def assert_unique(df: DataFrame, keys: list[str], name: str = "table") -> None:
    """Raise if ``df`` has a repeated key (reads a few examples, never the table)."""
    dup = duplicate_keys(df, keys).limit(5).collect()
    if dup:
        raise ValueError(f"{name}: {len(dup)}+ repeated keys on {keys}, e.g. {dup[0].asDict()}")


def union_batches(*batches: DataFrame) -> DataFrame:
    """Union by column name, tagging each batch with its position (0 = oldest)."""
    tagged = [b.withColumn(SEQ, F.lit(i)) for i, b in enumerate(batches)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out


def keep_newest(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys``: the one from the newest batch (of several in that batch,
    the one whose values hash highest, so the choice repeats)."""
    values = [c for c in tagged.columns if c not in keys and c != SEQ]
    if not values:
        return tagged.select(*keys).distinct()
    tie = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in values]), 16)
    ranked = tagged.withColumn(_ORDER, F.shiftleft(F.col(SEQ).cast("long"), 48) + tie)
    return ranked.groupBy(*keys).agg(*[F.max_by(f"`{c}`", _ORDER).alias(c) for c in values])


def upsert(current: DataFrame, new: DataFrame, keys: list[str], schema=None,
           current_unique: bool = False) -> DataFrame:
    """``current`` with ``new`` merged in; ``new`` is first cast to ``schema``
    (the types captured at load) and projected to ``current``'s columns.

    ``current_unique``: the caller knows ``current`` has one row per key (true of
    every table this function produced). Then only the batch needs deduplicating:
    current rows whose key the batch carries are dropped by an anti-join (a
    broadcast one when the batch measures small), and the big table is never
    shuffled. Otherwise the union of both is deduplicated (exact on any input).
    """
    cols = current.columns
    new = enforce_schema(new, schema, cols) if schema is not None else new.select(*cols)
    if not current_unique:
        return keep_newest(union_batches(current, new), keys).select(*cols)
    batch = SmallSide(keep_newest(union_batches(new), keys).select(*cols), name="batch")
    held = batch.side(lambda d: d.select(*[F.col(k).alias(f"_new_{k}") for k in keys]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    kept = current.join(held, same, "left_anti")  # null-safe, as grouping by key is
    return kept.select(*cols).unionByName(batch.df)


def update_tables(tables, new_client=None, new_gas_prices=None, new_electricity_prices=None,
                  new_forecast_weather=None, new_historical_weather=None, new_target=None,
                  tables_unique: bool = False):
    """Apply one batch of new rows to every table of a ``TableBundle``
    (``tables_unique``: the bundle came out of an earlier update, see ``upsert``)."""
    schemas = tables.schemas()
    changes = {}
    for field, name, new in [("client", "client", new_client),
                             ("gas_prices", "gas_prices", new_gas_prices),
                             ("electricity_prices", "electricity_prices", new_electricity_prices),
                             ("forecast_weather", "forecast_weather", new_forecast_weather),
                             ("historical_weather", "historical_weather", new_historical_weather),
                             ("target", "target", new_target)]:
        if new is not None:
            changes[field] = upsert(getattr(tables, field), new, UPDATE_KEYS[name],
                                    schemas[name], current_unique=tables_unique)
    return tables.with_tables(**changes)
