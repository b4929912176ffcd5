"""The target history as a bucketed table: lags and upserts read it without an exchange.

Every lag of a row lies in the row's own time block or the one before, if a block is at
least as long as the longest lag. The table holds each history row under its own block
and, as a lag source only (``own`` false), under the next one, bucketed by (segment,
block): a segment with a third of all rows is spread over its blocks. Windows over
(segment, block) then find their rows in place, and an upsert moves only the batch.

``segment`` is the key columns as one text, so NULL keys are a segment like any other.
A row without a time is under block -1 and is no lag source. Keys must be unique, as
for every lag here (``update.duplicate_keys``); ``upsert_history`` keeps them so.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import SmallSide, maybe_broadcast, scratch_path
from .target import SEGMENT_TIME_KEYS, TARGET_LAGS, exact_lags, hours_since_1970
from .update import keep_newest, union_batches

BLOCK_HOURS = max(TARGET_LAGS)
PLACE = ["segment", "block"]
_KEYS = [k for k in SEGMENT_TIME_KEYS if k != "datetime"]


def placed(history: DataFrame) -> DataFrame:
    """``history`` (keys, datetime, target and any further columns) with ``segment``,
    ``block`` and ``own``: a row for its own block and one for the next."""
    block = F.floor(hours_since_1970() / F.lit(BLOCK_HOURS)).cast("long")
    place = F.when(F.col("datetime").isNull(), F.array(F.struct(F.lit(-1).cast("long").alias("block"), F.lit(True).alias("own"))))
    place = place.otherwise(F.array(F.struct(block.alias("block"), F.lit(True).alias("own")),
                                    F.struct((block + 1).alias("block"), F.lit(False).alias("own"))))
    segment = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in _KEYS])
    return history.select("*", segment.alias("segment"), F.inline(place))


def _buckets(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def _save(df: DataFrame, table: str | None, buckets: int) -> str:
    table = table or f"history_{uuid.uuid4().hex}"
    (df.write.format("parquet").bucketBy(buckets, *PLACE).sortBy(*PLACE, "datetime")
     .option("path", scratch_path(df.sparkSession, table)).saveAsTable(table))
    return table


def write_history(history: DataFrame, table: str | None = None, buckets: int | None = None) -> str:
    """Write ``history`` as a bucketed table in the shared folder; its name. The rows are
    shuffled this once, to as many buckets as shuffles have partitions by default, so
    that a bucket is one file."""
    n = buckets or int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _save(placed(history).repartition(n, *PLACE), table, n)


def read_history(spark: SparkSession, table: str) -> DataFrame:
    """The history's rows, each once, with its own columns."""
    return spark.table(table).filter("own").drop(*PLACE, "own")


def history_lags(spark: SparkSession, table: str, lags=TARGET_LAGS, name: str = "target") -> DataFrame:
    """The history's rows with ``{name}_{h}h``, the target exactly ``h`` hours earlier in
    the segment: windows over the buckets, no exchange."""
    if max(lags) > BLOCK_HOURS:
        raise ValueError(f"lags reach {max(lags)} hours back, blocks have {BLOCK_HOURS}")
    rows = spark.table(table).withColumnRenamed("own", "_own")
    return exact_lags(rows, "target", list(lags), name, PLACE).drop(*PLACE, "_own")


def upsert_history(spark: SparkSession, table: str, new: DataFrame, to: str | None = None) -> str:
    """A new table: ``table`` with ``new`` merged in, newest wins; its name.

    Only the batch is shuffled, to the table's own buckets. It is folded to one row per
    (segment, block) with the hours it replaces, ``BLOCK_HOURS`` at most, each as an own
    row and as a lag source, so that the join is on the buckets' columns alone."""
    old = spark.table(table)
    cols = [c for c in old.columns if c not in (*PLACE, "own")]
    n = _buckets(spark, table)
    batch = SmallSide(placed(keep_newest(union_batches(new.select(*cols)), SEGMENT_TIME_KEYS).select(*cols)), name="batch")
    moved = batch.df.select(*old.columns).repartition(n, *PLACE)
    hours = moved.groupBy(*PLACE).agg(F.collect_set(F.struct("own", "datetime")).alias("_hours")).select(
        F.col("segment").alias("_segment"), F.col("block").alias("_block"), "_hours")
    replaced = ((F.col("segment") == F.col("_segment")) & (F.col("block") == F.col("_block"))
                & F.array_contains("_hours", F.struct("own", "datetime")))
    kept = old.join(maybe_broadcast(hours, batch.broadcast), replaced, "left_anti")
    return _save(kept.unionByName(moved), to, n)
