"""The incremental update as a stream: new batches arrive as files, and of each key the
row of the newest file is kept.

A table is a folder: ``base``, unique by key, and ``batches/<stream>/<batch>``, one
folder for each micro-batch. A micro-batch only writes its own folder, named by the
stream's and the batch's id, so a batch run again writes the same folder again; Spark's
checkpoint alone says what is done. Every row carries when its file was written
(``ARRIVED``). That decides which row is newest, so the result depends on the
files and neither on the order of batches nor on how often they ran: a new checkpoint
that reads all files again changes nothing, and two streams may write at once.

``updated`` merges at reading time; the batches' newest rows are one counted join side
and the base is not shuffled while they fit the broadcast budget. ``compact`` writes
the merged state as the base of another folder when batches have grown many.
"""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import SmallSide, scratch_path
from ..operators.update import upsert

ARRIVED = "_arrived"  # microseconds: the file's modification time; 0 for the initial load


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def newest_arrived(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: of the newest file, and of several in it the one whose values
    hash highest. One number orders the rows, so all columns come from the same row."""
    values = [c for c in rows.columns if c not in keys and c != ARRIVED]
    tie = F.shiftrightunsigned(F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in values]), 1).cast("decimal(19,0)")
    order = F.col(ARRIVED).cast("decimal(18,0)") * F.lit(Decimal(10**19)) + tie
    newest = rows.withColumn("_order", order).groupBy(*keys).agg(
        *[F.max_by(f"`{c}`", "_order").alias(c) for c in values], F.max(ARRIVED).alias(ARRIVED))
    return newest.select(*[F.col(f"`{c}`") for c in rows.columns])


def merge_arrived(base: DataFrame, batches: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` (unique by key) with the rows of ``batches`` that are as new or newer in
    place of its own, and those of further keys."""
    batch = SmallSide(newest_arrived(batches.select(*base.columns), keys), name="arrived")
    names = {k: f"_new_{k}" for k in keys}
    new = batch.side(lambda d: d.select(*[F.col(k).alias(n) for k, n in names.items()],
                                        F.col(ARRIVED).alias("_new_arrived")))
    same = _same(names)
    kept = base.join(new, same & (F.col("_new_arrived") >= F.col(ARRIVED)), "left_anti")
    held = base.join(new, same & (F.col("_new_arrived") < F.col(ARRIVED)), "left_semi")
    held = SmallSide(held.select(*[F.col(k).alias(n) for k, n in names.items()]), name="held")
    return kept.unionByName(batch.df.join(held.side(), _same(names), "left_anti"))


def _same(names: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])


def init_table(df: DataFrame, table_root: str, keys: list[str]) -> None:
    """Write ``df`` as the base of a new table, one row per key."""
    newest_arrived(df.withColumn(ARRIVED, F.lit(0).cast("bigint")), keys).write.parquet(f"{_root(table_root)}/base")


def _root(table_root: str) -> str:
    return table_root.rstrip("/")


def finished_batches(spark: SparkSession, table_root: str) -> list[str]:
    """The batch folders whose write has ended."""
    fs, path = _fs(spark, f"{_root(table_root)}/batches/*/*/_SUCCESS")
    return sorted(st.getPath().getParent().toString() for st in fs.globStatus(path) or [])


def _state(spark: SparkSession, table_root: str, keys: list[str]) -> DataFrame:
    base = spark.read.parquet(f"{_root(table_root)}/base")
    done = finished_batches(spark, table_root)
    return merge_arrived(base, spark.read.parquet(*done), keys) if done else base


def updated(spark: SparkSession, table_root: str, keys: list[str]) -> DataFrame:
    """The table as of now: the newest row of every key."""
    return _state(spark, table_root, keys).drop(ARRIVED)


def compact(spark: SparkSession, table_root: str, keys: list[str], new_root: str) -> None:
    """Write the table's present state as the base of the new table ``new_root``. Its rows
    keep their times, so batches that reach ``table_root`` later can be merged too."""
    _state(spark, table_root, keys).write.parquet(f"{_root(new_root)}/base")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream of this checkpoint (a new checkpoint has a new one)."""
    return json.loads(spark.read.text(f"{_root(checkpoint)}/metadata").first()[0])["id"]


def write_batch(batch: DataFrame, table_root: str, keys: list[str], stream: str, batch_id: int) -> str:
    """Write one micro-batch (with ``ARRIVED``) as its folder, in place of an earlier try."""
    path = f"{_root(table_root)}/batches/{stream}/{batch_id:012d}"
    newest_arrived(batch, keys).write.mode("overwrite").parquet(path)
    return path


def start_update_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                        keys: list[str], table_root: str, checkpoint: str,
                        fmt: str = "parquet", available_now: bool = True):
    """Add every new file under ``source_dir`` to the table at ``table_root``, which must
    exist (``init_table``). Columns its base lacks are left out."""
    stream = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        stream = stream.option("header", True)
    columns = [c for c in spark.read.parquet(f"{_root(table_root)}/base").columns if c != ARRIVED]
    source = stream.load(source_dir).select(
        *[F.col(f"`{c}`") for c in columns], F.unix_micros("_metadata.file_modification_time").alias(ARRIVED))

    def add(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, table_root, keys, stream_id(batch.sparkSession, checkpoint), batch_id)

    writer = source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()


def merge_into_partitioned(batch: DataFrame, table_path: str, keys: list[str],
                           part_col: str = "day", time_col: str = "datetime") -> None:
    """Merge ``batch`` into a Parquet table partitioned by ``part_col`` (the day of
    ``time_col``), rewriting only the partitions the batch touches.

    The batch's first and last day prune the read statically and its distinct days
    (a join side, broadcast only if its counted size allows) cut it to the touched
    ones; rows without a time have a day too, the null one. The table is unique by
    key and every key lies in one day, so the merge per touched day is exact. The
    result is staged in the checkpoint folder first (a path cannot be read and
    overwritten in one job), then written with dynamic partition overwrite.
    """
    spark = batch.sparkSession
    batch = batch.withColumn(part_col, F.col(time_col).cast("date"))
    days = SmallSide(batch.select(F.col(part_col).alias("_day")).distinct(), name="days")
    lo, hi, nulls = days.df.agg(F.min("_day"), F.max("_day"), F.count_if(F.col("_day").isNull())).first()
    day = F.col(part_col)
    span = day.between(F.lit(lo), F.lit(hi)) if lo is not None else F.lit(False)
    current = spark.read.parquet(table_path).filter(span | day.isNull() if nulls else span)
    current = current.join(days.side(), current[part_col].eqNullSafe(F.col("_day")), "left_semi")
    merged = upsert(current, batch.select(*current.columns), keys, current_unique=True)
    staged = scratch_path(spark, "merge")
    merged.write.parquet(staged)
    (spark.read.parquet(staged).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(table_path))
    fs, p = _fs(spark, staged)
    fs.delete(p, True)


def start_partitioned_update_stream(spark: SparkSession, source_dir: str, schema: T.StructType,
                                    keys: list[str], table_path: str, checkpoint: str,
                                    time_col: str = "datetime", fmt: str = "parquet",
                                    available_now: bool = True):
    """As ``start_update_stream``, but the table is one Parquet path partitioned by
    day and each micro-batch rewrites only the days it touches. The table must
    already exist, unique by key (e.g. written by ``init_partitioned_table``)."""
    stream = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        stream = stream.option("header", True)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_into_partitioned(batch, table_path, keys, time_col=time_col)

    writer = (stream.load(source_dir).writeStream.foreachBatch(merge)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()


def init_partitioned_table(df: DataFrame, table_path: str, keys: list[str],
                           part_col: str = "day", time_col: str = "datetime") -> None:
    """Write the initial table deduplicated by key and partitioned by day."""
    from ..operators.update import keep_newest, union_batches
    unique = keep_newest(union_batches(df), keys).select(*df.columns)
    (unique.withColumn(part_col, F.col(time_col).cast("date")).write.mode("overwrite")
     .partitionBy(part_col).parquet(table_path))


def dedupe_stream(source: DataFrame, keys: list[str], event_time: str,
                  delay: str = "2 days") -> DataFrame:
    """Append-only variant: drop repeats of a key within the watermark delay.
    (Watermarks need TIMESTAMP, so an NTZ event time is cast first.)"""
    ts = F.col(event_time).cast("timestamp")
    return (source.withColumn("_event_ts", ts).withWatermark("_event_ts", delay)
            .dropDuplicatesWithinWatermark(keys).drop("_event_ts"))


__all__ = ["compact", "dedupe_stream", "finished_batches", "init_partitioned_table", "init_table",
           "merge_arrived", "merge_into_partitioned", "newest_arrived", "start_partitioned_update_stream",
           "start_update_stream", "updated", "write_batch"]
