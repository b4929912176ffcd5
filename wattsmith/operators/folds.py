"""Expanding time-series folds by row position, computed without a global sort.

Rows are ordered by (datetime, row_id). With ``n`` rows and ``k`` splits the test
size is ``t = n div (k + 1)``; fold ``i`` tests positions
``[n - (k - i) t, n - (k - i - 1) t)`` and trains on every earlier position.
Each row gets one ``fold`` number: ``-1`` (train only) or the fold it is tested in;
the training set of fold ``i`` is ``fold < i``.

A row's position is (rows in earlier hours) + (its rank inside its hour). Hour
totals come from one aggregation; only the at most ``k`` hours that contain a fold
boundary need ranks inside the hour, and those come from a range-partitioned sort
so that even a huge hour is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import SmallSide, materialize

# Fixed value: number of splits the notebooks use.
N_SPLITS = 6


def ordered_positions(df: DataFrame, order_cols: list[str], num_partitions: int | None = None,
                      pos_col: str = "pos") -> DataFrame:
    """0-based position of each row in the total order ``order_cols`` (must be unique).

    Range partitioning splits the order into contiguous slices over many tasks; the
    rows of each slice are sorted, numbered, and shifted by the sizes of the slices
    before it (a table with one row per slice). Materialised once so both uses see
    the same slices.
    """
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_idx", F.monotonically_increasing_id()))
    ranged = materialize(ranged.withColumn(
        "_idx", F.col("_idx") - F.shiftleft(F.col("_pid").cast("long"), 33)))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (ranged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(pos_col, F.col("_off") + F.col("_idx"))
            .drop("_pid", "_idx", "_off"))


def cumulative_counts(counts: DataFrame, time_col: str) -> DataFrame:
    """``counts`` (one row per time, ``_cnt``) with ``_start``, the rows at earlier times.

    Times may be as many as the rows (seconds, say), so they are cut into contiguous
    slices, summed inside each, and shifted by the totals of the slices before: only
    one row per slice meets in a window.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(counts.repartitionByRange(parts, time_col).withColumn("_pid", F.spark_partition_id()))
    totals = ranged.groupBy("_pid").agg(F.sum("_cnt").alias("_t"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid").orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    return materialize(
        ranged.withColumn("_in", F.coalesce(F.sum("_cnt").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_pid").withColumn("_start", F.col("_off") + F.col("_in"))
        .drop("_pid", "_in", "_off"))


def assign_folds(df: DataFrame, n_splits: int = N_SPLITS, time_col: str = "datetime",
                 tie_col: str = "row_id") -> DataFrame:
    """``df`` plus ``fold`` (see module doc)."""
    hours = cumulative_counts(df.groupBy(time_col).agg(F.count(F.lit(1)).alias("_cnt")), time_col)
    n = hours.agg(F.coalesce(F.sum("_cnt"), F.lit(0))).first()[0]
    t = n // (n_splits + 1)
    first = n - n_splits * t

    def fold_of(pos):
        return F.when(pos < F.lit(first), F.lit(-1)).otherwise(
            F.floor((pos - F.lit(first)) / F.lit(max(t, 1))).cast("int"))

    start, end = F.col("_start"), F.col("_start") + F.col("_cnt") - 1
    hours = hours.withColumn("_f0", fold_of(start)).withColumn("_f1", fold_of(end))
    side = SmallSide(hours.select(F.col(time_col).alias("_hour"), "_start", "_f0", "_f1"), materialized=True)
    # Rows without a time come first, in Spark's order, and belong to folds like any other.
    tagged = df.join(side.side(), F.col(time_col).eqNullSafe(F.col("_hour"))).drop("_hour")
    whole = tagged.filter(F.col("_f0") == F.col("_f1")).withColumn("fold", F.col("_f0"))
    split = tagged.filter(F.col("_f0") != F.col("_f1"))
    ranked = ordered_positions(split, [time_col, tie_col], pos_col="_pos")
    # _pos counts rows of boundary hours only; add back the rows of whole hours
    # in between by using the hour start plus the rank inside the hour.
    first_in_hour = ranked.groupBy(F.col(time_col).alias("_hour")).agg(F.min("_pos").alias("_p0"))
    ranked = (ranked.join(F.broadcast(first_in_hour), F.col(time_col).eqNullSafe(F.col("_hour")))
              .withColumn("fold", fold_of(F.col("_start") + F.col("_pos") - F.col("_p0")))
              .drop("_pos", "_p0", "_hour"))
    cols = df.columns + ["fold"]
    return whole.select(*cols).unionByName(ranked.select(*cols))
