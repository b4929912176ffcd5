"""Helpers the text operators share: reading, let-binding, prefix sums, slots."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the white space that separates words in every contract here.
WORD_JAVA = "[^\\x20\\x09-\\x0D]+"
WORD_PYTHON = r"[^\x20\x09-\x0D]+"

# Rows an Arrow batch may hold on its way to Python. Texts can be long, so the
# default of 10,000 rows could be gigabytes.
ARROW_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir`` through Spark's reader, so any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_arrow(spark: SparkSession) -> None:
    """Hold Arrow batches to ``ARROW_ROWS`` rows in this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(ARROW_ROWS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it.

    A plain reference inside a lambda would be inlined and computed per element.
    """
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The words of a text (null: none), in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_JAVA), F.lit(0))


def add_all(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def prefix_sums(values: Column, block: int = 128) -> Column:
    """Exclusive prefix sums of a non-empty ``array<bigint>``.

    Two levels (sums of blocks, then within a block), since a fold that appends
    to an array copies it at every step.
    """
    def within(v, blocks):
        def at(i):
            b = F.floor(i / block).cast("int")
            return (add_all(F.slice(blocks, F.lit(1), b))
                    + add_all(F.slice(v, b * block + 1, (i % block).cast("int"))))
        return F.transform(F.sequence(F.lit(0), F.size(v) - 1), at)

    def blocks_of(v):
        last = F.floor((F.size(v) - 1) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), last),
                           lambda b: add_all(F.slice(v, b * block + 1, F.lit(block))))

    return let(values, lambda v: let(blocks_of(v), lambda blocks: within(v, blocks)))


def running_total(df: DataFrame, group: list[str], order: list[str], weight: Column, rows: int,
                  out: str) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the same group that come
    before, in some fixed order, without one task per group.

    Rows are dealt to about sqrt(``rows``) slices by the hash of their order
    columns, summed inside (group, slice), and shifted by the totals of the slices
    before. Only those totals, one per (group, slice), meet in a window. Rows that
    agree in all order columns are interchangeable.
    """
    slices = max(1, math.isqrt(max(0, rows)))
    cut = (df.withColumn("__w", weight.cast("bigint"))
           .withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int")))
    keys = [*group, "__slice"]
    totals = cut.groupBy(*keys).agg(F.sum("__w").alias("__t"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (cut.withColumn("__in", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
            .join(offsets, keys)
            .withColumn(out, F.col("__off") + F.col("__in"))
            .drop("__w", "__slice", "__in", "__off"))
