"""Quantile bins and missing flags of model inputs.

A feature's bins come from a mergeable quantile sketch (KLL): every task folds its
rows into one sketch a feature, the shuffle moves sketches, and the edges are computed
once and shared by all folds and fits. Sketches of parts (days, folds, new
batches) can be kept and merged, so edges need not be taken from the rows again.

The rank error of an edge falls with ``k`` (about 1.7 / k of the rows at these sizes,
with high probability); up to ``k`` rows a sketch holds all values and edges are exact.
NULL and NaN are missing: they are not in the sketch, have a flag, and get bin -1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS, K = 255, 4096


def _value(c: str) -> Column:
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)


def sketches(df: DataFrame, features: list[str], k: int = K) -> DataFrame:
    """(feature, sketch, n, n_missing): one row per feature. Long form, so that a wide
    table is one hash aggregate of a few columns, combined before the shuffle."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), _value(c).alias("x"))
                                         for c in features])).alias("f")).select("f.*")
    return long.groupBy("feature").agg(
        F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"), F.count("x").alias("n"),
        F.count_if(F.col("x").isNull()).alias("n_missing"))


def merge_sketches(parts: DataFrame) -> DataFrame:
    """Sketches of several parts, one per feature."""
    return parts.groupBy("feature").agg(F.kll_merge_agg_double("sketch").alias("sketch"),
                                        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"))


def bin_edges(sketched: DataFrame, bins: int = BINS) -> DataFrame:
    """(feature, edges): at most ``bins`` - 1 rising values. A value lies in the bin
    numbered by the edges under it. A feature without values has no edges."""
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", ranks)))
    return sketched.select("feature", F.when(F.col("n") > 0, edges).otherwise(
        F.array().cast("array<double>")).alias("edges"))


def edge_lists(edges: DataFrame) -> dict[str, list[float]]:
    """The edges on the driver: features x bins numbers, whatever the rows."""
    return {r["feature"]: list(r["edges"]) for r in edges.collect()}


def missing_flag(c: str) -> Column:
    return _value(c).isNull()


def with_bins(df: DataFrame, edges: dict[str, list[float]], bin_suffix: str = "__b",
              flag_suffix: str = "__m") -> DataFrame:
    """``df`` with a bin and a missing flag for every feature of ``edges``. Bins by Spark
    ML's Bucketizer, a binary search per value; its intervals are closed below, so an
    edge value itself is moved down by one step."""
    from pyspark.ml.feature import Bucketizer
    own = list(edges)
    edges = {c: [e for e in v if e < math.inf] for c, v in edges.items()}  # nothing lies above
    flagged = df.withColumns({f"{c}{flag_suffix}": missing_flag(c).cast("int") for c in own}
                             | {f"__x_{i}": _value(c) for i, c in enumerate(own)})
    inner = [i for i, c in enumerate(own) if edges[c]]
    if inner:
        flagged = Bucketizer(splitsArray=[splits(edges[own[i]]) for i in inner], inputCols=[f"__x_{i}" for i in inner],
                             outputCols=[f"__b_{i}" for i in inner], handleInvalid="keep").transform(flagged)
    bins = {f"{c}{bin_suffix}": F.when(F.col(f"__x_{i}").isNull(), -1).otherwise(
        F.col(f"__b_{i}").cast("int") if i in inner else F.lit(0)) for i, c in enumerate(own)}
    return flagged.withColumns(bins).drop(*[f"__x_{i}" for i in range(len(own))], *[f"__b_{i}" for i in inner])


def splits(edges: list[float], floor: float | None = None) -> list[float]:
    """Bucketizer's splits, by which bin = number of edges under the value. ``floor``: a
    stand-in for missing values, which gets bin 0, so that values start at bin 1."""
    inner = sorted({math.nextafter(e, math.inf) for e in edges if e < math.inf}
                   | ({math.nextafter(floor, math.inf)} if floor is not None else set()))
    return [-math.inf, *inner, math.inf]
