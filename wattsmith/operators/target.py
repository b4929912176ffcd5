"""Target history features: sums, exact-hour lags, row statistics and ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rowwise import row_mean, row_std, safe_ratio
from .joins import SmallSide, left_join, shift_hours
from .sums import exact_sum

# ---------------------------------------------------------------------------
# Lag hours, the columns the row statistics use, and the ratio
# pairs (prefix, numerator lag, denominator lag).
# ---------------------------------------------------------------------------
TARGET_LAGS = [2 * 24, 3 * 24, 4 * 24, 5 * 24, 6 * 24, 7 * 24, 8 * 24, 9 * 24, 10 * 24,
               11 * 24, 12 * 24, 13 * 24, 14 * 24]
SUM_LAGS = [2 * 24, 3 * 24, 7 * 24, 14 * 24]
STATS_LAGS = [2 * 24, 3 * 24, 4 * 24, 5 * 24]
RATIOS = [
    ("target", 24 * 7, 24 * 14),
    ("target", 24 * 2, 24 * 9),
    ("target", 24 * 3, 24 * 10),
    ("target", 24 * 2, 24 * 3),
    ("target_all_type_sum", 24 * 2, 24 * 3),
    ("target_all_type_sum", 24 * 7, 24 * 14),
    ("target_all_county_type_sum", 24 * 2, 24 * 3),
    ("target_all_county_type_sum", 24 * 7, 24 * 14),
]
SEGMENT_TIME_KEYS = ["county", "is_business", "product_type", "is_consumption", "datetime"]
# Join/group key order for the lag join: hour first, the same order the rows are
# clustered in when they come out of an hourly aggregation, so the lag table's
# own aggregation already satisfies the join and adds no exchange.
LAG_JOIN_KEYS = ["datetime", "county", "is_business", "product_type", "is_consumption"]
TYPE_SUM_KEYS = ["county", "is_business", "is_consumption", "datetime"]
COUNTY_TYPE_SUM_KEYS = ["is_business", "is_consumption", "datetime"]
# ---------------------------------------------------------------------------


def summed(target: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of ``target`` per key set, whatever the order of the rows; a group whose targets
    are all NULL sums to 0."""
    return target.groupBy(*keys).agg(F.coalesce(exact_sum(F.col("target")), F.lit(0.0)).alias("target"))


def type_sum(target: DataFrame) -> DataFrame:
    return summed(target, TYPE_SUM_KEYS)


def county_type_sum(target: DataFrame) -> DataFrame:
    return summed(target, COUNTY_TYPE_SUM_KEYS)


def lag_table(history: DataFrame, keys: list[str], lags: list[int], name: str) -> DataFrame:
    """One row per (keys, datetime) with ``{name}_{h}h`` = value at ``datetime - h``.

    Each history row is fanned out to its ``len(lags)`` future positions (a narrow
    row each) and folded back with one aggregation, so the history is shuffled once
    for all lags instead of once per lag. Requires unique history keys.
    """
    part = [k for k in keys if k != "datetime"]
    shifted = F.explode(F.array(*[
        F.struct(F.lit(h).alias("lag"),
                 (F.col("datetime") + F.make_dt_interval(F.lit(0), F.lit(h))).alias("ts"))
        for h in lags])).alias("s")
    fanned = history.select(*part, "target", shifted).select(
        *part, F.col("s.ts").alias("datetime"), F.col("s.lag").alias("lag"), "target")
    return fanned.groupBy(*keys).agg(
        *[F.max(F.when(F.col("lag") == h, F.col("target"))).alias(f"{name}_{h}h") for h in lags])


def sum_lag_table(history: DataFrame, lags: list[int] = SUM_LAGS) -> DataFrame:
    """Lagged sums at both aggregation levels from one aggregation of the history.

    The history is summed per (county, is_business, is_consumption, datetime)
    [``level`` 0], those sums are rolled up over the counties [``level`` 1] (Spark
    reuses the exchange), and only these small tables are fanned out to the hours
    that look back at them. ``v_{h}`` is the sum ``h`` hours earlier: 0 when that
    hour has rows whose targets are all NULL, NULL when it has no rows.
    """
    by_county = type_sum(history)
    overall = summed(by_county, COUNTY_TYPE_SUM_KEYS)

    def level(sums, keys, n):
        return lag_table(sums, keys, lags, "v").select(
            F.col("county") if "county" in keys else F.lit(None).cast(history.schema["county"].dataType).alias("county"),
            *COUNTY_TYPE_SUM_KEYS, *[F.col(f"v_{h}h").alias(f"v_{h}") for h in lags],
            F.lit(n).cast("byte").alias("level"))
    return level(by_county, TYPE_SUM_KEYS, 0).unionByName(level(overall, COUNTY_TYPE_SUM_KEYS, 1))


def sum_sides(history: DataFrame, lags: list[int] = SUM_LAGS):
    """(type-sum side, county-type-sum side), both derived from one materialised table."""
    table = SmallSide(sum_lag_table(history, lags), name="target_sums",
                      counts={"whole": F.col("level") == 1})
    type_side = table.derive(lambda d: d.filter(F.col("level") == 0).select(
        *TYPE_SUM_KEYS, *[F.col(f"v_{h}").alias(f"target_all_type_sum_{h}h") for h in lags]),
        rows=table.rows - table.counted["whole"])
    county_side = table.derive(lambda d: d.filter(F.col("level") == 1).select(
        *COUNTY_TYPE_SUM_KEYS,
        *[F.col(f"v_{h}").alias(f"target_all_county_type_sum_{h}h") for h in lags]),
        rows=table.counted["whole"])
    return type_side, county_side


def join_lags_fused(features: DataFrame, history: DataFrame, keys: list[str], lags: list[int],
                    name: str, small: bool = False) -> DataFrame:
    table = lag_table(history, keys, lags, name)
    if small:
        table = SmallSide(table).side()
    return features.join(table, on=keys, how="left")


def join_lags_plain(features: DataFrame, history: DataFrame, keys: list[str], lags: list[int],
                    name: str) -> DataFrame:
    """One left join per lag on the shifted history (the direct formulation)."""
    for h in lags:
        right = shift_hours(history.select(*keys, "target"), h).withColumnRenamed(
            "target", f"{name}_{h}h")
        features = left_join(features, right, keys, "")
    return features


def hours_since_1970(col: str = "datetime"):
    """Wall-clock hours since 1970 (time-zone free on TIMESTAMP_NTZ)."""
    return (F.datediff(F.col(col).cast("date"), F.lit("1970-01-01").cast("date")) * F.lit(24)
            + F.hour(col))


def exact_lags(spread: DataFrame, value: str, lags: list[int], name: str, part: list[str]) -> DataFrame:
    """Lags of the rows that are their own (``_own``), over windows by ``part``."""
    by = ", ".join(part)
    cols = {}
    for h in lags:
        iv = f"INTERVAL {h} HOURS PRECEDING"
        cols[f"{name}_{h}h"] = F.expr(
            f"first({value}, true) OVER (PARTITION BY {by} ORDER BY datetime "
            f"RANGE BETWEEN {iv} AND {iv})")
    return spread.withColumns(cols).filter(F.col("_own"))


def lags_in_place(rows: DataFrame, lags: list[int], name: str = "target",
                  keys=SEGMENT_TIME_KEYS, bucket_hours: int | None = None) -> DataFrame:
    """Exact-time lags computed on the rows themselves (when the rows *are* the
    history): ``{name}_{h}h`` is the value exactly ``h`` hours earlier in the same
    segment, for every ``h`` in ``lags``.

    Windows are partitioned by segment *and* a time bucket at least as wide as the
    longest lag, so no task sorts a whole segment's series. Each row also goes to
    the next bucket as a lag source only, which puts every row's partners in its
    own partition; the copies are dropped afterwards. One sort serves all lags (the
    frames share partitioning and order), and the rows are copied 2x, not 13x.
    """
    part = [k for k in keys if k != "datetime"]
    bucket = F.floor(hours_since_1970() / F.lit(max(max(lags), bucket_hours or 7 * 24))).cast("long")
    both = F.explode(F.array(F.struct(bucket.alias("b"), F.lit(True).alias("own")),
                             F.struct((bucket + 1).alias("b"), F.lit(False).alias("own"))))
    spread = rows.select("*", both.alias("_s")).select(
        "*", F.col("_s.b").alias("_bucket"), F.col("_s.own").alias("_own")).drop("_s")
    return exact_lags(spread, name, lags, name, part + ["_bucket"]).drop("_bucket", "_own")


def lags_by_windows(rows: DataFrame, history: DataFrame, lags: list[int], name: str = "target",
                    keys=SEGMENT_TIME_KEYS, bucket_hours: int | None = None) -> DataFrame:
    """The same for rows that are not the history (rows to score): the history's rows
    go to their bucket and the next one as lag sources only, and each row of
    ``rows`` to its own. One exchange and one sort of both, no join."""
    part = [k for k in keys if k != "datetime"]
    bucket = F.floor(hours_since_1970() / F.lit(max(max(lags), bucket_hours or 7 * 24))).cast("long")
    own = rows.withColumns({"_bucket": bucket, "_own": F.lit(True), "_past": F.lit(None).cast("double")})
    past = history.select(*part, "datetime", F.explode(F.array(bucket, bucket + 1)).alias("_bucket"),
                          F.lit(False).alias("_own"), F.col("target").cast("double").alias("_past"))
    spread = own.unionByName(past, allowMissingColumns=True)
    return exact_lags(spread, "_past", lags, name, part + ["_bucket"]).drop("_bucket", "_own", "_past")


def lag_by_range_frame(history: DataFrame, h: int, keys=SEGMENT_TIME_KEYS,
                       bucket_hours: int | None = None) -> DataFrame:
    """One exact-time lag in window form (see ``lags_in_place``)."""
    return lags_in_place(history, [h], "target", keys, bucket_hours)


def add_target_features(features: DataFrame, history: DataFrame, strategy: str = "windows",
                        ratios: bool = True, scope=None) -> DataFrame:
    """Lags, lagged sums, row statistics and ratios. ``scope`` (a ``RowScope``)
    first cuts the history down to what the rows can look up."""
    history = history.select(*SEGMENT_TIME_KEYS, "target")
    lag_src = scope.restrict_hours(history, TARGET_LAGS) if scope else history
    sum_src = scope.restrict_hours(history, SUM_LAGS) if scope else history
    if strategy == "in_place":
        # the rows are the history: lags straight from their own series, no join
        if "target" not in features.columns:
            raise ValueError("in_place lags need rows that carry the target history")
        features = lags_in_place(features, TARGET_LAGS)
    elif strategy == "windows":
        features = lags_by_windows(features, lag_src, TARGET_LAGS)
    elif strategy == "fused":
        features = join_lags_fused(features, lag_src, LAG_JOIN_KEYS, TARGET_LAGS, "target")
    elif strategy == "plain":
        features = join_lags_plain(features, lag_src, SEGMENT_TIME_KEYS, TARGET_LAGS, "target")
    else:
        raise ValueError(f"unknown lag strategy {strategy!r}")
    # The two sums are small (hours x counties x 4 and hours x 4): one materialised
    # table holds both with their lags; each is broadcast when its size allows.
    type_side, county_side = sum_sides(sum_src)
    features = features.join(type_side.side(), on=TYPE_SUM_KEYS, how="left")
    features = features.join(county_side.side(), on=COUNTY_TYPE_SUM_KEYS, how="left")
    stats = [F.col(f"target_{h}h") for h in STATS_LAGS]
    cols = {"target_mean": row_mean(stats), "target_std": row_std(stats)}
    if ratios:
        cols.update(ratio_columns())
    return features.withColumns(cols)


def ratio_columns() -> dict:
    return {f"{p}_ratio_{n}_{d}": safe_ratio(F.col(f"{p}_{n}h"), F.col(f"{p}_{d}h"))
            for p, n, d in RATIOS}
