"""Feature selection: correlation with the target, ranking, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rowwise import segment_numeric
from .joins import materialize

# Fixed value: top-k size as the notebooks set it; the slice that drops the target
# itself leaves k - 1 names.
N_FEATURES = 60


def numeric_view(df: DataFrame, exclude=("row_id",)) -> DataFrame:
    """Every column as DOUBLE the way the correlation sees it: booleans 0/1, the
    segment label as the number its digits spell, NaN turned into NULL."""
    cols = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        c = F.col(f"`{f.name}`")
        if f.name == "segment":
            c = segment_numeric(c)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int").cast("double")
        elif isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType,
                                     T.TimestampNTZType)):
            continue
        c = c.cast("double")
        cols.append(F.nanvl(c, F.lit(None).cast("double")).alias(f.name))
    return df.select(*cols)


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are non-null; NULL for a constant
    column (where the textbook formula divides by zero)."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.sqrt(F.var_pop(xx) * F.var_pop(yy)))


def corr_with_target(df: DataFrame, target: str = "target") -> DataFrame:
    """``(feature, corr)`` for every column but ``target``.

    Each row is unpivoted to ``(feature, x, target)`` and grouped by feature: a
    grouped aggregate of three moments that combines map-side, so the shuffle
    carries one partial row per feature per task whatever the row count.
    """
    num = numeric_view(df)
    feats = [c for c in num.columns if c != target]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("x")) for c in feats]))
    long = num.select(F.col(target).alias("_y"), pairs.alias("s")).select(
        "s.feature", "s.x", "_y")
    return long.groupBy("feature").agg(pearson(F.col("x"), F.col("_y")).alias("corr"))


def _gram_partials(cols: list[str]):
    """Per-task moment sums for every column pair (a <= b), with NumPy.

    Each task shifts every column by its own mean over the task's first batch
    (``ca``/``cb`` are emitted with the sums, so the shift can be undone exactly)
    and sums over the rows where both values are present: n, sum a, sum b,
    sum a^2, sum b^2, sum a*b. Shifting keeps the sums small, which keeps the
    variance of a near-constant column exact.
    """
    import numpy as np
    import pandas as pd

    k = len(cols)
    ia, ib = np.triu_indices(k)

    def run(batches):
        nn = np.zeros((k, k)); sa = np.zeros((k, k)); saa = np.zeros((k, k)); sab = np.zeros((k, k))
        c = None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
            if c is None:
                with np.errstate(all="ignore"):
                    c = np.nan_to_num(np.nanmean(x, axis=0)) if len(x) else np.zeros(k)
            x = x - c
            m = (~np.isnan(x)).astype("float64")
            z = np.where(m > 0, x, 0.0)
            nn += m.T @ m
            sa += z.T @ m            # [a, b]: sum of a over rows where a and b are present
            saa += (z * z).T @ m
            sab += z.T @ z
        if c is None:
            return
        yield pd.DataFrame({"a": ia, "b": ib, "n": nn[ia, ib], "sa": sa[ia, ib],
                            "sb": sa[ib, ia], "saa": saa[ia, ib], "sbb": saa[ib, ia],
                            "sab": sab[ia, ib], "ca": c[ia], "cb": c[ib]})
    return run


def corr_matrix(df: DataFrame) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form ``(feature_a, feature_b, corr)``,
    one row per unordered pair (names in alphabetical order) and per diagonal cell.

    One pass over ``df``: each task folds its rows into k x k shifted moment sums
    with matrix products and emits one row per pair. Spark then moves every task's
    sums onto one common shift per column (exact algebra on the partial rows) and
    adds them per pair. The shuffle carries k(k+1)/2 rows per task, whatever the
    row count. Pairs with zero variance on either side give NULL.
    """
    num = numeric_view(df)
    cols = num.columns
    schema = ("a int, b int, n double, sa double, sb double, saa double, sbb double, "
              "sab double, ca double, cb double")
    # Written, since the shifts and the sums both read it: ``df`` is computed once.
    parts = materialize(num.mapInPandas(_gram_partials(cols), schema), "gram-parts")
    # Common shift per column: the count-weighted mean of the task shifts, from the
    # diagonal partial rows (tasks x k rows).
    shift = (parts.filter(F.col("a") == F.col("b")).groupBy("a")
             .agg(F.coalesce(F.try_divide(F.sum(F.col("n") * F.col("ca")), F.sum("n")),
                             F.lit(0.0)).alias("shift")))
    da = F.col("ca") - F.col("shift_a")
    db = F.col("cb") - F.col("shift_b")
    n = F.col("n")
    # one row per column: a bounded broadcast
    moved = (parts.join(F.broadcast(shift.withColumnRenamed("shift", "shift_a")), "a")
             .join(F.broadcast(shift.withColumnRenamed("a", "b")
                               .withColumnRenamed("shift", "shift_b")), "b")
             .select("a", "b", "n",
                     (F.col("sa") + n * da).alias("sa"), (F.col("sb") + n * db).alias("sb"),
                     (F.col("saa") + 2 * da * F.col("sa") + n * da * da).alias("saa"),
                     (F.col("sbb") + 2 * db * F.col("sb") + n * db * db).alias("sbb"),
                     (F.col("sab") + db * F.col("sa") + da * F.col("sb") + n * da * db)
                     .alias("sab")))
    tot = moved.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in
                                        ("n", "sa", "sb", "saa", "sbb", "sab")])
    def per_row(c):   # NULL for a pair with no complete rows (ANSI-safe)
        return F.try_divide(F.col(c), n)

    ma, mb = per_row("sa"), per_row("sb")
    va = per_row("saa") - ma * ma
    vb = per_row("sbb") - mb * mb
    cov = per_row("sab") - ma * mb
    # Shifted sums leave rounding noise where a variance is mathematically 0.
    tiny_a = va <= F.lit(1e-12) * per_row("saa")
    tiny_b = vb <= F.lit(1e-12) * per_row("sbb")
    corr = F.when((n > 0) & ~tiny_a & ~tiny_b, F.try_divide(cov, F.sqrt(va * vb)))
    names = F.array(*[F.lit(c) for c in cols])
    na, nb = F.element_at(names, F.col("a") + 1), F.element_at(names, F.col("b") + 1)
    # Each unordered pair once, named in alphabetical order.
    return tot.select(F.least(na, nb).alias("feature_a"), F.greatest(na, nb).alias("feature_b"),
                      F.when(corr.isNotNull(), F.least(F.greatest(corr, F.lit(-1.0)),
                                                       F.lit(1.0))).alias("corr"))


def rank_by_abs_corr(corr: DataFrame) -> DataFrame:
    """Order by |corr| descending (NULL last), then name; adds a 1-based ``rank``.
    The input has one row per feature, so the global order is over a bounded table."""
    from pyspark.sql import Window
    w = Window.orderBy(F.abs("corr").desc_nulls_last(), F.col("feature"))
    return corr.withColumn("abs_corr", F.abs("corr")).withColumn("rank", F.row_number().over(w))


def top_k_features(corr: DataFrame, n: int = N_FEATURES) -> DataFrame:
    """The ``n - 1`` features with the largest |corr| (the target itself is not a
    candidate, which is what the original slice ``[1:n]`` achieves)."""
    return rank_by_abs_corr(corr).filter(F.col("rank") <= n - 1)


def select_features(df: DataFrame, names: list[str], keep=("row_id", "target")) -> DataFrame:
    return df.select(*[c for c in keep if c in df.columns], *[F.col(f"`{n}`") for n in names])


def categoricals_as_string(df: DataFrame,
                           cols=("is_consumption", "product_type", "is_business", "county",
                                 "segment")) -> DataFrame:
    """Cast the categorical columns that are present to STRING (for run records)."""
    present = {c for c in cols if c in df.columns}
    return df.withColumns({c: F.col(c).cast("string") for c in present})
