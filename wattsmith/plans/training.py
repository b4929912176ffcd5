"""Model stage on Spark ML: assemble, boosted trees, expanding-fold CV, scoring.

The notebooks train LightGBM / XGBoost on one machine; here the same flow runs as
a Spark ML ``Pipeline`` (distributed tree building). Accuracy parity is the goal,
not identical trees: Spark's GBT grows depth-wise and has no leaf-count limit.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bins import splits
from ..operators.folds import assign_folds
from ..sources.schemas import CATEGORICAL_COLS
from .signature import accept, model_signature

# ---------------------------------------------------------------------------
# The notebooks' model settings (learning rate, depth, trees), and
# the number of expanding folds.
# ---------------------------------------------------------------------------
PROFILES = {
    # learning rate 0.1, depth 10, 500 trees; leaves of at least 20 rows and 255 bins
    # are that library's documented defaults. It also stops a tree at 31 leaves, which
    # a depth-wise learner cannot do: these trees may grow to the full depth.
    "lightgbm": {"stepSize": 0.1, "maxDepth": 10, "maxIter": 500,
                 "minInstancesPerNode": 20, "maxBins": 255},
    # learning rate 0.1, depth 10 (that library grows depth-wise too), 500 trees,
    # 256 histogram bins (its documented default).
    "xgboost": {"stepSize": 0.1, "maxDepth": 10, "maxIter": 500, "maxBins": 256},
}
N_SPLITS = 6
# ---------------------------------------------------------------------------

MISSING = -1.0e9   # stand-in for NULL: trees put it in its own region below every value
NOT_FEATURES = {"row_id", "target", "datetime", "date", "hour", "dayofyear", "fold"}


def profile(name: str, trees: int | None = None) -> dict:
    """A profile's settings, with another number of trees if given."""
    return PROFILES[name] | ({"maxIter": trees} if trees else {})


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: every numeric/boolean/string column but keys and the label."""
    out = []
    for f in df.schema.fields:
        if f.name in NOT_FEATURES:
            continue
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.StringType)):
            out.append(f.name)
    return out


def _q(c: str) -> str:
    return f"`{c}`"


def build_pipeline(df: DataFrame, params: dict, features: list[str] | None = None,
                   categorical: bool = False, label: str = "target", missing_flags: bool = False,
                   edges: dict[str, list[float]] | None = None) -> Pipeline:
    """Fill NULLs and NaNs with a sentinel, index categoricals, assemble, and boost.

    ``categorical``: index the five categorical columns and let the trees split
    them as categories; otherwise only the string ``segment`` is indexed and
    everything else is numeric. The booster's ``maxBins`` must cover the largest
    category count; ``fit`` raises it from the indexer's labels.

    ``missing_flags``: a 0/1 input beside each numeric one. ``edges``: bin edges by
    feature (``operators.bins``), computed once for all folds and fits; those features
    enter as bin numbers, missing values in bin 0.
    """
    features = features or feature_columns(df)
    types = dict(df.dtypes)
    cats = [c for c in features if c in CATEGORICAL_COLS and (categorical or types[c] == "string")]
    nums = [c for c in features if c not in cats]
    cast = [f"coalesce(nanvl(CAST({_q(c)} AS DOUBLE), {MISSING}), {MISSING}) AS {_q(c + '__x')}" for c in nums]
    cast += [f"CAST({_q(c)} AS STRING) AS {_q(c + '__s')}" for c in cats]
    flags = [c for c in nums if missing_flags]
    cast += [f"CAST({_q(c)} IS NULL OR isnan(CAST({_q(c)} AS DOUBLE)) AS DOUBLE) AS {_q(c + '__m')}" for c in flags]
    binned = [c for c in nums if edges and edges.get(c)]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(cast)} FROM __THIS__")]
    if cats:
        stages.append(StringIndexer(inputCols=[f"{c}__s" for c in cats],
                                    outputCols=[f"{c}__i" for c in cats], handleInvalid="keep"))
    if binned:
        stages.append(Bucketizer(splitsArray=[splits(edges[c], floor=MISSING) for c in binned],
                                 inputCols=[f"{c}__x" for c in binned], outputCols=[f"{c}__b" for c in binned]))
    stages.append(VectorAssembler(inputCols=[f"{c}__b" if c in binned else f"{c}__x" for c in nums]
                                  + [f"{c}__m" for c in flags] + [f"{c}__i" for c in cats],
                                  outputCol="features", handleInvalid="keep"))
    p = dict(params)
    # No cache of node ids: a row's walk down a tree is at most maxDepth comparisons,
    # less than keeping, joining and checkpointing an id for each row at each level.
    # Checkpoint (to the session's checkpoint folder) every 10 iterations so the
    # boosting lineage stays short and a lost executor does not replay it.
    p.setdefault("cacheNodeIds", False)
    p.setdefault("checkpointInterval", 10)
    stages.append(GBTRegressor(featuresCol="features", labelCol=label, seed=42, **p))
    return Pipeline(stages=stages)


def fit(df: DataFrame, params: dict, patience: int | None = None, **kw) -> PipelineModel:
    """Fit the pipeline; ``df`` is read once per stage, so pass a written table.

    ``patience``: let the last time block choose how many trees are grown, at most
    ``maxIter`` (see ``tree_count``), and fit again on all rows with that number.
    Without it the model has ``maxIter`` trees.
    """
    *prepare, booster = build_pipeline(df, params, **kw).getStages()
    prepared = Pipeline(stages=prepare).fit(df)
    labels = [len(x) for s in prepared.stages if hasattr(s, "labelsArray") for x in s.labelsArray]
    booster.setMaxBins(max([booster.getMaxBins(), *[n + 1 for n in labels]]))
    if patience is not None:
        booster = booster.copy({booster.maxIter: tree_count(booster, prepared, df, patience)})
    return PipelineModel(prepared.stages + [booster.fit(prepared.transform(df))])


def with_late_block(df: DataFrame, flag: str = "late") -> DataFrame:
    """``df``, written, with a flag for the last block ``assign_folds`` would test: one
    part in ``N_SPLITS`` + 1 of the rows, the latest ones."""
    from ..operators.joins import materialize
    return materialize(assign_folds(df, N_SPLITS).withColumn(flag, F.col("fold") == N_SPLITS - 1).drop("fold"),
                       "late-block")


def tree_count(booster: GBTRegressor, prepared: PipelineModel, df: DataFrame, patience: int) -> int:
    """The number of trees with the least absolute error on the last time block, learned
    from the rows before it, once ``patience`` more trees have not bettered it.

    A boosted model holds the models of every smaller count, so one fit gives the errors
    of all. If they do not settle the count (see ``settled``), four times as many trees
    are grown, up to ``maxIter``: every try starts from the first tree again, so few and
    larger tries grow fewer trees in all (710 for a ceiling of 500 and a patience of 5).
    """
    marked = with_late_block(df, "__late")
    late = prepared.transform(marked.filter("__late"))
    early = prepared.transform(marked.filter("NOT __late"))
    if late.isEmpty() or early.isEmpty():
        return booster.getMaxIter()
    most = booster.getMaxIter()
    trees = first = min(2 * patience, most)
    while True:
        errors = booster.copy({booster.maxIter: trees}).fit(early).evaluateEachIteration(late, "absolute")
        best = settled(errors, first, most, patience)
        if best is not None:
            return best
        trees = min(4 * trees, most)


def settled(errors: list[float], first: int, most: int, patience: int) -> int | None:
    """The best count as seen after ``first`` trees, twice as many, and so on up to
    ``most``: at the first look whose least error ``patience`` more trees have not
    bettered, or at ``most``. None if ``errors`` ends before such a look."""
    seen = first
    while seen <= len(errors):
        best = errors.index(min(errors[:seen])) + 1
        if best + patience <= seen or seen == most:
            return best
        seen = min(2 * seen, most)
    return None


def tree_counts(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


def predict(model: PipelineModel, df: DataFrame, signature: T.StructType | None = None) -> DataFrame:
    """Predictions by row_id. ``signature``: the schema the model was fitted on (as a run
    records it); rows that do not fit it are refused (``plans.signature``)."""
    if signature is not None:
        df = accept(df, model_signature(signature))
    return model.transform(df).select("row_id", F.col("prediction").cast("double"))


def mae(scored: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    return scored.agg(F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"),
                      F.count(F.lit(1)).alias("n"))


def cv_blocks(folded: DataFrame, n_splits: int = N_SPLITS, label: str = "target") -> DataFrame:
    """What each fold has, without a model: fold, n_test, n_train, lag168_mae (MAE of
    the value a week earlier as the forecast, on the test rows that have one)."""
    base = (F.abs(F.col(label) - F.col("target_168h").cast("double"))
            if "target_168h" in folded.columns else F.lit(None).cast("double"))
    per = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_test"), F.avg(base).alias("lag168_mae"))
    before = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)  # a row per fold
    return per.withColumn("n_train", F.coalesce(F.sum("n_test").over(before), F.lit(0))).filter(
        (F.col("fold") >= 0) & (F.col("fold") < n_splits)).select("fold", "n_test", "n_train", "lag168_mae")


def cross_validate(df: DataFrame, params: dict, n_splits: int = N_SPLITS, label: str = "target",
                   select=None, parallel: int = N_SPLITS, **kw) -> DataFrame:
    """Expanding-window CV: fold ``i`` trains on every row before its test block.

    Returns one row per fold (fold, mae, n_trees, n_test, n_train, lag168_mae: see
    ``cv_blocks``) plus the mean MAE over folds. Folds are fitted ``parallel`` at a time, each
    by Spark jobs of its own scheduler pool: a boosted tree is many short jobs, one
    after another, whose tasks seldom fill a cluster. ``select``: optional ``train
    rows -> feature names``, run inside every fold on that fold's training rows only
    (feature selection without looking at the test block). Other arguments: ``fit``'s.
    """
    from ..operators.joins import materialize
    spark = df.sparkSession
    # written once to the checkpoint folder: six fits re-read it, and a lost
    # executor re-reads files instead of rebuilding the features
    folded = materialize(assign_folds(df, n_splits), "cv_folds")

    def one(i: int) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{i}")
        train = folded.filter(F.col("fold") < i).drop("fold")
        test = folded.filter(F.col("fold") == i).drop("fold")
        own = kw if select is None else kw | {"features": select(train)}
        model = fit(train, params, **own)
        r = mae(model.transform(test), label).first()
        return i, float(r["mae"]) if r["mae"] is not None else None, tree_counts(model)

    rows = concurrently([lambda i=i: one(i) for i in range(n_splits)], parallel, spark)
    out = spark.createDataFrame(rows, "fold int, mae double, n_trees int").join(
        cv_blocks(folded, n_splits, label), "fold", "left")
    # six rows: the mean over folds rides along as a column
    return out.withColumn("mean_mae", F.avg("mae").over(Window.partitionBy(F.lit(1))))


def concurrently(calls: list, parallel: int, spark) -> list:
    """The results of ``calls`` in their order, ``parallel`` at a time. Each thread has
    the caller's job properties. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]


def cv_score(folds: DataFrame) -> float:
    """Mean MAE over the folds (the notebooks negate sklearn's negative score)."""
    return folds.agg(F.avg("mae")).first()[0]
