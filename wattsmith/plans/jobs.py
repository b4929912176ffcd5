"""End-to-end flows as Spark jobs with Parquet between the steps.

* ``preprocess`` → ``train`` → ``evaluate``: the three-step batch job (features
  on all columns, one fit, expanding-fold CV), each step reading what the previous
  one wrote.
* ``select_train_log``: the notebook flow: rank features by |corr| with the
  target, keep the top ``n - 1``, cross-validate, fit, score new rows, record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import materialize
from ..operators.selection import N_FEATURES, corr_with_target, top_k_features
from ..sources.readers import read_features, write_features
from ..sources.storage import TableBundle
from .features import FeatureBuilder
from .runs import add_metrics, log_run, save_model
from .training import cross_validate, cv_score, feature_columns, fit, predict


def preprocess(spark: SparkSession, tables: TableBundle, features_path: str) -> str:
    """Step 1: build the training features and write them (time helpers kept so the
    later steps can order folds; the model leaves them out of its inputs)."""
    features = FeatureBuilder(tables).generate(tables.data, drop_helpers=False)
    write_features(features, features_path)
    return features_path


def train(spark: SparkSession, features_path: str, model_path: str, runs_path: str,
          params: dict) -> str:
    """Step 2: fit on every feature column, save the model, record the run."""
    df = read_features(spark, features_path)
    model = fit(df, params)
    save_model(model, model_path)
    return log_run(spark, runs_path, "gbt", params, {}, {"step": "train"}, df, model_path)


def evaluate(spark: SparkSession, features_path: str, runs_path: str, params: dict,
             run_id: str | None = None) -> float:
    """Step 3: expanding-fold CV; the mean MAE goes to the run of ``run_id`` (the one
    step 2 recorded), or to a record of its own."""
    df = read_features(spark, features_path)
    score = cv_score(cross_validate(df, params))
    metrics = {"mean_absolute_error": score}
    if run_id:
        add_metrics(spark, runs_path, run_id, metrics)
    else:
        log_run(spark, runs_path, "gbt", params, metrics, {"step": "evaluate"})
    return score


def top_names(train_df: DataFrame, n_features: int = N_FEATURES) -> list[str]:
    """The top ``n - 1`` feature names by |corr| with the target (a bounded list)."""
    helpers = [c for c in ("datetime", "date", "hour", "dayofyear", "fold")
               if c in train_df.columns]
    ranked = top_k_features(corr_with_target(train_df.drop(*helpers)), n_features)
    names = [r.feature for r in ranked.orderBy("rank").select("feature").collect()]
    return [n for n in names if n in feature_columns(train_df)]


def select_train_log(spark: SparkSession, tables: TableBundle, test_rows: DataFrame,
                     runs_path: str, model_path: str, params: dict,
                     n_features: int = N_FEATURES, categorical: bool = False,
                     rank_in_fold: bool = False):
    """Rank → top-k → CV → fit → score ``test_rows`` → record. Returns
    (feature names, CV MAE, predictions DataFrame, run id).

    ``rank_in_fold``: rank features again inside every CV fold on its training
    rows only (the default, like the notebooks, ranks once on all rows and so lets
    the test blocks take part in the selection)."""
    builder = FeatureBuilder(tables)
    # Written once: ranking, folds, fit and the record's example all read it.
    train_df = materialize(builder.generate(tables.data, drop_helpers=False), "features")
    names = top_names(train_df, n_features)
    if rank_in_fold:
        folds = cross_validate(train_df, params, categorical=categorical,
                               select=lambda tr: top_names(tr, n_features))
    else:
        folds = cross_validate(train_df, params, features=names, categorical=categorical)
    score = cv_score(folds)
    model = fit(train_df, params, features=names, categorical=categorical)
    save_model(model, model_path)
    test_df = builder.generate(test_rows, has_target=False)
    preds = predict(model, test_df)
    run_id = log_run(spark, runs_path, "gbt", params | {"n_features": n_features,
                                                        "is_holiday": "is_holiday" in names},
                     {"mean_absolute_error": score}, {"experiment": "top-k"},
                     train_df.select(*[F.col(f"`{n}`") for n in names]), model_path)
    return names, score, preds, run_id
