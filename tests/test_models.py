"""Model stage: pipeline fits with NULLs present, saves, reloads, scores; CV folds."""

from pyspark.sql import functions as F

from testdata_paths import SF01
from wattsmith.plans import catalog
from wattsmith.plans.runs import load_model
from wattsmith.plans.training import PROFILES, cross_validate, fit, mae, predict, tree_counts, with_late_block


def test_fit_save_load_score(spark, tmp_path):
    df = catalog._model_rows(spark, SF01)
    model = fit(df, params={"stepSize": 0.1, "maxDepth": 3, "maxIter": 5})
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = load_model(path)
    a = predict(model, df).withColumnRenamed("prediction", "a")
    b = predict(again, df).withColumnRenamed("prediction", "b")
    j = a.join(b, "row_id")
    assert j.count() == df.count()
    assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    assert predict(model, df).filter(F.col("prediction").isNull()).count() == 0


def test_model_beats_mean_baseline(spark):
    df = catalog._model_rows(spark, SF01)
    model = fit(df, params={"stepSize": 0.3, "maxDepth": 4, "maxIter": 10})
    err = mae(model.transform(df)).first()["mae"]
    mean = df.agg(F.avg("target")).first()[0]
    base = df.agg(F.avg(F.abs(F.col("target") - F.lit(mean)))).first()[0]
    assert err < base


def test_cross_validate_six_folds(spark):
    df = catalog._model_rows(spark, SF01)
    folds = cross_validate(df, params={"stepSize": 0.1, "maxDepth": 2, "maxIter": 2})
    rows = folds.orderBy("fold").collect()
    assert [r.fold for r in rows] == list(range(6))
    assert all(r.mae is not None and r.n_test > 0 for r in rows)
    assert all(a.n_train < b.n_train for a, b in zip(rows, rows[1:]))
    # the fitted model beats the naive forecast (the value a week earlier)
    assert sum(r.mae for r in rows) < sum(r.lag168_mae for r in rows)


def test_runs_table(spark):
    rec = catalog.runs_table(spark, "/root/testdata/sf0.001").collect()
    assert len(rec) == 1 and rec[0].metrics["mean_absolute_error"] >= 0
    assert rec[0].params["maxIter"] == "500" and 1 <= int(rec[0].params["trees"]) <= 500
    assert 0 < len(rec[0].input_example) <= 5 and rec[0].input_example[0].startswith("{")


def _signal(spark, n=600):
    """Rows whose target is a step function of one feature, with its trend in time."""
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))
        .alias("datetime"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 7 * 10 + F.hash("id") % 3).cast("double").alias("target"))


def test_patience_finds_the_least_error(spark):
    """The chosen count is the best of a longer run, and never beyond the ceiling."""
    df = _signal(spark)
    params = {"stepSize": 0.5, "maxDepth": 2, "maxIter": 24}
    model = fit(df, params, patience=3)
    late = with_late_block(df)
    full = fit(late.filter("NOT late").drop("late"), params)
    scored = Pipeline_of(full).transform(late.filter("late"))
    errors = full.stages[-1].evaluateEachIteration(scored, "absolute")
    n = tree_counts(model)
    assert 1 <= n <= 24 and errors[n - 1] == min(errors[:min(24, n + 3)])
    assert tree_counts(fit(df, params | {"maxIter": 2}, patience=3)) <= 2
    assert tree_counts(fit(df.limit(3), params | {"maxIter": 4}, patience=3)) <= 4


def _looks(errors, first, most, patience):
    """The count by a fit of its own for every doubling."""
    trees = first
    while True:
        best = errors.index(min(errors[:trees])) + 1
        if best + patience <= trees or trees == most:
            return best
        trees = min(2 * trees, most)


def test_fewer_tries_choose_the_same_count(monkeypatch):
    """Errors that go on falling: tries of 10, 40, 160 and 500 trees, the count unchanged."""
    from wattsmith.plans import training
    from types import SimpleNamespace

    for errors in ([1 / (i + 1) for i in range(500)], *[
            [abs(i - n) + (i * 7 % 5) / 10 for i in range(500)] for n in (0, 4, 5, 8, 14, 17, 36, 77, 155, 316, 494, 499)]):
        grown = []

        class Booster:
            maxIter = "maxIter"

            def __init__(self, n=500):
                self.n = n

            def getMaxIter(self):
                return self.n

            def copy(self, extra):
                return Booster(extra["maxIter"])

            def fit(self, rows):
                grown.append(self.n)
                return self

            def evaluateEachIteration(self, rows, loss):
                return errors[:self.n]

        rows = SimpleNamespace(filter=lambda c: rows, isEmpty=lambda: False)
        monkeypatch.setattr(training, "with_late_block", lambda df, flag: rows)
        n = training.tree_count(Booster(), SimpleNamespace(transform=lambda r: r), rows, 5)
        assert n == _looks(errors, 10, 500, 5)
        assert grown == [10, 40, 160, 500][:len(grown)]


def test_deep_trees_keep_no_node_ids(spark):
    from wattsmith.plans.training import build_pipeline
    deep = build_pipeline(_signal(spark, 5), PROFILES["xgboost"]).getStages()[-1]
    assert not deep.getCacheNodeIds() and deep.getMaxIter() == 500


def Pipeline_of(model):
    from pyspark.ml import PipelineModel
    return PipelineModel(model.stages[:-1])


def test_folds_at_once_equal_folds_in_turn(spark):
    df = _signal(spark)
    params = {"stepSize": 0.1, "maxDepth": 2, "maxIter": 3}
    a, b = (cross_validate(df, params, parallel=n).orderBy("fold").collect() for n in (1, 6))
    assert [(x.fold, round(x.mae, 9), x.n_trees, x.n_train) for x in a] == [
        (x.fold, round(x.mae, 9), x.n_trees, x.n_train) for x in b]


def test_a_failing_fold_is_raised(spark):
    import pytest
    with pytest.raises(ZeroDivisionError):
        cross_validate(_signal(spark), {"maxIter": 1}, select=lambda rows: 1 / 0)


def test_registered_models_use_the_whole_profiles():
    assert all(catalog._profile(name) == PROFILES[name] for name in PROFILES)
    assert all(catalog._profile(name)["maxIter"] == 500 for name in PROFILES)
