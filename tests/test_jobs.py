"""The three-step batch job and the notebook flow, end to end on sf0.001."""

from pyspark.sql import functions as F

from testdata_paths import SF001
from wattsmith.operators.joins import scratch_path
from wattsmith.plans import jobs
from wattsmith.plans.runs import read_runs
from wattsmith.sources import fixtures as fx

TINY = {"stepSize": 0.1, "maxDepth": 2, "maxIter": 2}


def test_batch_job(spark):
    root = scratch_path(spark, "job")
    tables = fx.bundle(spark, SF001)
    fpath = jobs.preprocess(spark, tables, f"{root}/features")
    run_id = jobs.train(spark, fpath, f"{root}/model", f"{root}/runs", params=TINY)
    score = jobs.evaluate(spark, fpath, f"{root}/runs", params=TINY)
    runs = read_runs(spark, f"{root}/runs")
    assert runs.count() == 2 and runs.filter(F.col("run_id") == run_id).count() == 1
    again = jobs.evaluate(spark, fpath, f"{root}/runs", params=TINY, run_id=run_id)
    own = read_runs(spark, f"{root}/runs").filter(F.col("run_id") == run_id).collect()
    assert len(own) == 1 and own[0].metrics == {"mean_absolute_error": again}
    assert own[0].tags == {"step": "train"} and read_runs(spark, f"{root}/runs").count() == 2
    assert score >= 0


def test_notebook_flow(spark):
    root = scratch_path(spark, "flow")
    tables = fx.bundle(spark, SF001)
    test_rows = tables.data.filter(
        F.col("datetime") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")).drop("target")
    names, score, preds, run_id = jobs.select_train_log(
        spark, tables, test_rows, f"{root}/runs", f"{root}/model", params=TINY)
    assert 0 < len(names) <= 59 and "target" not in names
    assert preds.count() == test_rows.count()
    rec = read_runs(spark, f"{root}/runs").first()
    assert rec.params["n_features"] == "60" and rec.metrics["mean_absolute_error"] == score


def test_command_line_steps(spark, tmp_path):
    """features -> train -> evaluate -> score through the command-line entry."""
    import pandas as pd

    from test_features import _write_inputs
    from wattsmith.__main__ import main
    inp = tmp_path / "in"
    inp.mkdir()
    _write_inputs(str(inp))
    train = pd.read_csv(inp / "train.csv")
    last = train[train.datetime >= train.datetime.max()[:10]]
    last.drop(columns=["target"]).rename(columns={"datetime": "prediction_datetime"}).to_csv(
        inp / "test.csv", index=False)
    out = tmp_path / "out"
    assert main(["features", "--input", str(inp), "--output", str(out / "features")]) == 0
    assert main(["train", "--features", str(out / "features"), "--model", str(out / "model"),
                 "--runs", str(out / "runs"), "--trees", "2"]) == 0
    assert main(["evaluate", "--features", str(out / "features"), "--runs",
                 str(out / "runs"), "--trees", "2"]) == 0
    assert main(["score", "--input", str(inp), "--test", str(inp / "test.csv"), "--model",
                 str(out / "model"), "--output", str(out / "pred")]) == 0
    pred = spark.read.parquet(str(out / "pred"))
    assert pred.count() == len(last) and set(pred.columns) == {"row_id", "prediction"}
    assert spark.read.parquet(str(out / "runs")).count() == 2


def test_rank_inside_folds(spark):
    root = scratch_path(spark, "flow2")
    tables = fx.bundle(spark, SF001)
    test_rows = tables.data.filter(
        F.col("datetime") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")).drop("target")
    names, score, preds, _ = jobs.select_train_log(
        spark, tables, test_rows, f"{root}/runs", f"{root}/model", params=TINY,
        rank_in_fold=True)
    assert score >= 0 and preds.count() == test_rows.count() and names
