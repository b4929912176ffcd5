"""Command line for the batch job: ``python -m wattsmith <step> ...``.

  features  --input DIR [--format csv|parquet] --output PATH
  train     --features PATH --model PATH --runs PATH [--profile lightgbm|xgboost] [--trees N]
  evaluate  --features PATH --runs PATH [--run ID] [--profile ...]
  score     --input DIR [--format ...] --test PATH --model PATH --output PATH

Each step is one Spark application reading what the previous one wrote. The
session's master and settings come from spark-submit / the environment; the
checkpoint folder from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _profile(args) -> dict:
    from .plans.training import profile
    return profile(args.profile, args.trees)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wattsmith")
    sub = p.add_subparsers(dest="step", required=True)
    f = sub.add_parser("features")
    f.add_argument("--input", required=True)
    f.add_argument("--format", default="csv", choices=["csv", "parquet"])
    f.add_argument("--output", required=True)
    t = sub.add_parser("train")
    t.add_argument("--features", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--runs", required=True)
    t.add_argument("--profile", default="lightgbm", choices=["lightgbm", "xgboost"])
    t.add_argument("--trees", type=int, help="another number of trees than the profile's")
    e = sub.add_parser("evaluate")
    e.add_argument("--features", required=True)
    e.add_argument("--runs", required=True)
    e.add_argument("--run", help="id of the run that train recorded; its record gets the error")
    e.add_argument("--profile", default="lightgbm", choices=["lightgbm", "xgboost"])
    e.add_argument("--trees", type=int, help="another number of trees than the profile's")
    s = sub.add_parser("score")
    s.add_argument("--input", required=True)
    s.add_argument("--format", default="csv", choices=["csv", "parquet"])
    s.add_argument("--test", required=True)
    s.add_argument("--model", required=True)
    s.add_argument("--output", required=True)
    args = p.parse_args(argv)

    from .session import DEFAULTS, ensure_checkpoint_dir
    builder = SparkSession.builder.appName(f"wattsmith-{args.step}")
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)

    from .plans import jobs
    from .sources.storage import TableBundle
    if args.step == "features":
        jobs.preprocess(spark, TableBundle.load(spark, args.input, args.format), args.output)
        out = {"features": args.output}
    elif args.step == "train":
        out = {"run_id": jobs.train(spark, args.features, args.model, args.runs,
                                    _profile(args))}
    elif args.step == "evaluate":
        out = {"mean_absolute_error": jobs.evaluate(spark, args.features, args.runs,
                                                    _profile(args), args.run)}
    else:
        from .plans.runs import load_model
        from .sources.readers import read_table
        from .sources.schemas import SCHEMAS
        from .streaming.scoring import score_batch
        tables = TableBundle.load(spark, args.input, args.format)
        test = read_table(spark, args.test, SCHEMAS["test"], args.format)
        score_batch(tables, load_model(args.model), test).write.mode("overwrite").parquet(
            args.output)
        out = {"predictions": args.output}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
