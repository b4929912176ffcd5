"""Run records (params, metrics, tags, input schema) and model artifacts on disk.

The notebooks log to a tracking server; here a run is one row appended to a
Parquet ``runs`` table and the fitted ``PipelineModel`` is saved next to it.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("model", T.StringType(), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("input_schema", T.StringType(), True),
    T.StructField("input_example", T.ArrayType(T.StringType()), True),
    T.StructField("model_path", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
])


def log_run(spark: SparkSession, runs_path: str, model: str, params: dict, metrics: dict,
            tags: dict | None = None, input_df: DataFrame | None = None,
            model_path: str | None = None, example_rows: int = 5) -> str:
    """Append one run record; ``params`` of several dicts are merged by the caller
    (``a | b``), as the notebooks merge model and preprocessing settings. The input
    is recorded by its schema and ``example_rows`` rows as JSON (never the frame)."""
    run_id = uuid.uuid4().hex
    example = ([r[0] for r in input_df.limit(example_rows)
                .select(F.to_json(F.struct("*"))).collect()]
               if input_df is not None and example_rows else None)
    row = (run_id, model, {k: str(v) for k, v in params.items()},
           {k: float(v) for k, v in metrics.items() if v is not None},
           {k: str(v) for k, v in (tags or {}).items()},
           input_df.schema.json() if input_df is not None else None, example, model_path,
           _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    spark.createDataFrame([row], RUNS_SCHEMA).write.mode("append").parquet(runs_path)
    return run_id


def add_metrics(spark: SparkSession, runs_path: str, run_id: str, metrics: dict) -> None:
    """Reopen a run: append its record with ``metrics`` merged into those it has."""
    own = read_runs(spark, runs_path).filter(F.col("run_id") == run_id)
    row = own.first()
    if row is None:
        raise ValueError(f"no run {run_id}")
    row = row.asDict() | {"metrics": (row["metrics"] or {}) | {k: float(v) for k, v in metrics.items()},
                          "ts": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)}
    spark.createDataFrame([tuple(row[c] for c in RUNS_SCHEMA.names)], RUNS_SCHEMA).write.mode(
        "append").parquet(runs_path)


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """One row per run: its latest record."""
    rows = spark.read.schema(RUNS_SCHEMA).parquet(runs_path)
    last = rows.groupBy("run_id").agg(F.max_by(F.struct(*[F.col(c) for c in RUNS_SCHEMA.names[1:]]), "ts").alias("r"))
    return last.select("run_id", "r.*")


def input_schema(run_row) -> T.StructType:
    return T.StructType.fromJson(json.loads(run_row["input_schema"]))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
