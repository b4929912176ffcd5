"""Scoring as a stream: test-row files arrive, each micro-batch gets its features
(scoped to what those rows can look up) and the saved model's predictions, which
are appended to a Parquet output.

Each batch's output goes to its own ``batch=<id>`` folder written with
``overwrite``, so a batch retried after a failure replaces its own output instead
of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.features import FeatureBuilder
from ..plans.runs import load_model
from ..plans.training import predict
from ..sources.storage import TableBundle, preprocess_test


def score_batch(tables: TableBundle, model, test_rows: DataFrame,
                signature: T.StructType | None = None) -> DataFrame:
    rows = preprocess_test(test_rows)
    return predict(model, FeatureBuilder(tables).generate(rows, has_target=False), signature)


def start_scoring_stream(spark: SparkSession, tables: Callable[[SparkSession], TableBundle],
                         model_path: str, source_dir: str, schema: T.StructType,
                         out_dir: str, checkpoint: str, fmt: str = "parquet",
                         available_now: bool = True, signature: T.StructType | None = None):
    """``tables`` is called per batch, so each batch sees the current table
    versions (e.g. after the update stream merged the latest revealed targets).
    ``signature``: the schema the model was fitted on; features that do not fit it stop
    the stream (see ``plans.signature``)."""
    stream = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        stream = stream.option("header", True)
    model = load_model(model_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        out = score_batch(tables(batch.sparkSession), model, batch, signature)
        out.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    writer = (stream.load(source_dir).writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
