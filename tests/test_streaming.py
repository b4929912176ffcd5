"""Streaming: CSV batches with extra columns merged into a table; the
append-only watermark dedupe."""

import datetime as dt
import os

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattsmith.operators.joins import scratch_path
from wattsmith.operators.update import upsert
from wattsmith.sources import schemas as S
from wattsmith.streaming.updates import dedupe_stream, init_table, start_update_stream, updated


def _gas(days, price, extra=False):
    df = pd.DataFrame({"forecast_date": [dt.date(2024, 1, d) for d in days],
                       "lowest_price_per_mwh": [price] * len(days),
                       "highest_price_per_mwh": [price + 1] * len(days)})
    if extra:
        df["origin_date"] = df["forecast_date"]
    return df


def test_csv_batches_merge_by_file_time(spark, tmp_path):
    root = scratch_path(spark, "gas")
    keys = S.UPDATE_KEYS["gas_prices"]
    old = spark.createDataFrame(_gas(range(1, 11), 1.0)).select(
        F.col("forecast_date").cast("date"), "lowest_price_per_mwh", "highest_price_per_mwh")
    init_table(old, f"{root}/table", keys)
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    _gas(range(9, 15), 2.0, extra=True).to_csv(incoming / "b1.csv", index=False)
    _gas(range(14, 16), 3.0, extra=True).to_csv(incoming / "b2.csv", index=False)
    os.utime(incoming / "b1.csv", (2_000_000_000, 2_000_000_000))  # the first file is the newer one
    os.utime(incoming / "b2.csv", (1_900_000_000, 1_900_000_000))
    schema = T.StructType(list(S.SCHEMAS["gas_prices"].fields)).add("origin_date", "date")
    q = start_update_stream(spark, str(incoming), schema, keys, f"{root}/table",
                            f"{root}/ckpt", fmt="csv")
    q.awaitTermination()
    out = updated(spark, f"{root}/table", keys)
    got = {r.forecast_date.day: r.lowest_price_per_mwh for r in out.collect()}
    assert len(got) == 15
    assert got[1] == 1.0 and got[9] == 2.0 and got[13] == 2.0 and got[15] == 3.0
    assert got[14] == 2.0
    batch = upsert(old, spark.read.schema(schema).option("header", True)
                   .csv(str(incoming)).select(*old.columns), keys)
    assert set(batch.columns) == set(out.columns) and batch.count() == out.count()


def test_watermark_dedupe(spark, tmp_path):
    src = tmp_path / "events"
    rows = [(dt.datetime(2024, 1, 1, h), 1, float(h)) for h in range(5)]
    rows += [(dt.datetime(2024, 1, 1, 2), 1, 99.0)]            # repeat of a key
    spark.createDataFrame(rows, "datetime timestamp_ntz, county int, v double") \
        .write.parquet(str(src))
    stream = spark.readStream.schema("datetime timestamp_ntz, county int, v double").parquet(str(src))
    out = dedupe_stream(stream, ["datetime", "county"], "datetime", "1 day")
    q = (out.writeStream.format("memory").queryName("dedupe_out").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    assert spark.table("dedupe_out").count() == 5


def test_scoring_stream_equals_batch_scoring(spark):
    from testdata_paths import SF001
    from wattsmith.plans.runs import save_model
    from wattsmith.plans.training import fit
    from wattsmith.sources import fixtures as fx
    from wattsmith.streaming.scoring import score_batch, start_scoring_stream
    root = scratch_path(spark, "scoring")
    tables = fx.bundle(spark, SF001)
    model = fit(_train_features(tables), params={"stepSize": 0.1, "maxDepth": 2,
                                                         "maxIter": 2})
    save_model(model, f"{root}/model")
    test = (tables.data.filter(F.col("datetime") >= F.lit("2024-01-29 00:00:00")
                               .cast("timestamp_ntz"))
            .drop("target").withColumnRenamed("datetime", "prediction_datetime"))
    test.write.parquet(f"{root}/incoming")
    q = start_scoring_stream(spark, lambda s: fx.bundle(s, SF001), f"{root}/model",
                             f"{root}/incoming", test.schema, f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/out").select("row_id", "prediction")
    want = score_batch(tables, model, test)
    assert got.count() == test.count()
    j = got.join(want.withColumnRenamed("prediction", "w"), "row_id")
    assert j.count() == test.count()
    assert j.filter(F.abs(F.col("prediction") - F.col("w")) > 1e-9).count() == 0


def _train_features(tables):
    from wattsmith.plans.features import FeatureBuilder
    return FeatureBuilder(tables).generate(tables.data)


def test_partitioned_stream_rewrites_touched_days_only(spark):
    from testdata_paths import SF001
    from wattsmith.plans import catalog
    from wattsmith.streaming.updates import (init_partitioned_table,
                                             start_partitioned_update_stream)
    keys = S.UPDATE_KEYS["target"]
    old, new = catalog.batches(spark, SF001, "target")
    root = scratch_path(spark, "ptable")
    init_partitioned_table(old, f"{root}/table", keys)
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(f"{root}/table/day=2024-01-02")
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = [st.getPath().getName() for st in fs.listStatus(fs_path)]
    new.write.parquet(f"{root}/incoming")
    q = start_partitioned_update_stream(spark, f"{root}/incoming", new.schema, keys,
                                        f"{root}/table", f"{root}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/table").drop("day")
    want = upsert(old, new, keys)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    # an untouched day keeps its original files
    assert [st.getPath().getName() for st in fs.listStatus(fs_path)] == before
