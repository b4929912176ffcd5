"""Update streams lose nothing: replays, new checkpoints, two streams, rows without a day."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from wattsmith.operators.folds import assign_folds
from wattsmith.operators.joins import BUDGET_CONF, scratch_path
from wattsmith.operators.update import keep_newest, union_batches, upsert
from wattsmith.streaming import updates as U

SCHEMA = "k int, v double"


def _start(spark, rows=((1, 1.0),)):
    root = scratch_path(spark, "lossless")
    U.init_table(spark.createDataFrame(list(rows), SCHEMA), f"{root}/table", ["k"])
    return root


def _add(spark, root, rows, at):
    """One file written at second ``at``."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for f in pathlib.Path(f"{root}/in".removeprefix("file:")).glob("*.parquet"):
        if f.stat().st_mtime < 1_000_000_000 or f.stat().st_mtime > 1_500_000_000:
            os.utime(f, (1_000_000_000 + at,) * 2)


def _run(spark, root, checkpoint="ck"):
    U.start_update_stream(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema, ["k"],
                          f"{root}/table", f"{root}/{checkpoint}").awaitTermination()


def _table(spark, root, table="table"):
    rows = U.updated(spark, f"{root}/{table}", ["k"]).collect()
    assert len({r.k for r in rows}) == len(rows)
    return {r.k: r.v for r in rows}


def test_replay_of_a_batch_whose_commit_record_is_lost(spark):
    root = _start(spark)
    _add(spark, root, [(2, 2.0)], 1)
    _run(spark, root)
    _add(spark, root, [(1, 5.0), (3, 3.0)], 2)
    _run(spark, root)
    before = U.finished_batches(spark, f"{root}/table")
    local = root.removeprefix("file:")
    for name in ("1", ".1.crc"):
        os.remove(f"{local}/ck/commits/{name}")
    _run(spark, root)
    assert _table(spark, root) == {1: 5.0, 2: 2.0, 3: 3.0}
    assert U.finished_batches(spark, f"{root}/table") == before and len(before) == 2


def test_new_checkpoint_reads_all_files_again(spark):
    root = _start(spark)
    _add(spark, root, [(1, 2.0), (10, 1.0)], 1)
    _run(spark, root, "ck-a")
    _add(spark, root, [(11, 2.0), (10, 3.0)], 2)
    _run(spark, root, "ck-a")
    want = {1: 2.0, 10: 3.0, 11: 2.0}
    assert _table(spark, root) == want
    _run(spark, root, "ck-b")
    assert _table(spark, root) == want


def _arrived(spark, rows, at):
    return spark.createDataFrame(rows, SCHEMA).withColumn(U.ARRIVED, F.lit(at).cast("bigint"))


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0, 1, 2]])
def test_streams_at_once_in_any_order_and_repeated(spark, order):
    root = _start(spark, [(1, 1.0), (None, 0.0)])
    calls = [("a", 0, [(1, 7.0), (2, 7.0)], 10), ("b", 0, [(1, 8.0), (None, 8.0)], 20), ("a", 1, [(2, 9.0), (3, 9.0)], 15)]
    for i in order:
        stream, number, rows, at = calls[i]
        U.write_batch(_arrived(spark, rows, at), f"{root}/table", ["k"], stream, number)
    assert _table(spark, root) == {1: 8.0, 2: 9.0, 3: 9.0, None: 8.0}


def test_compacted_table_keeps_times(spark):
    """Older files that come after a compaction do not win over its rows."""
    root = _start(spark)
    U.write_batch(_arrived(spark, [(1, 5.0), (2, 5.0)], 50), f"{root}/table", ["k"], "a", 0)
    U.compact(spark, f"{root}/table", ["k"], f"{root}/next")
    assert _table(spark, root, "next") == {1: 5.0, 2: 5.0}
    U.write_batch(_arrived(spark, [(1, 4.0), (2, 6.0), (3, 4.0)], 40), f"{root}/next", ["k"], "a", 1)
    U.write_batch(_arrived(spark, [(2, 6.0)], 60), f"{root}/next", ["k"], "a", 2)
    assert _table(spark, root, "next") == {1: 5.0, 2: 6.0, 3: 4.0}


def test_unfinished_batch_is_not_read(spark):
    root = _start(spark)
    path = U.write_batch(_arrived(spark, [(1, 5.0)], 50), f"{root}/table", ["k"], "a", 0)
    os.remove(f"{path}/_SUCCESS".removeprefix("file:"))
    assert _table(spark, root) == {1: 1.0}
    U.write_batch(_arrived(spark, [(1, 5.0)], 50), f"{root}/table", ["k"], "a", 0)
    assert _table(spark, root) == {1: 5.0}


def test_base_is_not_shuffled_for_small_batches(spark):
    root = _start(spark)
    U.write_batch(_arrived(spark, [(1, 5.0)], 50), f"{root}/table", ["k"], "a", 0)
    plan = U.updated(spark, f"{root}/table", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("new", [[(None, 1, 9.0)], [(None, 2, 9.0), (dt.datetime(2024, 1, 2, 5), 1, 8.0)]])
def test_partitioned_merge_keeps_rows_without_a_day(spark, new):
    schema = "datetime timestamp_ntz, k int, v double"
    old = [(dt.datetime(2024, 1, 1, 5), 1, 1.0), (dt.datetime(2024, 1, 2, 5), 1, 2.0), (None, 1, 3.0), (None, 3, 4.0)]
    path = scratch_path(spark, "null-day")
    U.init_partitioned_table(spark.createDataFrame(old, schema), path, ["datetime", "k"])
    U.merge_into_partitioned(spark.createDataFrame(new, schema), path, ["datetime", "k"])
    want = {(d, k): v for d, k, v in old} | {(d, k): v for d, k, v in new}
    assert {(r.datetime, r.k): r.v for r in spark.read.parquet(path).collect()} == want


def test_newest_row_comes_whole_from_a_hash_aggregate(spark):
    old = spark.createDataFrame([(1, 1.0, 10), (2, None, 20)], "k int, a double, b int")
    new = spark.createDataFrame([(1, None, 11), (1, 3.0, 12), (3, 4.0, 30)], "k int, a double, b int")
    out = keep_newest(union_batches(old, new), ["k"])
    got = {r.k: (r.a, r.b) for r in out.collect()}
    assert got[1] in {(None, 11), (3.0, 12)} and got[2] == (None, 20) and got[3] == (4.0, 30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and "HashAggregate" in plan
    nulls = spark.createDataFrame([(None, 1.0, 1)], "k int, a double, b int")
    assert upsert(nulls, nulls.withColumn("b", F.lit(2)), ["k"], current_unique=True).count() == 1


def test_folds_keep_rows_without_a_time_and_many_times(spark):
    base = spark.range(200).withColumnRenamed("id", "row_id")
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    seconds = base.withColumn("datetime", F.when(F.col("row_id") % 5 == 0, None).otherwise(
        t0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("row_id").cast("decimal(18,6)"))))
    got = assign_folds(seconds).collect()
    assert len(got) == 200
    order = sorted(got, key=lambda r: (r.datetime is not None, r.datetime or dt.datetime.min, r.row_id))
    t = 200 // 7
    first = 200 - 6 * t
    assert [r.fold for r in order] == [-1 if p < first else (p - first) // t for p in range(200)]


def test_global_side_is_judged_by_its_own_rows(spark):
    """A budget between the two sides' sizes: the global one alone is broadcast."""
    from testdata_paths import SF001
    from wattsmith.operators import weather as wx
    from wattsmith.operators.joins import row_width_bytes
    from wattsmith.plans import catalog
    means = wx.means_side(catalog._hw(spark, SF001), "m")
    whole = wx.global_side(means)
    assert whole.rows == whole.df.count() < means.rows
    assert wx.local_side(means).rows == means.rows - whole.rows
    spark.conf.set(BUDGET_CONF, str(whole.rows * row_width_bytes(whole.df) + 1))
    try:
        means = wx.means_side(catalog._hw(spark, SF001), "m")
        assert wx.global_side(means).broadcast and not wx.local_side(means).broadcast
    finally:
        spark.conf.unset(BUDGET_CONF)


def test_raw_rows_are_not_expanded(spark):
    from testdata_paths import SF001
    from wattsmith.operators import target as tgt
    from wattsmith.operators import weather as wx
    from wattsmith.plans import catalog
    for df in (wx.hourly_means(catalog._hw(spark, SF001)), tgt.sum_lag_table(catalog._history(spark, SF001))):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_csv_filter_is_pushed(spark, tmp_path):
    from wattsmith.sources.readers import read_table
    from wattsmith.sources.schemas import SCHEMAS
    path = str(tmp_path / "gas.csv")
    with open(path, "w") as f:
        f.write("extra,forecast_date,highest_price_per_mwh,lowest_price_per_mwh\nx,2024-01-02,2.0,1.0\ny,2024-01-05,3.0,1.5\n")
    df = read_table(spark, path, SCHEMAS["gas_prices"]).filter(F.col("forecast_date") >= F.lit("2024-01-04").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(forecast_date" in plan
    assert [r.highest_price_per_mwh for r in df.collect()] == [3.0]
