"""New batches with rejects, the input signature, holiday rules, bins and missing flags."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattsmith.functions import holidays as H
from wattsmith.operators import bins
from wattsmith.plans.signature import accept, compare, conform, holds
from wattsmith.sources import schemas as S
from wattsmith.sources.batches import read_batch

GAS = "x,forecast_date,highest_price_per_mwh,lowest_price_per_mwh\n"


def _csv(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_rejects_hold_file_and_line(spark, tmp_path):
    path = _csv(tmp_path / "in", a=GAS + "p,2024-01-02,2.0,1.0\nq,2024-01-03,cheap,1.0\nr,2024-01-04,2.0\n",
                b=GAS + "s,2024-01-05,,3.0\nt,yesterday,2.0,1.0\nu,2024-01-06,2.0,1.0,9\n")
    batch = read_batch(spark, path, S.SCHEMAS["gas_prices"])
    assert {(r.forecast_date.day, r.lowest_price_per_mwh, r.highest_price_per_mwh) for r in batch.rows.collect()} == {
        (2, 1.0, 2.0), (5, 3.0, None)}
    assert batch.rows.columns == S.GAS_PRICES_COLS
    assert {(r.file[-5:], r.record[0]) for r in batch.rejects.collect()} == {
        ("a.csv", "q"), ("a.csv", "r"), ("b.csv", "t"), ("b.csv", "u")}
    assert (batch.n_rows, batch.n_rejects) == (2, 4)
    assert batch.refuse_above(0.7) is batch
    with pytest.raises(ValueError, match="4 of 6 lines"):
        batch.refuse_above(0.5)


def test_fewer_columns_do_not_hide_a_bad_line(spark, tmp_path):
    path = _csv(tmp_path / "in", a=GAS + "p,2024-01-02,2.0,1.0\nq,2024-01-03,cheap,1.0\n")
    batch = read_batch(spark, path, S.SCHEMAS["gas_prices"], ["forecast_date"])
    assert batch.rows.columns == ["forecast_date"] and (batch.n_rows, batch.n_rejects) == (1, 1)


def test_batch_without_rows_and_without_rejects(spark, tmp_path):
    empty = read_batch(spark, _csv(tmp_path / "e", a=GAS), S.SCHEMAS["gas_prices"])
    assert (empty.n_rows, empty.n_rejects, empty.rows.count(), empty.rejects.count()) == (0, 0, 0, 0)
    assert empty.refuse_above(0.0) is empty
    clean = read_batch(spark, _csv(tmp_path / "c", a=GAS + "p,2024-01-02,2.0,1.0\n"), S.SCHEMAS["gas_prices"])
    assert (clean.n_rows, clean.n_rejects, clean.rejects.count()) == (1, 0, 0)


def test_file_with_another_header_is_refused(spark, tmp_path):
    swapped = "x,forecast_date,lowest_price_per_mwh,highest_price_per_mwh\n"
    path = _csv(tmp_path / "in", a=GAS + "p,2024-01-02,2.0,1.0\n", b=swapped + "q,2024-01-03,1.0,2.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_batch(spark, path, S.SCHEMAS["gas_prices"])



def test_verdicts(spark):
    saved = spark.createDataFrame([], "a int, b double, c float, d date, e string, f int").schema
    given = spark.createDataFrame([], "a bigint, b float, c double, d date, e int, g int").schema
    assert {f.column: f.verdict for f in compare(saved, given)} == {
        "a": "narrowed", "b": "widened", "c": "narrowed", "d": "same", "e": "other", "f": "missing", "g": "extra"}
    assert holds(T.DoubleType(), T.IntegerType()) and not holds(T.FloatType(), T.IntegerType())
    assert not holds(T.DoubleType(), T.LongType()) and holds(T.FloatType(), T.ShortType())
    assert holds(T.DecimalType(12, 2), T.IntegerType()) and not holds(T.DecimalType(11, 2), T.IntegerType())


def test_accept_casts_what_fits_and_refuses_the_rest(spark):
    saved = spark.createDataFrame([], "a int, b double").schema
    out = accept(spark.sql("SELECT CAST(1 AS SMALLINT) AS a, CAST(2.5 AS FLOAT) AS b, 'x' AS z"), saved)
    assert out.dtypes == [("a", "int"), ("b", "double"), ("z", "string")]
    with pytest.raises(ValueError, match="a narrowed .saved int, given bigint."):
        accept(spark.sql("SELECT 1L AS a, 2.5D AS b"), saved)
    with pytest.raises(ValueError, match="b missing"):
        accept(spark.sql("SELECT 1 AS a"), saved)


def test_conform_counts_what_it_loses(spark):
    saved = spark.createDataFrame([], "a int, b int, d date").schema
    given = spark.sql("""SELECT * FROM VALUES (1L, 1.0D, TIMESTAMP_NTZ'2024-01-01 00:00:00'), (3000000000L, 1.5D, NULL),
        (NULL, NULL, TIMESTAMP_NTZ'2024-01-01 05:00:00') AS t(a, b, d)""")
    out, lost = conform(given, saved)
    assert lost == {"a": 1, "b": 1, "d": 1}
    assert out.dtypes == [("a", "int"), ("b", "int"), ("d", "date")]
    assert sorted(r.a for r in out.collect() if r.a is not None) == [1]


def test_scoring_refuses_a_narrowed_column(spark):
    from wattsmith.plans.training import fit, predict
    df = spark.range(60).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("int").alias("x"),
                                F.col("id").cast("double").alias("target"))
    model = fit(df, {"maxIter": 1, "maxDepth": 2})
    assert predict(model, df.drop("target"), df.schema).count() == 60
    with pytest.raises(ValueError, match="x narrowed"):
        predict(model, df.withColumn("x", F.col("x").cast("bigint")), df.schema)


def _days(spark, first, last, rules):
    years = spark.range(first, last + 1).withColumnRenamed("id", "year")
    return {r.date for r in H.holiday_table(years, rules).collect()}


def test_estonian_rules_equal_the_calendar(spark):
    from wattsmith.functions import calendar as cal
    years = spark.range(1990, 2060).withColumnRenamed("id", "year")
    assert _days(spark, 1990, 2059, H.RULES["EE"]) == {r.date for r in cal.holiday_dates(years).collect()}
    assert {r.date for r in cal.holiday_dates(years, country="FI").collect()} == _days(spark, 1990, 2059, H.RULES["FI"])


def test_known_holidays(spark):
    us = _days(spark, 2021, 2022, H.RULES["US"])
    # New Year's Day of 2022 is a Saturday, Independence Day of 2021 a Sunday
    assert dt.date(2021, 12, 31) in us and dt.date(2022, 1, 1) not in us
    assert dt.date(2021, 7, 5) in us and dt.date(2021, 11, 25) in us and dt.date(2022, 5, 30) in us
    assert dt.date(2021, 6, 18) in us and len(_days(spark, 2020, 2020, H.RULES["US"])) == 10
    fi = _days(spark, 2024, 2024, H.RULES["FI"])
    assert {dt.date(2024, 6, 22), dt.date(2024, 11, 2), dt.date(2024, 5, 9)} <= fi and len(fi) == 13


@pytest.mark.parametrize("country", ["EE", "FI", "US"])
def test_flag_equals_table(spark, country):
    rules = H.RULES[country]
    days = spark.sql("SELECT explode(sequence(DATE'2019-12-25', DATE'2024-01-10')) AS d")
    flagged = {r.d for r in days.filter(H.is_holiday(F.col("d"), rules)).collect()}
    assert flagged == {d for d in _days(spark, 2019, 2024, rules) if dt.date(2019, 12, 25) <= d <= dt.date(2024, 1, 10)}
    null = spark.range(1).select(H.is_holiday(F.lit(None).cast("date"), rules).alias("h"))
    assert null.first().h is False


def test_rules_check_themselves():
    with pytest.raises(ValueError):
        H.fixed(2, 29)
    with pytest.raises(ValueError):
        H.fixed(1, 1, "someday")
    with pytest.raises(ValueError, match="no rules"):
        H.rules_for("XX")


def _values(n=40000):
    rng = np.random.default_rng(3)
    return {"a": rng.normal(size=n), "b": rng.integers(0, 7, n).astype(float), "c": rng.exponential(size=n) ** 3}


def test_edges_within_the_rank_error(spark):
    """Sketches of 8 tasks merged: every edge's rank is within 1.7 / k of the wanted one."""
    import pandas as pd
    values, n_bins, k = _values(), 50, 512
    df = spark.createDataFrame(pd.DataFrame(values)).repartition(8)
    parts = [bins.sketches(df.filter(F.col("b") < 3), list(values), k), bins.sketches(df.filter(F.col("b") >= 3), list(values), k)]
    merged = bins.merge_sketches(parts[0].unionByName(parts[1]))
    assert {r.feature: r.n for r in merged.collect()} == dict.fromkeys(values, 40000)
    edges = bins.edge_lists(bins.bin_edges(merged, n_bins))
    assert edges["b"] == sorted(set(edges["b"])) and len(edges["b"]) <= 7
    for c in ("a", "c"):
        x = np.sort(values[c])
        assert len(edges[c]) == n_bins - 1
        ranks = np.searchsorted(x, edges[c], side="right") / len(x)
        assert np.abs(ranks - np.arange(1, n_bins) / n_bins).max() < 2 * 1.7 / k


def test_bins_flags_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate([1.0, 2.0, 2.0, 3.0, None, nan, inf, -inf])]
    df = spark.createDataFrame(rows, "row_id int, x double").withColumn("none", F.lit(None).cast("double"))
    sk = bins.sketches(df, ["x", "none"])
    assert {r.feature: (r.n, r.n_missing) for r in sk.collect()} == {"x": (6, 2), "none": (0, 8)}
    edges = bins.edge_lists(bins.bin_edges(sk, 4))
    assert edges["none"] == []
    out = {r.row_id: (r.x__b, r.x__m, r.none__b) for r in bins.with_bins(df, {"x": [1.0, 2.0, inf], "none": []}).collect()}
    assert out == {0: (0, 0, -1), 1: (1, 0, -1), 2: (1, 0, -1), 3: (2, 0, -1), 4: (-1, 1, -1), 5: (-1, 1, -1),
                   6: (2, 0, -1), 7: (0, 0, -1)}
    assert bins.splits([1.0], floor=-1e9)[1] == math.nextafter(-1e9, math.inf)


def test_edges_are_shared_by_folds(spark):
    """Binned inputs and missing flags in a cross validation: the edges are given, not fitted."""
    from wattsmith.plans.training import build_pipeline, cross_validate
    df = spark.range(400).select(
        F.col("id").alias("row_id"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                      + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("datetime"),
        F.when(F.col("id") % 9 > 0, F.sin(F.col("id") / 5)).alias("x"), (F.sin(F.col("id") / 5) * 3).alias("target"))
    edges = bins.edge_lists(bins.bin_edges(bins.sketches(df, ["x"]), 16))
    stages = build_pipeline(df, {"maxIter": 2}, edges=edges, missing_flags=True).getStages()
    assert stages[-2].getInputCols() == ["x__b", "x__m"]
    got = cross_validate(df, {"maxIter": 3, "maxDepth": 3}, n_splits=2, edges=edges, missing_flags=True).collect()
    assert len(got) == 2 and all(r.mae < 1.9 for r in got)
