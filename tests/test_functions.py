"""Scalar traps: weekday numbering, segment NULLs, safe ratio, row statistics,
wall-clock hour shifts, float station keys, Easter dates."""

import datetime as dt
import math

from pyspark.sql import functions as F

from wattsmith.functions import calendar as cal
from wattsmith.functions.rowwise import row_mean, row_std, safe_ratio, segment_numeric
from wattsmith.operators.joins import shift_hours


def test_iso_weekday_and_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), ), (dt.datetime(2024, 1, 7, 23), ),
                                (dt.datetime(2024, 12, 31, 0), )], "datetime timestamp_ntz")
    rows = df.select(*[v.alias(k) for k, v in cal.calendar_columns().items()]).collect()
    assert [r.weekday for r in rows] == [1, 7, 2]          # Monday=1, Sunday=7
    assert rows[2].dayofyear == 366                         # leap year
    assert rows[0].hour == 5 and rows[1].day == 7 and rows[2].month == 12


def test_segment_null_propagates(spark):
    df = spark.createDataFrame([(1, 0, 3, 1), (None, 0, 3, 1)],
                               "county int, is_business int, product_type int, is_consumption int")
    out = [r.s for r in df.select(cal.segment_column().alias("s")).collect()]
    assert out == ["1_0_3_1", None]
    assert df.select(segment_numeric(F.lit("10_1_2_0")).alias("x")).first().x == 10120.0


def test_cyclic_values(spark):
    df = spark.createDataFrame([(183, 6)], "d int, h int")
    r = df.select(*[v.alias(k) for k, v in
                    cal.cyclic_columns(F.col("d"), F.col("h")).items()]).first()
    assert abs(r["sin(dayofyear)"] - math.sin(math.pi)) < 1e-12
    assert abs(r["cos(hour)"] - math.cos(math.pi / 2)) < 1e-12


def test_safe_ratio_and_row_stats(spark):
    df = spark.createDataFrame([(1.0, -0.001, None, None, None), (2.0, 1.0, 2.0, None, None),
                                (1.0, 3.0, 2.0, 4.0, None), (None, None, None, None, None)],
                               "a double, b double, c double, d double, e double")
    cols = [F.col(c) for c in "acde"]
    rows = df.select(safe_ratio(F.col("a"), F.col("b")).alias("r"), row_mean(cols).alias("m"),
                     row_std(cols).alias("s")).collect()
    assert rows[0].r is None                                # exact zero denominator -> NULL
    assert abs(rows[1].r - 2.0 / 1.001) < 1e-12
    assert rows[0].m == 1.0 and rows[0].s is None           # one value: no sample std
    assert rows[1].m == 2.0 and rows[1].s == 0.0
    assert abs(rows[2].m - 7.0 / 3) < 1e-12
    assert abs(rows[2].s - 1.5275252316519468) < 1e-12     # statistics.stdev([1, 2, 4])
    assert rows[3].m is None and rows[3].s is None


def test_hour_shift_is_wall_clock(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Tallinn")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 29, 3, 30),)], "datetime timestamp_ntz")
        assert shift_hours(df, 48).first().datetime == dt.datetime(2024, 3, 31, 3, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_float_station_keys(spark):
    from wattsmith.operators.weather import map_stations
    w = spark.createDataFrame([(57.6, 21.7, 1.0), (57.9, 21.7, 2.0)],
                              "latitude double, longitude double, temperature double")
    m = spark.createDataFrame([(21.7, 57.6, 5)], "longitude double, latitude double, county int")
    out = {r.temperature: r.county for r in map_stations(w, m).collect()}
    assert out == {1.0: 5, 2.0: None}


def test_easter_and_ee_holidays(spark):
    years = spark.createDataFrame([(y,) for y in range(2021, 2026)], "year int")
    easter = {r.y: r.e for r in years.select(F.col("year").alias("y"),
                                             cal.easter_sunday(F.col("year")).alias("e")).collect()}
    assert easter == {2021: dt.date(2021, 4, 4), 2022: dt.date(2022, 4, 17),
                      2023: dt.date(2023, 4, 9), 2024: dt.date(2024, 3, 31),
                      2025: dt.date(2025, 4, 20)}
    days = {r.date for r in cal.holiday_dates(years.filter("year = 2024")).collect()}
    assert dt.date(2024, 2, 24) in days and dt.date(2024, 3, 29) in days    # Good Friday
    assert dt.date(2024, 5, 19) in days and dt.date(2024, 12, 24) in days   # Pentecost, Xmas Eve
    assert len(days) == 12


def test_holiday_expression_equals_table(spark):
    days = spark.range(0, 366 * 30).select(
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    table = cal.holiday_dates(days.select(F.year("date").alias("year")))
    joined = days.join(table.withColumn("t", F.lit(True)), "date", "left").select(
        "date", F.coalesce("t", F.lit(False)).alias("t"), cal.is_ee_holiday(F.col("date")).alias("e"))
    assert joined.filter(F.col("t") != F.col("e")).count() == 0
    in_range = table.join(days, "date", "left_semi")
    assert joined.filter("e").count() == in_range.count() > 300


def test_easter_matches_dateutil_for_every_year(spark):
    """The Spark computus against an independent implementation, 1583-2999."""
    from dateutil.easter import easter
    years = spark.range(1583, 3000).select(F.col("id").cast("int").alias("y"))
    got = {r.y: r.e for r in years.select("y", cal.easter_sunday(F.col("y")).alias("e")).collect()}
    assert all(got[y] == easter(y) for y in range(1583, 3000))


def test_row_stats_property(spark):
    """Row mean / sample std equal Python's statistics on random rows with NULLs."""
    import statistics

    from hypothesis import given, settings
    from hypothesis import strategies as st

    val = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False, width=64))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(val, val, val, val), min_size=1, max_size=40))
    def check(rows):
        df = spark.createDataFrame(rows, "a double, b double, c double, d double")
        cols = [F.col(c) for c in "abcd"]
        out = df.select(row_mean(cols).alias("m"), row_std(cols).alias("s")).collect()
        for r, o in zip(rows, out):
            xs = [x for x in r if x is not None]
            if not xs:
                assert o.m is None and o.s is None
                continue
            assert math.isclose(o.m, statistics.fmean(xs), rel_tol=1e-9, abs_tol=1e-6)
            if len(xs) < 2:
                assert o.s is None
            else:
                assert math.isclose(o.s, statistics.stdev(xs), rel_tol=1e-6, abs_tol=1e-6)
    check()
