"""Calendar, cyclic and segment columns; the holiday dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(ts: str = "datetime") -> dict[str, Column]:
    """dayofyear, hour, day, ISO weekday (Mon=1..Sun=7), month, year."""
    t = F.col(ts)
    return {
        "dayofyear": F.dayofyear(t),
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "weekday": F.weekday(t) + F.lit(1),
        "month": F.month(t),
        "year": F.year(t),
    }


def segment_column(keys=("county", "is_business", "product_type", "is_consumption")) -> Column:
    """``county_isbusiness_producttype_isconsumption``; NULL if any key is NULL."""
    parts = []
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit("_"))
        parts.append(F.col(k).cast("string"))
    return F.concat(*parts)


def cyclic_columns(dayofyear: Column, hour: Column) -> dict[str, Column]:
    doy = F.lit(math.pi) * dayofyear / F.lit(183)
    hr = F.lit(math.pi) * hour / F.lit(12)
    return {"sin(dayofyear)": F.sin(doy), "cos(dayofyear)": F.cos(doy),
            "sin(hour)": F.sin(hr), "cos(hour)": F.cos(hr)}


def add_general_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Calendar + segment + cyclic columns in one projection."""
    cal = calendar_columns(ts)
    cols = dict(cal)
    cols["segment"] = segment_column()
    cols.update(cyclic_columns(cal["dayofyear"], cal["hour"]))
    return df.withColumns(cols)


# ---------------------------------------------------------------------------
# Holiday calendar. Estonian public holidays (month, day), with
# the first year each applies; plus the Easter-relative days (offset from Easter
# Sunday: Good Friday -2, Easter Sunday 0, Pentecost +49).
# ---------------------------------------------------------------------------
EE_FIXED_HOLIDAYS = [
    (1, 1, None),     # New Year's Day
    (2, 24, None),    # Independence Day
    (5, 1, None),     # Spring Day
    (6, 23, None),    # Victory Day
    (6, 24, None),    # Midsummer Day
    (8, 20, 1998),    # Independence Restoration Day
    (12, 24, 2005),   # Christmas Eve
    (12, 25, None),   # Christmas Day
    (12, 26, None),   # Boxing Day
]
EE_EASTER_OFFSETS = [-2, 0, 49]
# ---------------------------------------------------------------------------


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian computus), as DATE."""
    y = year.cast("int")
    a = y % 19
    b = F.floor(y / 100).cast("int")
    c = y % 100
    d = F.floor(b / 4).cast("int")
    e = b % 4
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4).cast("int")
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451).cast("int")
    month = F.floor((h + l_ - 7 * m + 114) / 31).cast("int")
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y, month, day)


def is_ee_holiday(date: Column) -> Column:
    """Whether ``date`` is an Estonian public holiday, as a column expression (no
    table, no join, no extra pass): fixed (month, day) pairs with their first year,
    or a day at a fixed offset from that year's Easter Sunday."""
    y, m, d = F.year(date), F.month(date), F.dayofmonth(date)
    fixed = [(m == mm) & (d == dd) & (F.lit(True) if since is None else y >= F.lit(since))
             for mm, dd, since in EE_FIXED_HOLIDAYS]
    off = F.datediff(date, easter_sunday(y))
    cond = off.isin(*EE_EASTER_OFFSETS)
    for c in fixed:
        cond = cond | c
    return F.coalesce(cond, F.lit(False))


def holiday_dates(years: DataFrame, year_col: str = "year", country: str = "EE") -> DataFrame:
    """``(date)`` rows: every holiday of ``country`` in each year of ``years``.

    Built per distinct year with Spark expressions, so the table is derived from
    the data (at most 12 rows per year) and never collected to the driver.
    """
    if country != "EE":
        from .holidays import holiday_table, rules_for
        return holiday_table(years, rules_for(country), year_col)
    yrs = years.select(F.col(year_col).cast("int").alias("_y")).distinct()
    y = F.col("_y")
    fixed = [F.make_date(y, F.lit(m), F.lit(d)) if since is None
             else F.when(y >= F.lit(since), F.make_date(y, F.lit(m), F.lit(d)))
             for m, d, since in EE_FIXED_HOLIDAYS]
    easter = easter_sunday(y)
    moving = [F.date_add(easter, off) for off in EE_EASTER_OFFSETS]
    return (yrs.select(F.explode(F.array(*fixed, *moving)).alias("date"))
            .filter(F.col("date").isNotNull()).distinct())
