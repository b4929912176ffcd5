"""Holidays of any country from a table of rules, evaluated as column expressions.

A rule gives at most one date a year: a fixed day, a day relative to Easter, or the
first given weekday on or after a day (which covers "third Monday of" and "last Monday
of"). It may hold from or up to a year, and a fixed day may be observed on another
day when it falls on a weekend. Nothing is collected and no table is joined:
``is_holiday`` is one expression per row, ``holiday_table`` one row per holiday.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import EE_EASTER_OFFSETS, EE_FIXED_HOLIDAYS, easter_sunday

MON, TUE, WED, THU, FRI, SAT, SUN = range(7)

# How a fixed day on a weekend moves: (days a Saturday moves, days a Sunday moves).
SHIFTS = {None: (0, 0), "nearest": (-1, 1), "monday": (2, 1), "sunday_to_monday": (0, 1)}


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``fixed`` (month, day), ``easter`` (offset in days) or ``weekday``
    (the first ``weekday`` on or after month, day). ``observed`` names a shift in
    ``SHIFTS``: the moved day takes the place of the day itself."""

    kind: str
    month: int = 1
    day: int = 1
    offset: int = 0
    weekday: int = MON
    since: int | None = None
    until: int | None = None
    observed: str | None = None

    def __post_init__(self):
        if self.kind not in ("fixed", "easter", "weekday"):
            raise ValueError(f"unknown kind of rule {self.kind!r}")
        if self.observed not in SHIFTS:
            raise ValueError(f"unknown shift {self.observed!r}")
        if (self.month, self.day) == (2, 29):
            raise ValueError("a rule's day must exist in every year")

    def holds(self, since: int | None = None, until: int | None = None) -> "Rule":
        return replace(self, since=since, until=until)

    def on(self, year: Column) -> Column:
        """The rule's date in ``year``; NULL in years in which it does not hold."""
        if self.kind == "easter":
            date = F.date_add(easter_sunday(year), self.offset)
        else:
            date = F.make_date(year, F.lit(self.month), F.lit(self.day))
        if self.kind == "weekday":
            date = F.date_add(date, (F.lit(self.weekday + 7) - F.weekday(date)) % 7)
        sat, sun = SHIFTS[self.observed]
        if (sat, sun) != (0, 0):
            day = F.weekday(date)
            date = F.date_add(date, F.when(day == SAT, sat).when(day == SUN, sun).otherwise(0))
        valid = [c for c in ((year >= self.since) if self.since is not None else None,
                             (year <= self.until) if self.until is not None else None) if c is not None]
        for c in valid:
            date = F.when(c, date)
        return date

    @property
    def may_leave_year(self) -> bool:
        """Whether the date can fall into a neighbouring year: a shifted or wrapped day
        in the first or last week."""
        edge = (self.month, self.day) >= (12, 25) or (self.month, self.day) <= (1, 2)
        return self.kind != "easter" and edge and (self.kind == "weekday" or self.observed is not None)


def fixed(month: int, day: int, observed: str | None = None) -> Rule:
    return Rule("fixed", month, day, observed=observed)


def easter(offset: int) -> Rule:
    return Rule("easter", offset=offset)


def on_or_after(month: int, day: int, weekday: int) -> Rule:
    return Rule("weekday", month, day, weekday=weekday)


def nth(month: int, weekday: int, n: int) -> Rule:
    """The n-th ``weekday`` of ``month``; ``n`` = -1 the last one (not of February)."""
    if n == -1:
        last = {4: 30, 6: 30, 9: 30, 11: 30}.get(month, 31)
        if month == 2:
            raise ValueError("the last weekday of February needs a rule of its own")
        return on_or_after(month, last - 6, weekday)
    return on_or_after(month, 7 * (n - 1) + 1, weekday)


# ---------------------------------------------------------------------------
# Public holidays by law. EE as in ``calendar``.
# ---------------------------------------------------------------------------
RULES: dict[str, list[Rule]] = {
    "EE": [fixed(m, d).holds(since) for m, d, since in EE_FIXED_HOLIDAYS] + [easter(o) for o in EE_EASTER_OFFSETS],
    "FI": [
        fixed(1, 1), fixed(1, 6), easter(-2), easter(0), easter(1), fixed(5, 1), easter(39), easter(49),
        on_or_after(6, 20, SAT),   # Midsummer Day
        on_or_after(10, 31, SAT),  # All Saints' Day
        fixed(12, 6), fixed(12, 25), fixed(12, 26),
    ],
    "US": [
        fixed(1, 1, "nearest"),
        nth(1, MON, 3).holds(since=1986),             # Martin Luther King Jr. Day
        nth(2, MON, 3),                               # Washington's Birthday
        nth(5, MON, -1),                              # Memorial Day
        fixed(6, 19, "nearest").holds(since=2021),    # Juneteenth
        fixed(7, 4, "nearest"),
        nth(9, MON, 1),                               # Labor Day
        nth(10, MON, 2),                              # Columbus Day
        fixed(11, 11, "nearest"),                     # Veterans Day
        nth(11, THU, 4),                              # Thanksgiving
        fixed(12, 25, "nearest"),
    ],
}
# ---------------------------------------------------------------------------


def rules_for(country: str) -> list[Rule]:
    if country not in RULES:
        raise ValueError(f"no rules for {country!r}; add them to RULES or pass holidays=")
    return RULES[country]


def _dates(rules: list[Rule], year: Column) -> list[Column]:
    """Every date the rules may have in ``year``, those of a neighbouring year's rules
    that cross into it included."""
    out = [r.on(year) for r in rules]
    for r in rules:
        if r.may_leave_year:
            out += [r.on(year - 1), r.on(year + 1)]
    return out


def is_holiday(date: Column, rules: list[Rule]) -> Column:
    """Whether ``date`` is a holiday by ``rules`` (false for a NULL date)."""
    return F.coalesce(F.array_contains(F.array_compact(F.array(*_dates(rules, F.year(date)))), date), F.lit(False))


def holiday_table(years: DataFrame, rules: list[Rule], year_col: str = "year") -> DataFrame:
    """``(date)``: every holiday in each year of ``years``, at most a row per rule and year."""
    y = F.col("_y")
    own = years.select(F.col(year_col).cast("int").alias("_y")).filter("_y IS NOT NULL").distinct()
    dates = own.select("_y", F.explode(F.array_compact(F.array(*_dates(rules, y)))).alias("date"))
    return dates.filter(F.year("date") == y).select("date").distinct()
