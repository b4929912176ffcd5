"""Sums and means of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so another partitioning or a repeated task can
change the last digits. Here a value is cut into four whole numbers, the digits of
``x = p0 * 2**28 + p1 + p2 * 2**-28 + p3 * 2**-56`` with p1 to p3 below 2**28 in
size. Whole numbers add exactly in any order and combine map-side; only the four
totals are turned back into a double. Cutting is exact down to 2**-56 (finer digits are
cut off), and a group may have 2**35 rows; beyond that the total overflows, which is an
error in ANSI mode and never a wrong sum.

NULLs are skipped, as ``sum`` does, and a group of NULLs sums to NULL. NaN and
infinities give NaN and infinities. Finite values of 2**56 or more cannot be cut: they
are added as doubles, so only their sum depends on the order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = float(2 ** 28)
LARGEST = float(2 ** 56)


def parts(x: Column) -> list[Column]:
    """The four whole numbers (bigint) of a double below ``LARGEST``, else zeros; and
    what could not be cut (double)."""
    x = x.cast("double")
    fits = F.abs(x) < LARGEST
    x0 = F.when(fits, x).when(x.isNotNull(), F.lit(0.0))
    p0 = (x0 / STEP).cast("bigint")           # a cast drops the fraction
    r1 = x0 - p0 * STEP                       # exact: below 2**28, on x's own grid
    p1 = r1.cast("bigint")
    r2 = (r1 - p1) * STEP
    p2 = r2.cast("bigint")
    p3 = ((r2 - p2) * STEP).cast("bigint")
    return [p0, p1, p2, p3, F.when(~fits, x).when(x.isNotNull(), F.lit(0.0))]


def joined(totals: list[Column]) -> Column:
    """The double that summed parts stand for, the small ones added first."""
    p0, p1, p2, p3, rest = totals
    return ((p3.cast("double") / STEP + p2.cast("double")) / STEP + p1.cast("double")) + p0.cast("double") * STEP + rest


def exact_sum(x: Column) -> Column:
    """Aggregate: the sum of a double column."""
    return joined([F.sum(p) for p in parts(x)])


def exact_mean(x: Column) -> Column:
    """Aggregate: the mean of a double column (NULL for none)."""
    return F.try_divide(exact_sum(x), F.count(x))
