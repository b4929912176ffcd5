"""Spans of regular expressions in whole texts, with built-in functions only.

Spark's regex functions return matched strings, not places. Cutting a text at the
matches gives the gaps between them, so the running lengths of gaps and matches
give each match's place, in code points.

Patterns are written so that a text is scanned in linear time and without
recursion: possessive repeats, and a look-behind where a run of characters that
failed at its first one would fail at all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let, prefix_sums

BEFORE, AFTER = 40, 20  # characters of context kept around a match
FOUND = "array<struct<kind:string,start:bigint,end:bigint,value:string,context:string>>"


def find(text: Column, kind: str, pattern: str, hint: Column | None = None) -> Column:
    """``FOUND`` for the leftmost non-overlapping matches of ``pattern``.

    ``hint``: a cheap condition without which no match can exist.
    """
    def placed(matches, gaps):
        lens = F.transform(matches, lambda m, i: (F.length(gaps[i]) + F.length(m)).cast("bigint"))
        return let(prefix_sums(lens), lambda before: F.transform(
            matches, lambda m, i: F.struct(
                F.lit(kind).alias("kind"),
                (before[i] + F.length(gaps[i])).alias("start"),
                (before[i] + F.length(gaps[i]) + F.length(m)).alias("end"),
                m.alias("value"),
                F.concat(F.right(gaps[i], F.lit(BEFORE)), F.lit(" "),
                         F.left(gaps[i + 1], F.lit(AFTER))).alias("context"))))

    there = text.rlike(pattern) if hint is None else hint & text.rlike(pattern)
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda m: let(F.split(text, pattern, -1), lambda g: placed(m, g)))
    return F.when(there, found).otherwise(F.array()).cast(FOUND)


def without_overlap(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that share no character with any of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(
        others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def digest(spans: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """``kind:start:end`` of the spans in their order, comma-joined."""
    kept = F.filter(spans, keep) if keep else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
