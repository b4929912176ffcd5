"""Operator 11: how filters interact, from sorted posting lists.

For every part of a table and every filter, the rows that fail it are kept as sorted
posting lists. Rows take places in the order (part, id); a list is cut at every
``SPAN`` places, so that one list has at most ``SPAN`` entries however large its part
is. Within a span, the rows that filters S remove together are the union of S's lists,
and those that filter k removes after S are k's list without that union. Both come
from merges that gallop: from the head of one list the place of the next list's head is
looked for in doubling steps, and everything up to there is taken or skipped at once.
Sizes are summed over a part's spans, and every order of filters reads its steps from
them: what a filter removes depends on the set applied before it, not on that set's
order.

Defined cases: a null part is the part ''. A null text is the empty text, which fails
the length filter only, and is a copy like any other. Texts are read whole. Rows with a
null id count as rows of their part; they have no smaller id and are smaller than none,
so they never fail the copy filter, and no label is theirs. Repeated rows count as often
as they stand there and are no copies of each other (their id is not smaller). Of
several labels of an id, one that says 1 is enough; labels without a row are ignored.
An empty table has no parts and gives no rows. Further columns, also of our names, are
ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.folds import ordered_positions
from wattsmith.operators.joins import materialize

from .common import bound_arrow, let, read_table, words_of

FILTERS = "ABCDE"
MARKS = ("good", "toxic")
SPAN = 4096
# The thresholds of the five filters.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """The failures that a text shows by itself: filters A to D."""
    counts = let(words_of(text), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"counts": counts, "C": 100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
            "D": text.rlike(SYMBOLS)}


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: part, id, row (a number of its own), a flag per
    filter (A to E) and per label (good, toxic)."""
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    own = text_failures(F.col("text"))
    own = materialize(
        d.select("id", "part", F.unhex(F.sha2("text", 256)).alias("content"),
                 own["counts"].alias("counts"), own["C"].alias("C"), own["D"].alias("D"))
        .select("id", "part", "content", (F.col("counts.n") < MIN_WORDS).alias("A"),
                (100 * F.col("counts.distinct") < MIN_DISTINCT_PERCENT * F.col("counts.n")).alias("B"), "C", "D",
                F.monotonically_increasing_id().alias("row")), "text-failures")
    first = (own.groupBy("content").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("content", "first"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    joined = own.join(first, "content", "left").join(marks, "id", "left")
    return materialize(joined.select(
        "part", "id", "row", "A", "B", "C", "D", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("E"),
        *[F.coalesce(m, F.lit(False)).alias(m) for m in MARKS]), "failures")


def posting_lists(failed: DataFrame, filters: Sequence[str] = FILTERS, span: int = SPAN) -> DataFrame:
    """(part, span, n, a sorted array<int> per filter and mark): the places, counted from
    the span's first, of the rows that carry the flag, and how many rows the span has."""
    flags = [*filters, *MARKS]
    placed = ordered_positions(failed.select("part", "id", "row", *flags), ["part", "id", "row"])
    place = (F.col("pos") % span).cast("int")
    # A number of partitions of its own, since little data makes much work in ``sizes``.
    parts = int(failed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.withColumn("span", F.floor(F.col("pos") / span)).repartition(parts, "part", "span")
    return dealt.groupBy("part", "span").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sort_array(F.collect_list(F.when(F.col(f), place))).alias(f) for f in flags])


def gallop(values: Sequence[int], x: int, start: int) -> int:
    """The first place from ``start`` on whose value is ``x`` or more, in doubling steps."""
    step, n = 1, len(values)
    low = start
    while low < n and values[low] < x:
        start, low, step = low + 1, low + step, 2 * step
    return bisect_left(values, x, start, min(low, n))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """The sorted union of sorted lists, each without repeats: the list with the least
    head gives all it has up to the next head of the others."""
    out: list[int] = []
    heads = [[v, 0] for v in lists if v]
    while len(heads) > 1:
        heads.sort(key=lambda h: h[0][h[1]])
        (values, at), (other, place) = heads[0], heads[1]
        limit = other[place]
        end = gallop(values, limit, at)
        out.extend(values[at:end])
        # Equal heads: this list's is dropped, the other's stands for both.
        end += end < len(values) and values[end] == limit
        heads[0][1] = end
        if end == len(values):
            del heads[0]
    if heads:
        out.extend(heads[0][0][heads[0][1]:])
    return out


def difference(values: Sequence[int], without: Sequence[int]) -> list[int]:
    """The sorted list of those ``values`` that are not in the sorted list ``without``."""
    out: list[int] = []
    at = place = 0
    while at < len(values):
        place = gallop(without, values[at], place)
        if place == len(without):
            out.extend(values[at:])
            break
        end = gallop(values, without[place], at)
        out.extend(values[at:end])
        at = end + (end < len(values) and values[end] == without[place])
    return out


def shared(values: Sequence[int], other: Sequence[int]) -> int:
    """How many values both sorted lists have."""
    small, large = sorted((values, other), key=len)
    n = place = 0
    for x in small:
        place = gallop(large, x, place)
        if place == len(large):
            break
        n += large[place] == x
    return n


def step_sizes(lists: Sequence[Sequence[int]], marks: Sequence[Sequence[int]]) -> Iterator[tuple]:
    """For each set of filters (as bits) and each filter k outside it: the set, k, how
    many k removes after the set, how many of them carry each mark, and how many the
    set and k remove together."""
    for before in range(1 << len(lists)):
        gone = union([v for i, v in enumerate(lists) if before >> i & 1])
        for k, values in enumerate(lists):
            if not before >> k & 1:
                removed = difference(values, gone)
                yield (before, k, len(removed), *[shared(removed, m) for m in marks],
                       len(gone) + len(removed))


def sizes(postings: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """``step_sizes`` of every part, its spans added up: part, before, k, n (rows of the
    part), removed, good, toxic, gone."""
    bound_arrow(postings.sparkSession)
    flags, schema = [*filters, *MARKS], (
        "part string, n long, before int, k int, removed long, good long, toxic long, gone long")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for part, n, *lists in batch[["part", "n", *flags]].itertuples(index=False, name=None):
                lists = [v.tolist() for v in lists]
                rows += [(part, n, *x) for x in step_sizes(lists[:len(filters)], lists[len(filters):])]
            yield pd.DataFrame(rows, columns=["part", "n", "before", "k", "removed", *MARKS, "gone"])

    return postings.select("part", "n", *flags).mapInPandas(measure, schema).groupBy("part", "before", "k").agg(
        *[F.sum(c).alias(c) for c in ("n", "removed", *MARKS, "gone")])


def orders(spark: SparkSession, filters: Sequence[str] = FILTERS) -> DataFrame:
    """Every order of the filters, a row per step: filter_order, step, before, k."""
    rows = [("".join(order), step + 1, sum(1 << filters.index(f) for f in order[:step]), filters.index(order[step]))
            for order in permutations(filters) for step in range(len(filters))]
    return spark.createDataFrame(rows, "filter_order string, step int, before int, k int")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source", span: int = SPAN) -> DataFrame:
    """One row per part, order of the filters and step (see the module's text)."""
    size = materialize(sizes(posting_lists(failures(docs, labels, id_col, text_col, part_col), span=span)),
                       "step-sizes")
    m, others = len(FILTERS), (1 << len(FILTERS)) - 1
    # The orders in which a set comes before k: its own orders times those of the rest.
    weight = F.element_at(F.array(*[F.lit(factorial(s) * factorial(m - 1 - s)) for s in range(m)]),
                          F.bit_count("before") + 1)
    alone = size.groupBy("part", "k").agg(
        F.max(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.max(F.when(F.col("before") == F.lit(others) - F.call_function("shiftleft", F.lit(1), F.col("k")), F.col("removed"))
              ).alias("unique_fails"),
        F.sum(weight * F.col("removed")).alias("shapley"))
    # 600 rows, fixed by the number of filters.
    steps = F.broadcast(orders(docs.sparkSession))
    return size.join(alone, ["part", "k"]).join(steps, ["before", "k"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("gone")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


_BEFORE = " + ".join(f"CASE WHEN instr(substr(o, 1, step - 1), '{f}') > 0 THEN {1 << i} ELSE 0 END"
                     for i, f in enumerate(FILTERS))
ORACLE_SQL = {"op11_filter_audit": f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, doc_id,
        CASE WHEN len(ws) < {MIN_WORDS} THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < {MIN_DISTINCT_PERCENT} * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MAX_CAPITAL_PERCENT} * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '{SYMBOLS}') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS m FROM w),
g AS (SELECT part, m, count(*) AS n, coalesce(sum(q), 0) AS good, coalesce(sum(x), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, m),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
p AS (SELECT a.f || b.f || c1.f || d1.f || e.f AS o FROM c a, c b, c c1, c d1, c e
      WHERE len(list_distinct([a.f, b.f, c1.f, d1.f, e.f])) = 5),
s AS (SELECT o, step, substr(o, step, 1) AS own, 1 << (ascii(substr(o, step, 1)) - 65) AS k, {_BEFORE} AS before
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, o, step, own,
        sum(CASE WHEN m & (before | k) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN m & k > 0 AND m & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN m & k > 0 AND m & before > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN m = k THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN m & k > 0 AND m & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN m & k > 0 AND m & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM g, s GROUP BY part, o, step, own)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r"""}
