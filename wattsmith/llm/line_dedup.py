"""Operator 5: line dedup by a deletion-neighbourhood join.

A line goes if an equal line, or one within a single edit (a character inserted,
deleted or replaced), stands earlier: order is document id, then place. Lines
under ``MIN_CHARS`` characters are compared for equality only.

Each distinct line emits a hashed key for every variant with one character
deleted. Two lines of equal length differ in one place exactly if they agree in
the variant that lacks it; a line is another with a character inserted exactly if
the longer one's variant equals the shorter one. So within a key all lines agree
and it is enough to link each to the key's earliest: rows stay linear in the
text, whatever a key's size. Every link is then verified by edit distance.

A line within one edit of another shares its first or second half with it, cut by
the shorter one's length. So only distinct lines that share a half's hash with a
different line emit variants, which loses nothing.

Lines are named by 128 bits of hash, so texts move once, to rebuild documents.

Defined cases: a null text stays null and has no lines. Blank lines (no word) are
kept and take no part. Null ids come after all others. Rows that agree in id and
text are one document: they keep the same lines. Further columns are ignored;
``dedup`` keeps them. Very long lines are hashed in linear time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.joins import SmallSide, materialize

from .common import WORD_JAVA, bound_arrow, let, read_table

MIN_CHARS = 20
LINE = ["h1", "h2"]
_BASE = 0x9E3779B97F4A7C15                    # odd, so it has an inverse modulo 2^64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def variant_hashes(line: str) -> tuple[np.ndarray, int]:
    """Hashes of the line without its i-th character, for each i, and of the whole
    line: polynomials modulo 2^64 over mixed character codes, plus the length."""
    c = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        c = (c + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        c ^= c >> np.uint64(32)
        power = np.full(len(c), np.uint64(_BASE))
        power[:1] = 1
        terms = c * np.cumprod(power, dtype=np.uint64)
        through = np.cumsum(terms, dtype=np.uint64)          # first i + 1 terms
        total = through[-1] if len(c) else np.uint64(0)
        cut = (through - terms) + (total - through) * _INVERSE
        size = np.uint64(0xA24BAED4963EE407)
        cut = cut + np.uint64(max(0, len(c) - 1)) * size
        whole = int((np.array([total]) + np.uint64(len(c)) * size).view(np.int64)[0])
    return cut.view(np.int64), whole


def _variants(line: Column) -> Column:
    @F.pandas_udf("cuts array<bigint>, whole bigint")
    def hashes(lines: pd.Series) -> pd.DataFrame:
        got = [variant_hashes(x) for x in lines]
        return pd.DataFrame({"cuts": [g[0] for g in got], "whole": [g[1] for g in got]})
    return hashes(line)


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _half_keys(line: Column) -> Column:
    """Keys of which two lines within one edit share one: both halves, cut by the
    line's own length and by one less."""
    n = F.length(line)

    def halves(m):
        h = F.floor(m / 2).cast("int")
        return [F.xxhash64(F.lit(0), m, F.left(line, h)), F.xxhash64(F.lit(1), m, F.right(line, m - h))]
    return F.when(n >= MIN_CHARS, F.array(*halves(n), *halves(n - 1)))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, pos, line, h1, h2): lines with a word. th names the text."""
    # The hash has a step of its own: beside the explode it would be taken once per line.
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"),
                        F.col(text_col).alias("text"))
    t = named.select("doc_id", "th", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    return t.filter(F.col("line").rlike(WORD_JAVA)).select(
        "*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), F.col("line")).alias("h2"))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "pos")


def near_lines(occ: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2): the distinct lines that an earlier one is within one edit of."""
    keys = lines.select("h1", F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).filter("x <> y")
    shared = SmallSide(shared.select("key"), name="shared-halves")
    maybe = lines.select(*LINE, F.explode("halves").alias("key")).join(shared.side(), "key", "left_semi")
    maybe = SmallSide(maybe.select(*LINE).distinct(), name="near-candidates")
    texts = occ.join(maybe.side(), LINE, "left_semi").groupBy(*LINE).agg(
        F.min(_place()).alias("place"), F.first("line").alias("line"))
    # A sorted write numbered in order: ``ord`` compares as the places do.
    texts = materialize(texts.orderBy("place").select(
        F.monotonically_increasing_id().alias("ord"), *LINE, "line"), "near-texts")
    hashed = materialize(texts.select("ord", _variants(F.col("line")).alias("v")), "variants")
    cuts = hashed.select("ord", F.posexplode("v.cuts").alias("pos", "cut"))
    whole = hashed.select("ord", F.col("v.whole").alias("cut"))

    replaced = cuts.groupBy("cut", "pos").agg(F.min("ord").alias("by"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    inserted = whole.select(F.col("ord").alias("short"), "cut")
    longer = cuts.join(inserted, "cut").select("ord", "short").distinct()
    found = (cuts.join(replaced, ["cut", "pos"]).filter("by < ord").select("ord", "by")
             .union(longer.filter("short < ord").select("ord", F.col("short").alias("by")))
             .union(longer.filter("ord < short").groupBy("short").agg(F.min("ord").alias("by")))
             .distinct())
    a = texts.select("ord", *LINE, F.col("line").alias("x"))
    b = texts.select(F.col("ord").alias("by"), F.col("line").alias("y"))
    return (found.join(a, "ord").join(b, "by").filter(F.levenshtein("x", "y", 1) == 1)
            .select(*LINE).distinct())


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, drop, n_equal, n_near): documents that lose lines, and their places."""
    bound_arrow(docs.sparkSession)
    occ = occurrences(docs, id_col, text_col)
    lines = materialize(
        occ.select(*LINE, _place().alias("place"), _half_keys(F.col("line")).alias("halves"))
        .groupBy(*LINE).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"),
                            *[F.first(F.col("halves")[i]).alias(f"k{i}") for i in range(4)])
        .withColumn("halves", F.filter(F.array(*[f"k{i}" for i in range(4)]), lambda k: k.isNotNull()))
        .drop(*[f"k{i}" for i in range(4)]), "lines")
    near = SmallSide(near_lines(occ, lines), name="near").side().withColumn("near", F.lit(True))
    lines = lines.select(*LINE, "first", "n").join(near, LINE, "left")
    losing = lines.filter("n > 1 OR near").select(*LINE, "first", F.coalesce("near", F.lit(False)).alias("near"))
    own = occ.select("doc_id", "th", "pos", *LINE)
    equal = ~_place().eqNullSafe(F.col("first"))
    lost = own.join(losing, LINE).select("doc_id", "th", "pos", equal.alias("equal"), "near").filter("equal OR near")
    return lost.distinct().groupBy("doc_id", "th").agg(
        F.collect_list("pos").alias("drop"), F.count_if("equal").alias("n_equal"),
        F.count_if(~F.col("equal")).alias("n_near"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, and n_lines, n_equal, n_near behind its columns."""
    lost = decide(docs, id_col, text_col).select(
        F.col("doc_id").alias("__d"), F.col("th").alias("__h"), F.col("drop").alias("__drop"),
        F.col("n_equal").alias("__equal"), F.col("n_near").alias("__near"))
    text = F.col(f"`{text_col}`")
    joined = docs.join(lost, docs[id_col].eqNullSafe(F.col("__d")) & (F.xxhash64(docs[text_col]) == F.col("__h")),
                       "left")
    # A set difference of places: a test of each line against all dropped ones would be quadratic.
    kept = let(split_lines(text), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop")), lambda i: F.get(lines, i)), "\n"))
    counts = [F.coalesce(F.size(F.filter(split_lines(text), lambda x: x.rlike(WORD_JAVA))), F.lit(0)).alias("n_lines"),
              F.coalesce("__equal", F.lit(0)).alias("n_equal"), F.coalesce("__near", F.lit(0)).alias("n_near")]
    return joined.select(*[F.when(F.col("__drop").isNull(), text).otherwise(kept).alias(c) if c == text_col
                           else F.col(f"`{c}`") for c in docs.columns],
                         *[c for c in counts])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", "text", "n_lines", "n_equal", "n_near")
