"""Operator 4: SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link at ``MAX_BITS`` = 3 differing bits or fewer. Cut into
two segments of 32, one segment of a linked pair differs by at most one bit, so
the pair shares a one-wildcard variant of that segment: the segment with one bit
deleted, tagged by segment and place. Variants are joined on equality and pairs
verified over all 64 bits; components follow by rounds of joins (``graph``).

Work is done on distinct fingerprints, so copies cost nothing. A variant shared
by more than ``HOT`` distinct fingerprints is not paired: within it, the other
segment's wildcard variants (three wildcards if the segments are equal, two if
they differ) are grouped, and each member linked to the group's smallest. Any two
members of such a group are linked by definition, and each linked pair shares
one, so components stay exact at a bounded number of rows per fingerprint.

Defined cases: null and empty texts have no words and fingerprint zero, linked
like any other. Repeated rows and ids share their text's component. Null ids take
part; a component's id is its smallest non-null id (null if there is none).
Further columns are ignored; ``keep_one`` keeps them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.joins import materialize, materialize_counted

from .common import bound_arrow, read_table
from .graph import components

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
SEGMENTS, WIDTH = 2, 32
HOT = 4096
CHUNK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a text's word shingles."""
    # bytes.lower() maps A-Z only and bytes.split() cuts at ASCII white space.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), CHUNK):
        part = h[i:i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, size: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("bigint")
    def simhash(t: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, size) for x in t], dtype="int64")
    return simhash(text)


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint's one-wildcard segment variants. The key packs the
    segment's place and the wildcard's (6 bits) above the 32 bits with that bit 0.

    The fingerprints are dealt out first: their table is one of small rows in few files,
    and a task that read a whole file would make and count 64 rows of each."""
    keys = [_segment(F.col("fp"), i).bitwiseAND(F.lit(~(1 << p)))
            .bitwiseOR(F.lit((i * WIDTH + p) << WIDTH))
            for i in range(SEGMENTS) for p in range(WIDTH)]
    return _dealt(fps).select("fp", F.explode(F.array(*keys)).alias("key"))


def _dealt(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "fp")


def _close(x: Column, y: Column, max_bits: int) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= max_bits


def _once(key: Column, x: Column, y: Column) -> Column:
    """True for one of the keys a pair shares: the first segment that differs by at
    most a bit, its wildcard at that bit (at 0 if the segments are equal)."""
    diff = x.bitwiseXOR(y)
    tag = F.shiftright(key, WIDTH)
    first = F.bit_count(_segment(diff, 0)) <= 1
    own = F.when(first, _segment(diff, 0)).otherwise(_segment(diff, 1))
    place = F.when(own == 0, F.lit(0)).otherwise(F.bit_count(own - 1))
    return tag == place + F.when(first, 0).otherwise(WIDTH)


def _hot_links(members: DataFrame) -> DataFrame:
    """Star links among the fingerprints of hot variants (columns key, fp)."""
    tag = F.shiftright("key", WIDTH)
    seg = F.floor(tag / WIDTH).cast("int")
    other = F.when(seg == 0, _segment(F.col("fp"), 1)).otherwise(_segment(F.col("fp"), 0))
    own = F.when(seg == 0, _segment(F.col("fp"), 0)).otherwise(_segment(F.col("fp"), 1))
    m = members.select("fp", "key", seg.alias("seg"), other.alias("other"), own.alias("own"))

    def masks(k):
        return F.array(*[F.lit(sum(1 << b for b in c)) for c in combinations(range(WIDTH), k)])

    def hubs(rows, head, k):
        cut = _dealt(rows).select("fp", *head, F.explode(masks(k)).alias("mask"), "other")
        group = [*head, "mask", F.col("other").bitwiseAND(F.bitwise_not("mask")).alias("rest")]
        keyed = cut.select("fp", F.xxhash64(*group).alias("g1"),
                           F.xxhash64(F.lit(1), *group).alias("g2"))
        least = keyed.groupBy("g1", "g2").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")
                                              ).filter("n > 1")
        # Spark's size estimate ignores the explode: never let it take a side for small.
        return keyed.hint("merge").join(least.hint("merge"), ["g1", "g2"]).select(F.col("fp").alias("a"), "b").filter("a <> b")

    same = m.select("fp", "seg", "own", "other").distinct()
    return hubs(same, ["seg", "own"], MAX_BITS).union(hubs(m, ["key"], MAX_BITS - 1)).distinct()


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): linked distinct fingerprints; every link outside hot variants, and
    links that join the same components within them."""
    keyed = variants(fps)
    crowded, n = materialize_counted(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("key"),
        "hot-variants")
    plain = keyed.join(crowded, "key", "left_anti") if n else keyed
    # Spark's size estimate ignores the explode, and would broadcast 64 times what it thinks.
    x, y = plain.alias("x").hint("merge"), plain.alias("y").hint("merge")
    a, b = F.col("x.fp"), F.col("y.fp")
    # In a hot variant a pair may have its only shared key, so "once" cannot be asked for then.
    once = _once(F.col("x.key"), a, b) if not n else F.lit(True)
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (a < b) & _close(a, b, MAX_BITS) & once
                   ).select(a.alias("a"), b.alias("b"))
    if n:
        pairs = pairs.union(_hot_links(keyed.join(crowded, "key", "left_semi")))
    return pairs


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           size: int = SHINGLE_WORDS, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id, root (a fingerprint that
    names the component)."""
    bound_arrow(docs.sparkSession)
    own = materialize(docs.select(F.col(id_col).alias("doc_id"),
                                  fingerprint_column(F.col(text_col), size).alias("fp")), "fingerprints")
    classes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes.select("fp"), hot))
    rooted = materialize(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = materialize(rooted.join(named, "root").select("fp", "root", "component_id"), "components")
    return own.join(classes, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             size: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each component the
    row with its smallest id (and of that id's rows the smallest fingerprint)."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    stay = groups(docs, id_col, text_col, size).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("s")
    ).select(F.col("s.doc_id").alias("__id"), F.col("s.fp").alias("__stay_fp"))
    marked = docs.withColumn("__fp", fingerprint_column(F.col(text_col), size))
    kept = marked.join(stay, marked[id_col].eqNullSafe(F.col("__id"))
                       & (F.col("__fp") == F.col("__stay_fp")))
    return kept.dropDuplicates([id_col, "__fp"]).select(*cols)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = groups(read_table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
