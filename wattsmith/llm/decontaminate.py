"""Operator 2: benchmark decontamination, with built-in functions only.

Finds test items inside documents of any length: an item leaks into a document
that holds ``CONTAINMENT`` = 0.8 or more of its distinct five-word shingles.

A fixed-size MinHash signature cannot see a short item in a long document, whose
Jaccard similarity is near zero. So the sketch sits on the item's side, sized by
the item: items are partitioned by shingle count (powers of two), and each keeps
its k smallest shingle hashes, k growing with its partition's upper bound u:
k = floor(0.2 u) + 1. A document that holds 0.8 of n <= u shingles misses at most
floor(0.2 n) of them, so at least k - floor(0.2 n) >= 1 of the k minima are in it,
however long it is: the candidate search loses nothing. Candidates are verified by
exact containment.

Documents' shingles are probed against the sketches where they are (a broadcast
join while the counted sketches fit the budget, else a shuffle join), so texts
are not shuffled; only candidates are looked at again.

Words are maximal runs of letters and digits, lower-cased. An item under five words
is one shingle, its whole sequence, and leaks into the documents that hold it; only the
lengths that items have are probed. Defined cases: a null text or one without words
leaks nowhere and holds nothing. Repeated items are reported under each id (null
included), from a join after verification, so their ids are never gathered; rows that agree in id and text are one document. Further columns
are ignored; ``drop_leaks`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.joins import SmallSide, materialize, maybe_broadcast

from .common import let, read_table

SHINGLE_WORDS, CONTAINMENT = 5, 0.8
_WORDS = r"[\p{L}\p{N}]+"


def _hashed_words(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORDS), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(h: Column, size: int) -> Column:
    return F.when(F.size(h) >= size, F.transform(
        F.sequence(F.lit(0), F.size(h) - size),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def shingles(text: Column, sizes: list[int] = (SHINGLE_WORDS,)) -> Column:
    """Distinct 64-bit hashes of a text's word sequences of these lengths."""
    return let(_hashed_words(text), lambda h: F.array_distinct(F.concat(*[_windows(h, k) for k in sizes])))


def item_shingles(text: Column) -> Column:
    """Distinct hashes of an item's shingles; of its whole sequence if it is shorter."""
    return let(_hashed_words(text), lambda h: F.array_distinct(F.coalesce(
        *[F.when(F.size(h) == k, _windows(h, k)) for k in range(1, SHINGLE_WORDS)], _windows(h, SHINGLE_WORDS))))


def _may_miss(n: Column, containment: float) -> Column:
    """Most shingles of ``n`` a document may lack and still reach the containment."""
    return (n - F.ceil(n * F.lit(containment) - 1e-9)).cast("int")


def item_sketches(items: DataFrame, text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """(ih, sh, words, n, need, sketch), one row per distinct item text with a word.
    ``words``: the length of its shingles."""
    i = items.select(F.col(text_col).alias("text")).filter("text IS NOT NULL").distinct()
    i = i.select(F.xxhash64("text").alias("ih"), F.sort_array(item_shingles(F.col("text"))).alias("sh"),
                 F.least(F.lit(SHINGLE_WORDS), F.size(_hashed_words(F.col("text")))).alias("words"))
    i = i.filter(F.size("sh") > 0).withColumn("n", F.size("sh"))
    upper = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("int") - 1
    k = F.least(F.col("n"), _may_miss(upper, containment) + 1)
    return i.withColumn("sketch", F.slice("sh", F.lit(1), k)).withColumn(
        "need", F.greatest(F.lit(1), k - _may_miss(F.col("n"), containment)))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, th, item_id, n_shingles, n_found, containment): one row per document
    (id and text hash) and item that leaks into it."""
    ids = items.select(F.xxhash64(item_text).alias("ih"), F.col(item_id).alias("item_id")).filter(
        F.col(item_text).isNotNull())
    items = materialize(item_sketches(items, item_text, containment), "items")
    sizes = sorted(r[0] for r in items.select("words").distinct().collect()) or [SHINGLE_WORDS]  # five at most
    sketches = SmallSide(items.select("ih", "need", F.explode("sketch").alias("s")), name="sketches")
    text = F.col("text")
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                    F.xxhash64(text_col).alias("th")).filter("text IS NOT NULL")

    probes = t.select("doc_id", "th", F.explode(shingles(text, sizes)).alias("s"))
    hits = probes.join(sketches.side(), "s")
    pairs = (hits.groupBy("doc_id", "th", "ih", "need").agg(F.count_distinct("s").alias("hits"))
             .filter("hits >= need").select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "ih"))
    pairs = SmallSide(pairs, name="candidates")

    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))
    held = (t.join(maybe_broadcast(pairs.df.select("d", "h").distinct(), pairs.broadcast), same, "left_semi")
            .select("doc_id", "th", shingles(text, sizes).alias("own")).dropDuplicates(["doc_id", "th"]))
    full = items.select("ih", "sh", "n")
    width = full.agg(F.sum(8 * F.col("n") + 80)).first()[0] or 0
    full = maybe_broadcast(full, width <= pairs.budget_bytes)
    verified = (held.join(pairs.side(), same).drop("d", "h").join(full, "ih")
                .withColumn("found", F.size(F.array_intersect("sh", "own")))
                .filter(F.col("found") >= F.col("n") - _may_miss(F.col("n"), containment)))
    found = SmallSide(verified.select("doc_id", "th", "ih", "n", "found"), name="leaks")
    return ids.join(found.side(), "ih").select(
        "doc_id", "th", "item_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.col("found").cast("bigint").alias("n_found"), (F.col("found") / F.col("n")).alias("containment"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, into which no item leaks."""
    bad = leaks(docs, items, id_col, text_col).select(F.col("doc_id").alias("__d"), F.col("th").alias("__h")).distinct()
    bad = SmallSide(bad, name="leaks").side()
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("__d")) & (F.xxhash64(docs[text_col]) == F.col("__h")),
                     "left_anti")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("th")


ORACLE_SQL = {"op2_decontaminate": """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
dw AS (SELECT row_number() OVER () AS k, doc_id,
              regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM d),
iw AS (SELECT row_number() OVER () AS ik, item_id,
              regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL),
lens AS (SELECT DISTINCT least(len(w), 5) AS m FROM iw WHERE len(w) > 0),
ds AS (SELECT DISTINCT k, doc_id, unnest(list_transform(range(1, greatest(len(w) - m + 2, 1)),
              lambda i: array_to_string(w[i:i + m - 1], ' '))) AS s FROM dw, lens),
sh AS (SELECT DISTINCT ik, item_id, unnest(list_transform(range(1, greatest(len(w) - least(len(w), 5) + 2, 1)),
              lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s FROM iw WHERE len(w) > 0),
n AS (SELECT ik, count(*) AS n FROM sh GROUP BY ik),
f AS (SELECT ds.k, ds.doc_id, sh.ik, sh.item_id, count(*) AS found
      FROM ds JOIN sh ON ds.s = sh.s GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, found AS n_found, found / n AS containment
FROM f JOIN n USING (ik) WHERE found >= 0.8 * n
"""}
