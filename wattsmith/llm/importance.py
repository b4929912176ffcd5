"""Operator 1: a quality classifier by importance resampling.

Two generative models over hashed n-grams: one of target text, documents labelled
good and not toxic, one of the raw text, all documents. Each has single words,
numbers and symbols in ``BUCKETS`` buckets (one of them for a word directly
repeated) and pairs of neighbours in as many further ones. A document counts an
n-gram it has c times as 1 + log2(c), lest texts that repeat one word fill the
models. Its weight is the log-ratio of the two likelihoods per single word, plus
``PAIRS`` times that per pair. Gumbel noise of its own is added, and the k largest keys are kept, which
samples k documents without replacement by their weights. k is the share of good
documents among the labelled ones, times all documents.

Counts are kept per task and added by bucket, so what moves is bounded by tasks
times buckets; the ratio table (a double per bucket) is broadcast. The raw model
counts all documents. The target model learns from a bounded sample of the
labelled rows (``TARGET_DOCS`` expected, chosen by the hash of the id). The k-th
key is found by counting keys in ever finer intervals, without a sort.

Defined cases: null and empty texts have no n-grams and weight 0. Labels with a
null id or value are not used; a document with several labels is a target only if
all are good. Null ids take part. Rows that agree in id and text have the same
key; rows tied with the k-th key are all kept. Without labels the ratio is 0 and
all documents are kept. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.joins import SmallSide, materialize

from .common import bound_arrow, read_table

BUCKETS = 1 << 18
REPEAT = 0                   # bucket of a word directly after itself
PAIRS = 0.25                 # share of the pairs' log-ratio in a weight
SMOOTHING = 2.0              # a bucket's pseudo-count, at the raw text's rate
TARGET_DOCS = 20_000
TEMPERATURE = 0.005          # scale of the noise, per n-gram like the weights
SEED = 42
BINS = 1024
_TOKEN = re.compile(r"\w+|[^\w\s]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _counted(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    h, n = np.unique(h, return_counts=True)
    with np.errstate(over="ignore"):
        return ((h * _MIX) >> np.uint64(24)).astype(np.int64) % (buckets - 1) + 1, n


def features(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and how much each counts: single words' below ``buckets``, pairs'
    from there on."""
    tokens = _TOKEN.findall((text or "").lower())
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    repeats = int((h[1:] == h[:-1]).sum())
    with np.errstate(over="ignore"):
        pairs = (h[:-1] * _MIX) ^ (h[1:] + (h[:-1] >> np.uint64(29)))
    ids, n = _counted(h, buckets)
    pair_ids, pair_n = _counted(pairs, buckets)
    ids, n = np.concatenate([ids, buckets + pair_ids]), np.concatenate([n, pair_n])
    if repeats:
        ids, n = np.append(ids, REPEAT), np.append(n, repeats)
    return ids, 1.0 + np.log2(n)


def weight(ids: np.ndarray, c: np.ndarray, ratio: np.ndarray) -> float:
    """Log-ratio per single word, and ``PAIRS`` times that per pair."""
    single, got = ids < len(ratio) // 2, ratio[ids] * c
    return float(got[single].sum() / max(1.0, c[single].sum())
                 + PAIRS * got[~single].sum() / max(1.0, c[~single].sum()))


def count_buckets(marked: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target) over rows of (text, is_target)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((2, 2 * buckets))
        for batch in batches:
            for text, target in zip(batch["text"], batch["is_target"]):
                ids, c = features(text, buckets)
                np.add.at(n[0], ids, c)
                if target:
                    np.add.at(n[1], ids, c)
        some = np.flatnonzero(n[0])
        yield pd.DataFrame({"bucket": some, "raw": n[0][some], "target": n[1][some]})

    return (marked.select("text", "is_target").mapInPandas(count, "bucket bigint, raw double, target double")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def log_ratio(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability per bucket (at most 2 * ``buckets`` rows come
    in), among single words and among pairs. A bucket rarely seen keeps a ratio near 1,
    whichever text it is from."""
    got = counts.toPandas()
    n = np.zeros((2, 2 * buckets))
    n[0, got["bucket"]], n[1, got["bucket"]] = got["target"], got["raw"]
    out = np.zeros(2 * buckets)
    for part in (slice(0, buckets), slice(buckets, None)):
        target, raw = n[:, part]
        if target.any():
            expected = raw * (target.sum() / raw.sum())
            out[part] = np.log((target + SMOOTHING) / (expected + SMOOTHING))
    return out


def weights(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_grams, log_weight, key): log-ratio (see ``weight``), and with Gumbel noise."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf("n_grams bigint, log_weight double")
    def weigh(text: pd.Series) -> pd.DataFrame:
        table = sent.value
        got = [features(t, len(table) // 2) for t in text]
        return pd.DataFrame({"n_grams": [len(ids) for ids, _ in got],
                             "log_weight": [weight(ids, c, table) for ids, c in got]})

    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    gumbel = -F.log(-F.log(uniform))
    t = docs.select(F.col(id_col).alias("doc_id"), weigh(F.col(text_col)).alias("w"), gumbel.alias("noise"))
    return t.select("doc_id", "w.*", (F.col("w.log_weight") + TEMPERATURE * F.col("noise")).alias("key"))


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest ``key``: count keys in equal intervals, go on in the one that
    holds it. Each round moves ``BINS`` counts."""
    lo, hi, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    while lo < hi:
        width = (hi - lo) / BINS
        if width == 0 or lo + width == lo:
            break
        inside = keys.filter(F.col("key").between(lo, hi))
        number = F.least(F.floor((F.col("key") - lo) / width), F.lit(BINS - 1))
        found = {r["b"]: r for r in inside.groupBy(number.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()}
        for b in sorted(found, reverse=True):
            if k <= found[b]["n"]:
                lo, hi = found[b]["lo"], found[b]["hi"]
                break
            k -= found[b]["n"]
    return lo


def labelled_share(labels: DataFrame) -> tuple[DataFrame, float]:
    """(doc_id, good), one row per labelled document, and the share that is good."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    one = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.min(good).alias("good"))
    one = materialize(one, "labelled")
    return one, one.agg(F.avg(F.col("good").cast("double"))).first()[0]


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_docs: int = TARGET_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_grams, log_weight, key, kept."""
    bound_arrow(docs.sparkSession)
    labelled, share = labelled_share(labels)
    good = labelled.filter("good")
    part = min(1.0, target_docs / max(1, good.count()))
    chosen = good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    chosen = SmallSide(chosen.select(F.col("doc_id").alias("__id"), F.lit(True).alias("is_target")), name="target")
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = t.join(chosen.side(), F.col("doc_id") == F.col("__id"), "left").withColumn(
        "is_target", F.coalesce("is_target", F.lit(False)))
    ratio = log_ratio(count_buckets(marked))
    keyed = materialize(weights(t, ratio), "weights")
    k = round((1.0 if share is None else share) * keyed.count())
    least = kth_largest(keyed, k)
    return keyed.withColumn("kept", F.lit(False) if least is None else F.col("key") >= least)


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
