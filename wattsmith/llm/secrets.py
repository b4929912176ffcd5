"""Operator 8: secrets, with built-in functions only.

Three base rules (assignments, access keys, long hexadecimal runs) and two
character Markov models: one of random strings, one of ordinary identifiers.
Long tokens outside the base spans are compared by log-likelihood ratio of the
two; those that exceed the prior odds are added as kind ``random``.

The models are bigram tables over ASCII (at most 128 x 128 counts per class, so
the driver holds a bounded table) trained from labelled samples (``token``,
``is_secret``). The ratio table goes into the plan as a folded literal array;
scoring is row-wise, without Python and without a join.

Defined cases: a null or empty text has no spans. Null ids and repeated rows are
carried through row by row; further columns are ignored. Without any labelled
sample both models are uniform and nothing is added. Characters outside ASCII
end a token. Whole texts are searched, in linear time (see ``spans``).
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .spans import count_kind, digest, find, without_overlap

ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"                 # 20 characters and more; shorter runs fail anyway
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![\p{L}\p{N}])"
ORDINARY = r"(?<![\p{L}\p{N}_-])[A-Za-z_][A-Za-z_-]{7,}+(?![\p{L}\p{N}])"

BASE_KINDS = ("assign", "access", "hex")
SYMBOLS = 68            # letters, digits and + / _ = -, plus one for the rest
SMOOTHING = 0.5         # added to each bigram count
PRIOR_ODDS = 1e-3       # secrets among long tokens
SAMPLE_DOCS = 20_000    # documents (expected) the models learn from


def base_spans(text: Column) -> Column:
    """Base spans by start, then kind as listed."""
    found = F.concat(
        F.filter(find(text, "assign", ASSIGN),
                 lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6),
        find(text, "access", ACCESS, F.contains(text, F.lit("AKIA"))),
        find(text, "hex", HEX))
    return in_order(found)


def in_order(spans: Column) -> Column:
    rank = {k: i for i, k in enumerate((*BASE_KINDS, "random"))}

    def keyed(s):
        order = F.lit(len(rank))
        for k, i in rank.items():
            order = F.when(s["kind"] == k, i).otherwise(order)
        return F.struct(s["start"].alias("start"), order.alias("rank"), s["end"].alias("end"),
                        s["kind"].alias("kind"), s["value"].alias("value"))
    return F.array_sort(F.transform(spans, keyed))


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(token, is_secret) from about ``sample_docs`` documents, chosen by the hash of
    their id: values the base rules found, and long words outside of them."""
    # A share of the hash range: no sort, no collected ids; count() reads file footers.
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    t = chosen.select(F.coalesce("text", F.lit("")).alias("text"))
    t = t.select("text", base_spans(F.col("text")).alias("base"))
    value = lambda s: F.when(s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGN, 2)
                             ).otherwise(s["value"])
    secret = t.select(F.explode(F.transform("base", value)).alias("token")).withColumn(
        "is_secret", F.lit(True))
    words = t.select(F.explode(F.regexp_extract_all(
        "text", F.lit(ORDINARY), F.lit(0))).alias("token")).withColumn("is_secret", F.lit(False))
    return secret.union(words.filter(~F.col("token").rlike(f"(?:{ACCESS})|(?:{HEX})")))


def train(samples: DataFrame) -> np.ndarray:
    """Log-likelihood ratio (random against ordinary) of each ASCII bigram, 128 x 128."""
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1),
                                 lambda i: F.substring("token", i, F.lit(2))))
    counts = (samples.filter((F.length("token") >= 2) & ~F.col("token").rlike("[^\\x00-\\x7F]"))
              .select("is_secret", pair.alias("pair"))
              .groupBy("is_secret", "pair").agg(F.count(F.lit(1)).alias("n")).collect())
    n = np.zeros((2, 128, 128))
    for r in counts:
        n[int(r["is_secret"]), ord(r["pair"][0]), ord(r["pair"][1])] += r["n"]
    p = (n + SMOOTHING) / (n.sum(axis=2, keepdims=True) + SMOOTHING * SYMBOLS)
    return np.log(p[1]) - np.log(p[0])


def ratio_of(token: Column, model: np.ndarray) -> Column:
    """Summed log-likelihood ratio of a token's bigrams."""
    table = F.from_json(F.lit(json.dumps([round(float(x), 4) for x in model.ravel()])), "array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c))
    pairs = F.zip_with(F.slice(codes, F.lit(1), F.length(token) - 1),
                       F.slice(codes, F.lit(2), F.length(token) - 1), lambda a, b: a * 128 + b)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + F.get(table, i))


def secret_spans(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``base`` and ``spans`` (base and added)
    by start, arrays of structs with kind, start, end, value."""
    odds = -math.log(PRIOR_ODDS)
    text = F.col("text")
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    s = t.select("doc_id", base_spans(text).alias("base"),
                 F.filter(find(text, "random", CANDIDATE),
                          lambda c: ratio_of(c["value"], model) > odds).alias("added"))
    return s.select("doc_id", "base", in_order(F.concat(
        F.transform("base", lambda x: F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "value")])),
        F.transform(without_overlap(F.col("added"), F.col("base")),
                    lambda x: F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "value")]))
    )).alias("spans"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    s = secret_spans(docs, train(labelled_samples(docs)))
    base, spans = F.col("base"), F.col("spans")
    return s.select("doc_id", *[count_kind(base, k).alias(f"n_{k}") for k in BASE_KINDS],
                    F.sha2(digest(base), 256).alias("base_sha256"), digest(spans).alias("spans"),
                    count_kind(spans, "random").alias("n_random"))
