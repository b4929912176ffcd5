"""The text pipeline: five stages over ``documents``, each on all its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame. The driver of a run writes each stage's result as Parquet and gives
the reread table to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.llm import decontaminate, line_dedup, quality_rules, sentencepiece, simhash
from wattsmith.llm.common import read_table
from wattsmith.operators.joins import materialize


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules reject go."""
    return quality_rules.apply_rules(docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, equal or within one edit, go; ``n_chars`` follows the text."""
    kept = line_dedup.dedup(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays."""
    return simhash.keep_one(docs)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every kept text, and whether they decode to it."""
    return sentencepiece.encoded(docs)


STAGES = [("quality_rules", rules_stage), ("line_dedup", lines_stage), ("simhash", copies_stage),
          ("decontaminate", leaks_stage), ("sentencepiece", tokens_stage)]

# The SimHash needs a seeded 64-bit hash that SQL lacks; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
