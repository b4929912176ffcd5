"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattsmith.operators.joins import materialize, materialize_counted

MAX_ROUNDS = 60


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b): root is the smallest
    node reachable. Nodes without a link to another node are not listed.

    Alternates the two star operations: link a node's larger neighbours to its
    smallest neighbour, then its smaller ones. Every step is a minimum per node
    (combined before the shuffle) and a join with it, both written to the shared
    folder, so a lost executor repeats one step and a node with very many links is
    a skewed join that Spark can split. Converges in a logarithmic number of rounds.
    """
    edges, n = materialize_counted(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    if n == 0:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    seen = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select("b", "a"))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select("a", F.least("a", "m").alias("m")), "stars")
        edges = materialize(both.filter("b > a").join(least, "a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "stars")
        edges = materialize(edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .union(least).distinct(), "links")
        now = _checksum(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError(f"no stable components after {MAX_ROUNDS} rounds")
