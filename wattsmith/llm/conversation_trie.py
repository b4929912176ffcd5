"""Operator 12: prefix trie of conversations, rolled up by centroid decomposition.

Every conversation is rebuilt from the first turns of its family's head and its own
later turns (``rebuilt``). A node of the trie is a distinct sequence of first turns. Its
name while the trie is built is a 128-bit sum over its turns of hashes of (place, role,
text), which running sums give for all prefixes at once; afterwards it is named by its
smallest member and its depth. The trie is a forest of parent edges.

Totals over subtrees come from a centroid decomposition. Each node weighs as much as it
has members, so a subtree weighs the rows of its members from there on: known without
a roll-up. In each component the centroid is the deepest node whose subtree weighs
more than half. What the centroid and all below it hold is summed and added to every
node on the path from the centroid to the component's top. The centroid is then
finished, and its children's subtrees and the rest above it are components of their own,
each of half the weight or less. Components over ``LOCAL`` are split by Spark joins, all
at once per round; a smaller one, of at most ``LOCAL`` nodes, goes through the same steps
inside a task. Rounds grow with the logarithm of the weight, not with the depth.

No conversation is gathered: turns are numbered by a range-partitioned sort, running
sums go by blocks of ``BLOCK`` turns, and the ids that end at a node are joined in runs
of at most ``SPAN`` conversations, which one task hashes as a stream.

Defined cases: turns are ordered by (turn, role, text), null turns first; repeated rows
are turns of their own. A null role or text is empty. Rows without a conv_id belong to
no conversation and are left out. A conversation may be left without turns: it is a
member of the root alone. An empty table gives no rows (a root would have no member).
Texts are read whole. Further columns, also of our names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattsmith.operators.joins import SmallSide, materialize, materialize_counted

from .common import bound_arrow, read_table, words_of

FAMILY, HEADS = 20, 4       # fixed values: a family's size, and one more than the most turns it shares
LOCAL = 4096                # weight up to which a component is decomposed in one task
BLOCK = 256                 # turns of a conversation that one window sums
SPAN = 4096                 # rows of the ordered table whose conversations share a run of ids
ROUNDS = 200                # each halves the weight of a component: never reached


def _halves(h: Column) -> list[Column]:
    """A 64-bit hash as two numbers of 32 bits, whose sums cannot overflow."""
    return [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1))]


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, at, c1, c2, words): turns numbered from 1 within their conversation,
    ``at`` the row's place in the whole order, c1 and c2 hashes of role and text."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "text", "row"]   # row: so that equal turns can lie in several tasks
    sliced = materialize(
        t.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
            "conv_id", F.xxhash64("role", "text").alias("c1"),
            F.xxhash64(F.lit("second"), "text", F.length("text"), "role").alias("c2"),
            F.size(words_of(F.col("text"))).cast("bigint").alias("words"),
            F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("i"))
        .withColumn("i", F.col("i") - F.shiftleft(F.col("slice").cast("bigint"), 33)), "turns")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)   # a row per slice
    offsets = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).select(
        "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    placed = sliced.join(F.broadcast(offsets), "slice").select(
        "conv_id", (F.col("off") + F.col("i")).alias("at"), "c1", "c2", "words")
    starts = placed.groupBy("conv_id").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    return placed.join(starts, "conv_id").withColumn("pos", F.col("at") - F.col("start") + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: their rows (conv_id, d, len, c1, c2, words), d from 1
    on, and the conversations (conv_id, start, len), also those left without turns."""
    own = materialize(numbered(turns), "numbered")
    convs = own.filter("pos = 1").select("conv_id", "start", "n")
    heads = convs.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    shared = F.least(F.col("h"), F.coalesce("head_n", F.lit(0)))
    convs = materialize(
        convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % HEADS)
        .withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(heads, "head", "left")
        .select("conv_id", "head", "start", "h", shared.alias("shared"),
                (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    later = own.join(convs.select("conv_id", "h", "shared", "len"), "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("d"), "len", "c1", "c2", "words")
    first = own.filter(F.col("pos") < HEADS).select(F.col("conv_id").alias("head"), "pos", "c1", "c2", "words")
    taken = first.join(convs.select("conv_id", "head", "shared", "len"), "head").filter("pos <= shared").select(
        "conv_id", F.col("pos").alias("d"), "len", "c1", "c2", "words")
    return materialize(later.union(taken), "rebuilt"), convs.select("conv_id", "start", "len")


def prefixes(rows: DataFrame) -> DataFrame:
    """``rows`` with the names of their prefix (k1, k2) and of the one before (p1, p2)."""
    hashes = [*_halves(F.xxhash64("d", "c1", "c2")), *_halves(F.xxhash64("c2", F.lit("second"), "d", "c1"))]
    names = ["s1", "s2", "s3", "s4"]
    cut = rows.withColumn("block", F.floor((F.col("d") - 1) / BLOCK)).withColumns(dict(zip(names, hashes)))
    totals = cut.filter(F.col("len") > BLOCK).groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in names])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "block", *[F.sum(s).over(before).alias(f"o{s}") for s in names]).filter(
        "block > 0")
    up_to = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumns({f"t{s}": F.sum(s).over(up_to) for s in names}).join(
        offsets, ["conv_id", "block"], "left")
    total = {s: F.col(f"t{s}") + F.coalesce(F.col(f"o{s}"), F.lit(0)) for s in names}

    def name(high, low):
        low32 = F.lit((1 << 32) - 1)
        return F.shiftleft(high.bitwiseAND(low32), 32).bitwiseOR(low.bitwiseAND(low32))

    last = {s: total[s] - F.col(s) for s in names}
    return summed.select("conv_id", "d", "len", "words", name(total["s1"], total["s2"]).alias("k1"),
                         name(total["s3"], total["s4"]).alias("k2"),
                         name(last["s1"], last["s2"]).alias("p1"), name(last["s3"], last["s4"]).alias("p2"))


def trie(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (m, d, k1, k2, n_convs, words, weight; m: smallest member), members (conv_id,
    d, len, k1, k2, start; the root's included), and paths (m, d, o, po): of every
    conversation that is some node's smallest member, the smallest members o of its
    nodes and po of their parents."""
    rows, convs = rebuilt(turns)
    zero = F.lit(0).cast("bigint")
    roots = convs.select("conv_id", zero.alias("d"), "len", zero.alias("words"), zero.alias("k1"), zero.alias("k2"))
    members = materialize(prefixes(rows).select(*roots.columns).union(roots), "members")
    nodes = materialize(members.groupBy("d", "k1", "k2").agg(
        F.min("conv_id").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.sum(F.col("len") - F.col("d") + 1).alias("weight")), "nodes")
    owners = nodes.groupBy(F.col("m").alias("conv_id")).agg(F.max("d").alias("deepest"))
    steps = members.join(owners, "conv_id").filter(F.col("d") <= F.col("deepest")).select(
        F.col("conv_id").alias("m"), "d", "k1", "k2")
    named = materialize(steps.join(nodes.select("d", "k1", "k2", F.col("m").alias("o")), ["d", "k1", "k2"])
                        .select("m", "d", "o"), "steps")
    above = named.select("m", (F.col("d") + 1).alias("d"), F.col("o").alias("po"))
    paths = materialize(named.join(above, ["m", "d"], "left"), "paths")
    return nodes, members.join(convs.select("conv_id", "start"), "conv_id"), paths


# --- roll-up by centroid decomposition ---------------------------------------------

def roll_up(forest: DataFrame, paths: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """(m, d, a value per name): the sum of each of ``values`` over a node's subtree.

    ``forest``: m, d, parent, weight (of the subtree) and the nodes' own values.
    ``paths``: see ``trie``.
    """
    state = forest.select("m", "d", "parent", "weight", F.col("m").alias("tm"), F.col("d").alias("td"), *values,
                          *[F.lit(0).cast("bigint").alias(f"sum_{v}") for v in values])
    # All tops are roots: their component is named by them.
    tops = forest.filter(F.col("parent").isNull()).select(F.col("m").alias("tm"), F.col("d").alias("td"))
    if (n := tops.count()) != 1 and n:
        raise ValueError(f"the trie has {n} roots")
    if n:
        m, d = tops.first()
        state = state.withColumns({"tm": F.lit(m), "td": F.lit(d)})
    sums = [f"sum_{v}" for v in values]
    done: list[DataFrame] = []
    state = materialize(state, "components")
    for _ in range(ROUNDS):
        heavy = SmallSide(state.groupBy("tm", "td").agg(F.max("weight").alias("total")).filter(
            F.col("total") > local), name="heavy")
        if heavy.rows == 0:
            break
        big, small = _parted(state, heavy)
        if small is not None:
            done.append(_finished(small, values))
        state, ended = _split(big, paths, values)
        done.append(ended.select("m", "d", *sums))
    else:
        raise RuntimeError(f"components heavier than {local} after {ROUNDS} rounds")
    out = _finished(state, values)
    for x in done:
        out = out.union(x)
    return out.withColumnsRenamed({f"sum_{v}": v for v in values})


def _parted(state: DataFrame, heavy: SmallSide) -> tuple[DataFrame, DataFrame | None]:
    """The nodes of heavy components, with their component's weight; the others."""
    big = state.join(heavy.side(), ["tm", "td"])
    return big, state.join(heavy.side(), ["tm", "td"], "left_anti")


def _split(big: DataFrame, paths: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """One round: the nodes that remain, in their new components, and the centroids."""
    comp, sums = ["tm", "td"], [f"sum_{v}" for v in values]
    big = materialize(big, "heavy-nodes")
    # More than half of the weight: one path from the top down. Its last node has the least.
    centroids = SmallSide(big.filter(2 * F.col("weight") > F.col("total")).groupBy(*comp).agg(
        F.min_by("m", "weight").alias("cm"), F.min_by("d", "weight").alias("cd"),
        F.min("weight").alias("cw")), name="centroids")
    nodes = big.join(centroids.side(), comp)
    # A node deeper than the centroid lies below it if its path goes through the centroid;
    # the next node on that path is then its new top.
    deep = nodes.filter("d > cd").withColumn("next", F.col("cd") + 1).join(
        paths.select("m", F.col("d").alias("next"), F.col("o").alias("below"), F.col("po").alias("through")),
        ["m", "next"])
    is_below = F.col("through") == F.col("cm")
    deep = deep.withColumn("under", is_below)
    shallow = nodes.filter("d <= cd").withColumns({
        "next": F.lit(None).cast("bigint"), "below": F.lit(None).cast("bigint"),
        "through": F.lit(None).cast("bigint"), "under": F.lit(False)})
    marked = materialize(deep.unionByName(shallow), "marked")
    at_centroid = (F.col("m") == F.col("cm")) & (F.col("d") == F.col("cd"))
    totals = marked.filter(F.col("under") | at_centroid).groupBy(*comp).agg(
        *[F.sum(v).alias(f"add_{v}") for v in values])
    side = SmallSide(totals.join(centroids.df, comp), name="centroid-totals")
    # From the centroid to the top: a row per node on the way.
    way = materialize(side.df.join(paths.select(F.col("m").alias("cm"), F.col("d").alias("wd"), "o"), "cm")
                      .filter((F.col("wd") >= F.col("td")) & (F.col("wd") <= F.col("cd")))
                      .select(*comp, F.col("o").alias("m"), F.col("wd").alias("d"),
                              *[f"add_{v}" for v in values], F.col("cw").alias("less")), "ways")
    moved = materialize(marked.join(way, [*comp, "m", "d"], "left").select(
        "m", "d", "parent", "under", at_centroid.alias("ends"),
        (F.col("weight") - F.coalesce("less", F.lit(0))).alias("weight"),
        F.when(F.col("under"), F.col("below")).otherwise(F.col("tm")).alias("tm"),
        F.when(F.col("under"), F.col("next")).otherwise(F.col("td")).alias("td"),
        *values, *[(F.col(f"sum_{v}") + F.coalesce(f"add_{v}", F.lit(0))).alias(f"sum_{v}") for v in values]),
        "moved")
    return (moved.filter("not ends").select("m", "d", "parent", "weight", *comp, *values, *sums),
            moved.filter("ends"))


def decompose(parent: list[int], weight: list[int], values: list[list[int]]) -> list[list[int]]:
    """The same steps for one small component. ``parent``: each node's place (-1: the
    top, which comes first and every node after its parent); ``weight``: of the subtrees;
    ``values``: lists with a number per node. Returns their sums over subtrees."""
    n = len(parent)
    children: list[list[int]] = [[] for _ in range(n)]
    for i, p in enumerate(parent):
        if p >= 0:
            children[p].append(i)
    weight, sums = list(weight), [[0] * n for _ in values]
    tops = [0] if n else []
    while tops:
        top = c = tops.pop()
        half = weight[top] / 2
        while (heavier := next((x for x in children[c] if weight[x] > half), None)) is not None:
            c = heavier
        below = [c]
        for x in below:
            below += children[x]
        for v, out in zip(values, sums):
            add = sum([v[x] for x in below])
            x = c
            while x != top:
                out[x] += add
                x = parent[x]
            out[top] += add
        x = c
        while x != top:
            x = parent[x]
            weight[x] -= weight[c]
        tops += children[c]
        children[c] = []
        if c != top:
            children[parent[c]].remove(c)
            tops.append(top)
    return sums


def _finished(state: DataFrame, values: list[str]) -> DataFrame:
    """(m, d, sum per value) of the nodes of small components, each decomposed whole
    inside a task. A batch's last component is held back until the next one begins."""
    bound_arrow(state.sparkSession)
    sums = [f"sum_{v}" for v in values]

    def rows_of(batch: list[list[int]], a: int, b: int) -> list[list[int]]:
        """The columns m, d and the sums of the component in rows a to b."""
        m, d, parent, weight, *own = [c[a:b] for c in batch]
        place = {x: i for i, x in enumerate(zip(m, d))}
        up = [-1, *[place[p, x - 1] for p, x in zip(parent[1:], d[1:])]]
        found = decompose(up, weight, own[:len(values)])
        return [m, d, *[[x + y for x, y in zip(*both)] for both in zip(own[len(values):], found)]]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            tm, td = batch["tm"].to_numpy(), batch["td"].to_numpy()
            cuts = [0, *(np.flatnonzero((tm[1:] != tm[:-1]) | (td[1:] != td[:-1])) + 1)]
            yield whole(batch, cuts)
            held = batch.iloc[cuts[-1]:]
        if held is not None and len(held):
            yield whole(held, [0, len(held)])

    def whole(batch: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
        """The components between the cuts."""
        columns = [batch[c].tolist() for c in ("m", "d", "parent", "weight", *values, *sums)]
        out: list[list[int]] = [[] for _ in range(2 + len(sums))]
        for a, b in zip(cuts, cuts[1:]):
            for column, more in zip(out, rows_of(columns, a, b)):
                column += more
        return pd.DataFrame(dict(zip(["m", "d", *sums], out)), dtype="int64")

    # A number of its own, since little data makes much work here: small partitions would be joined.
    parts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = state.repartition(parts, "tm", "td").sortWithinPartitions("tm", "td", "d", "m")
    return materialize(sorted_.mapInPandas(each, "m long, d long, " + ", ".join(f"{s} long" for s in sums)),
                       "finished")


# --- ids that end at a node -----------------------------------------------------------

def ends(members: DataFrame) -> DataFrame:
    """(d, k1, k2, ends_sha256): of each node where conversations end, the SHA-256 of
    their ids in order, comma-joined."""
    runs = members.filter("d = len").groupBy("d", "k1", "k2", F.floor(F.col("start") / SPAN).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, h = None, None
        for batch in batches:
            out = []
            for d, k1, k2, ids in batch.itertuples(index=False, name=None):
                if (d, k1, k2) == node:
                    h.update(b",")
                else:
                    if node is not None:
                        out.append((*node, h.hexdigest()))
                    node, h = (d, k1, k2), hashlib.sha256()
                h.update(ids.encode())
            yield pd.DataFrame(out, columns=["d", "k1", "k2", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, h.hexdigest())], columns=["d", "k1", "k2", "ends_sha256"])

    node = ["d", "k1", "k2"]
    sorted_ = runs.repartition(*node).sortWithinPartitions(*node, "run").select(*node, "ids")
    return sorted_.mapInPandas(digest, "d long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie (see the module's text)."""
    bound_arrow(turns.sparkSession)
    nodes, members, paths = trie(turns)
    edges = paths.select("m", "d", "o", "po").filter("m = o").select("m", "d", F.col("po").alias("parent"))
    nodes = nodes.join(edges, ["m", "d"])
    childs = nodes.filter("d > 0").groupBy(F.col("parent").alias("m"), (F.col("d") - 1).alias("d")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(childs, ["m", "d"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "n_leaves": F.col("n_children").isNull().cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "forest")
    totals = roll_up(nodes, paths, ["n_leaves", "saved_tokens"], local)
    empty = hashlib.sha256(b"").hexdigest()
    return (nodes.drop("n_leaves", "saved_tokens").join(totals, ["m", "d"])
            .join(ends(members), ["d", "k1", "k2"], "left")
            .select(F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


# Unsigned CRC-32 of a decimal number, bit by bit (polynomial and start: fixed values).
_CRC = """xor(list_reduce(list_transform(str_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda s, i:
    xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"""
# The parent is shown as DOUBLE, which is what pandas makes of Spark's long with a null.
ORACLE_SQL = {"op12_prefix_trie": f"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % {FAMILY} AS head, {_CRC} % {HEADS} AS h FROM t GROUP BY conv_id),
c AS (SELECT a.conv_id, a.head, a.h, least(a.h, coalesce(b.n, 0)) AS shared, a.n FROM n a LEFT JOIN n b ON b.conv_id = a.head),
r AS (SELECT conv_id, pos - h + shared AS d, role, text FROM t JOIN c USING (conv_id) WHERE pos > h
  UNION ALL SELECT c.conv_id, pos AS d, role, text FROM c JOIN t ON t.conv_id = c.head AND pos <= shared),
p AS (SELECT conv_id, d, text, sha256(CAST(list((role, text)) OVER (PARTITION BY conv_id ORDER BY d) AS VARCHAR)) AS k FROM r
  UNION ALL SELECT conv_id, 0, '', '' FROM c),
q AS (SELECT *, max(d) OVER (PARTITION BY conv_id) AS len, lag(k) OVER (PARTITION BY conv_id ORDER BY d) AS pk FROM p),
x AS (SELECT d, k, min(conv_id) AS m, count(*) AS n_convs, max(pk) AS pk, max(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = len), '')) AS ends_sha256
  FROM q GROUP BY d, k),
y AS (SELECT a.*, b.m AS parent, coalesce(ch.n, 0) AS n_children
  FROM x a LEFT JOIN x b ON b.d = a.d - 1 AND b.k = a.pk
  LEFT JOIN (SELECT d - 1 AS d, pk, count(*) AS n FROM x WHERE d > 0 GROUP BY ALL) ch ON ch.d = a.d AND ch.pk = a.k),
s AS (SELECT q.d, q.k, sum(CASE WHEN y.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((y.n_convs - 1) * CASE WHEN y.d = 0 THEN 0 ELSE y.words END) AS saved
  FROM y JOIN q ON q.conv_id = y.m AND q.d <= y.d GROUP BY q.d, q.k)
SELECT y.m AS conv_id, CAST(y.d AS BIGINT) AS depth, CAST(y.parent AS DOUBLE) AS parent_conv_id, y.n_convs, CAST(y.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, y.ends_sha256
FROM y JOIN s USING (d, k)"""}
