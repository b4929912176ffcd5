"""Operator 10: sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard by its
hash; then, round by round, the documents a group has in a shard wish to move to the
shard that holds most of the group. What may move from shard to shard is decided on
the small matrix of these wishes (``quotas``): equal counts change places, in rings of two
or more shards, and what is left goes where there is room. So groups come together
even when every document is linked and every shard full. Rounds go on until almost nothing
moves (``SETTLED``) or nothing is gained.

Groups still in several shards are then taken out and dealt to the free places as
wholes, before the documents without links, which have nothing to cut and fill the
shards to their exact capacity. At most ``shards`` - 1 groups lie on the edge between
two shards' places; they go where most room is left. Groups larger than a shard, fewer than
there are shards, cannot be whole: they get as few shards as can be before the others
start. So at most twice as many groups as there are shards can end cut. Law ``rows``:
counts differ by at most one.

The state is a count per (group, shard), at most ``shards`` rows per group, so a
group with a third of all documents is as small as any. Moves are granted by
running totals of counts against quotas (``common.running_total``), which never
let one task see a whole shard. Texts are read once and never shuffled.

Defined cases: a null text counts as empty (size 1, checksum 0). Null ids and
repeated rows are placed like any other row; rows that agree in id and text are
interchangeable. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.joins import materialize, materialize_counted

from .common import read_table, running_total

SHARDS = 16
SETTLED = 0.001  # of the linked documents: a round that moves no more is the last
G = ["g1", "g2"]  # 128 bits of hash name a text


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    t = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(t) + 1).cast("bigint").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"),
                       F.xxhash64(t).alias("g1"), F.xxhash64(F.lit("second"), t).alias("g2"))


def _loads(state: DataFrame, shards: int) -> list[int]:
    """Documents per shard: ``shards`` numbers."""
    got = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [int(got.get(s, 0)) for s in range(shards)]


def _numbers(values: list[int]):
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def quotas(demand: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many documents may move from shard to shard (``demand``: how many wish to),
    so that no shard takes in more than it gives away and has room for.

    First rings: along a ring of wishes equal counts change places, whatever the
    room. What is left has no ring, so moving into free room, which frees room in
    turn, comes to an end.
    """
    left = {e: n for e, n in demand.items() if n > 0 and e[0] != e[1]}
    out: dict[tuple[int, int], int] = dict.fromkeys(left, 0)

    def grant(a: int, b: int, n: int) -> None:
        out[a, b] += n
        left[a, b] -= n

    for a, b in list(left):  # two shards change places
        both = min(left[a, b], left.get((b, a), 0))
        if both:
            grant(a, b, both)
            grant(b, a, both)
    after: dict[int, list[int]] = {}
    for (a, b), n in left.items():
        if n:
            after.setdefault(a, []).append(b)
    for start in list(after):
        path = [start]
        while path:
            here = path[-1]
            ways = after.get(here, [])
            while ways and not left[here, ways[-1]]:
                ways.pop()
            if not ways:  # no ring leads through here any more
                path.pop()
                if path:
                    after[path[-1]].remove(here)
                continue
            to = ways[-1]
            if to not in path:
                path.append(to)
                continue
            ring = path[path.index(to):]
            edges = list(zip(ring, [*ring[1:], to]))
            n = min(left[e] for e in edges)
            for a, b in edges:
                grant(a, b, n)
            path = path[:path.index(to) + 1]
    room, moved = list(room), True
    while moved:
        moved = False
        for (a, b), n in sorted(left.items(), key=lambda e: (-e[1], e[0])):
            n = min(n, room[b])
            if n > 0:
                grant(a, b, n)
                room[a], room[b], moved = room[a] + n, room[b] - n, True
    return out


def propagate(state: DataFrame, capacity: list[int], rows: int) -> tuple[DataFrame, int, float]:
    """One round over ``state`` (g1, g2, shard, n): the new state, how many moved, and the
    sum of the squared counts, which grows as groups come together."""
    shards = len(capacity)
    free = [c - n for c, n in zip(capacity, _loads(state, shards))]
    rank = F.struct(F.col("n"), F.xxhash64(*G, "shard").alias("tie"), F.col("shard"))
    groups = state.groupBy(*G).agg(F.collect_list(rank).alias("parts"))  # at most one per shard
    most = F.array_max("parts")

    def target(own):
        return F.when(own < most, most["shard"])
    wish = groups.select(*G, F.explode(F.transform("parts", lambda p: F.struct(
        p["shard"].alias("shard"), p["n"].alias("n"), target(p).alias("to")))).alias("w")).select(*G, "w.*")
    wish = materialize(wish, "wishes")
    wanted = wish.filter("to IS NOT NULL")
    may = quotas({(r["shard"], r["to"]): int(r["n"])
                  for r in wanted.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}, free)
    quota = F.get(_numbers([may.get((a, b), 0) for a in range(shards) for b in range(shards)]),
                  F.col("shard") * shards + F.col("to"))
    granted = running_total(wanted, ["shard", "to"], G, F.col("n"), rows, "before")
    granted = granted.withColumn("go", F.greatest(F.lit(0), F.least("n", quota - F.col("before"))))
    parts = granted.select(*G, F.explode(F.array(
        F.struct(F.col("shard").alias("shard"), (F.col("n") - F.col("go")).alias("n"), F.lit(0).alias("moved")),
        F.struct(F.col("to").alias("shard"), F.col("go").alias("n"), F.col("go").alias("moved")))).alias("p"))
    both = parts.select(*G, "p.*").union(wish.filter("to IS NULL").select(*G, "shard", "n", F.lit(0)))
    new = materialize(both.groupBy(*G, "shard").agg(F.sum("n").alias("n"), F.sum("moved").alias("moved"))
                      .filter("n > 0"), "placed")
    seen = new.agg(F.sum("moved").alias("moved"), F.sum(F.col("n").cast("double") * F.col("n")).alias("together")).first()
    return new.drop("moved"), int(seen["moved"] or 0), seen["together"] or 0.0


def _deal(pool: DataFrame, room: list[int], rows: int) -> DataFrame:
    """Deal the parts of ``pool`` (g1, g2, n) to the shards' rooms, which hold at least the
    pool: (g1, g2, cuts), a cut being a shard and a count. A part's place in the running
    total decides, so at most one part fewer than there are shards has several cuts."""
    edges = [sum(room[:i]) for i in range(len(room) + 1)]
    shard_edges = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(a).cast("bigint").alias("lo"),
                                     F.lit(b).cast("bigint").alias("hi"))
                            for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    at = running_total(pool.withColumn("all", F.lit(0)), ["all"], G, F.col("n"), rows, "lo")
    cut = F.transform(shard_edges, lambda e: F.struct(
        e["shard"].alias("shard"),
        (F.least(e["hi"], F.col("lo") + F.col("n")) - F.greatest(e["lo"], F.col("lo"))).alias("n")))
    return materialize(at.select(*G, "n", F.filter(cut, lambda c: c["n"] > 0).alias("cuts")), "dealt")


def on_edges(parts: list[tuple], room: list[int]) -> list[tuple]:
    """Places for the parts (g1, g2, n) that lie on edges: each in the shard with most
    room, in several only if none has room for all of it. (g1, g2, shard, n)."""
    room, out = list(room), []
    for g1, g2, n in sorted(parts, key=lambda p: (-p[2], p[0], p[1])):
        while n:
            s = max(range(len(room)), key=lambda i: (room[i], -i))
            k = min(n, room[s])
            out.append((g1, g2, s, k))
            room[s], n = room[s] - k, n - k
    return out


def _fill(linked: DataFrame, single: DataFrame, room: list[int], rows: int) -> DataFrame:
    """(g1, g2, shard, n): places for ``linked`` parts, whole wherever they can be, and
    for ``single`` documents, which take what is left. The rooms sum to both."""
    dealt = _deal(linked, room, rows)
    whole = dealt.filter(F.size("cuts") == 1).select(*G, F.col("cuts")[0]["shard"].alias("shard"), "n")
    used = _loads(whole, len(room))
    edge = [(r["g1"], r["g2"], int(r["n"])) for r in dealt.filter(F.size("cuts") > 1).collect()]  # < shards rows
    placed = on_edges(edge, [a - b for a, b in zip(room, used)])
    for _, _, s, n in placed:
        used[s] += n
    rest = _deal(single, [a - b for a, b in zip(room, used)], rows)
    out = whole.union(rest.select(*G, F.col("cuts")[0]["shard"].alias("shard"), "n"))
    if placed:
        out = out.union(linked.sparkSession.createDataFrame(placed, "g1 bigint, g2 bigint, shard int, n bigint"))
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    rows, total = materialize_counted(described(docs, id_col, text_col), "described")
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    # Counts first: what follows sees a group as at most one row per shard.
    groups = materialize(rows.groupBy(*G).agg(F.count(F.lit(1)).alias("size_of_group")), "groups")
    # Fewer groups than shards are larger than a shard. They get as few shards as can be.
    large = F.col("size_of_group") > max(1, min(capacity))
    big = on_edges([(r["g1"], r["g2"], int(r["size_of_group"])) for r in groups.filter(large).collect()], capacity)
    for _, _, s, n in big:
        capacity[s] -= n
    groups = groups.filter(~large)
    # The others start by hash, in proportion to what is left.
    ends = _numbers([sum(capacity[:s + 1]) for s in range(shards)])
    at = F.pmod(F.xxhash64("doc_id", *G), F.lit(max(1, sum(capacity))))
    first = F.size(F.filter(ends, lambda e: e <= at)).cast("int").alias("shard")
    start = rows.groupBy(*G, first).agg(F.count(F.lit(1)).alias("n"))
    state = materialize(start.join(groups.filter("size_of_group > 1").select(*G), G, "left_semi"), "placed")
    linked = sum(_loads(state, shards))
    moved, together, gained = linked, 0.0, True
    while gained and moved > SETTLED * linked:
        state, moved, now = propagate(state, capacity, total)
        gained, together = now > together, now
    # Groups in several shards, and those that lie beyond a shard's capacity, are dealt again.
    cap = _numbers(capacity)
    stays = running_total(state, ["shard"], G, F.col("n"), total, "before").withColumn(
        "keep", F.greatest(F.lit(0), F.least("n", F.get(cap, F.col("shard")) - F.col("before"))))
    own = materialize(stays.groupBy(*G).agg(F.sum("n").alias("n"), F.max("keep").alias("most"),
                                            F.max_by("shard", "keep").alias("shard")), "kept")
    kept = own.filter("most = n").select(*G, "shard", "n")
    pool = own.filter("most < n").select(*G, "n")
    single = groups.filter("size_of_group = 1").select(*G, F.lit(1).cast("bigint").alias("n"))
    room = [c - n for c, n in zip(capacity, _loads(kept, shards))]
    placed = kept.union(_fill(pool, single, room, total)) if total else kept
    if big:
        placed = placed.union(spark.createDataFrame(big, "g1 bigint, g2 bigint, shard int, n bigint"))
    placed = materialize(placed.groupBy(*G, "shard").agg(F.sum("n").alias("n")), "placed")

    # Whole groups take their shard as it is; rows of split groups are numbered and cut.
    parts = placed.groupBy(*G).agg(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("parts"))
    parts = materialize(parts, "parts")
    whole = rows.join(parts.filter("size(parts) = 1"), G).select(
        "doc_id", "size", "text_crc32", *G, F.col("parts")[0]["shard"].alias("shard"))
    split = rows.join(parts.filter("size(parts) > 1"), G)
    numbered = running_total(split, G, ["doc_id"], F.lit(1), total, "rank")
    first_over = F.aggregate(
        "parts", F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(-1).alias("shard")),
        lambda a, p: F.when(F.col("rank") < a["end"], a).otherwise(
            F.struct((a["end"] + p["n"]).alias("end"), p["shard"].alias("shard"))))
    split = numbered.select("doc_id", "size", "text_crc32", *G, first_over["shard"].alias("shard"))
    sharded = materialize(whole.union(split), "sharded")
    return running_total(sharded, ["shard"], ["doc_id", *G], F.lit(1), total, "slot").drop(*G)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shard_documents(read_table(spark, sf_dir, "documents"))
    return s.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))
