"""Operators 2, 4 and 5 against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from wattsmith.llm import decontaminate, line_dedup, simhash
from wattsmith.llm.graph import components

SF = "/root/testdata/sf0.001"
EXTRA = ["h1", "fp", "key", "line", "th", "s"]  # clashing names


def words(n, seed=0, size=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(size) for _ in range(n))


# --- op4 -------------------------------------------------------------------

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def near_family(seed, n):
    base = words(120, seed).split()
    r = random.Random(seed)
    out = []
    for _ in range(n):
        c = list(base)
        c[r.randrange(len(c))] = "x%d" % r.randrange(50)
        out.append(" ".join(c))
    return out


@pytest.mark.parametrize("hot", [simhash.HOT, 2])
def test_simhash_equals_brute_force(spark, make_docs, hot):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "É é"), (7, "é é")]
    rows += [(100 + i, t) for i, t in enumerate(near_family(1, 60))] + [(300 + i, words(50, 9)) for i in range(20)]
    rows += [(400, words(50, 9)), (400, words(50, 9)), (None, words(50, 9))]
    docs = make_docs(rows).unionByName(spark.read.parquet(f"{SF}/documents.parquet").withColumn(
        "doc_id", F.col("doc_id") + 1000)).withColumns({c: F.lit("extra") for c in EXTRA})
    got = simhash.groups(docs, hot=hot).collect()
    own = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in own]
    roots = plain_components(fps)
    least = {}
    for r, root in zip(own, roots):
        least[root] = min((x for x in (least.get(root), r.doc_id) if x is not None), default=None)
    key = lambda t: tuple(-1 if x is None else x for x in t)
    want = sorted(((r.doc_id, f, least[root]) for r, f, root in zip(own, fps, roots)), key=key)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == want
    assert len(set(roots)) < len(set(fps)) < len(own)


def test_simhash_spark_hash_is_the_contract_hash(spark):
    v = spark.range(1).select(F.xxhash64(F.lit("a bc é")).alias("h")).first().h
    assert v % (1 << 64) == xxhash.xxh64_intdigest("a bc é".encode(), 42)


def test_keep_one(make_docs):
    rows = [(5, words(60, 1)), (3, words(60, 1)), (3, words(60, 1)), (7, words(60, 2)), (None, words(60, 3)),
            (8, None), (9, ""), (3, words(60, 4))]
    docs = make_docs(rows).withColumns({c: F.lit("extra") for c in EXTRA})
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(3, words(60, 1)), (7, words(60, 2)), (None, words(60, 3)), (8, None), (3, words(60, 4))], key=str)
    assert simhash.keep_one(make_docs([])).count() == 0 and simhash.groups(make_docs([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    random.Random(3).shuffle(chain)
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1400)}


# --- op2 -------------------------------------------------------------------

def plain_shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def held_shingles(item, text):
    """(the item's shingles, how many of them the text holds); an item under five words is one."""
    w, x = re.findall(r"[^\W_]+", (item or "").lower()), re.findall(r"[^\W_]+", (text or "").lower())
    k = min(len(w), 5)
    own = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    return own, len(own & {tuple(x[i:i + k]) for i in range(len(x) - k + 1)})


def test_leaks_equal_brute_force(spark, make_docs):
    items = [(1, words(14, 1)), (2, words(40, 2)), (3, words(60, 3)), (4, "too short"), (5, None), (None, words(30, 5)),
             (6, words(9, 6)), (7, words(60, 3)), (8, words(5, 8)), (9, "Too, short"), (10, "word"), (11, "..."),
             (12, "one two three four")]
    cut = words(40, 2).split()
    changed = cut[:36] + ["zz"] + cut[37:]
    late = cut[:20] + ["zz"] + cut[21:]
    rows = [(1, words(3000, 11) + " " + words(14, 1) + ". " + words(3000, 12)), (2, " ".join(changed)), (3, " ".join(late)),
            (4, words(60, 3).upper().replace(" ", ",\n")), (5, None), (6, ""), (7, words(30, 5)), (None, words(14, 1)),
            (8, words(14, 1)), (8, words(14, 1)), (8, words(9, 6)), (9, words(5, 8)),
            (10, words(50, 9) + " too SHORT " + words(50, 10)), (11, "short too words"), (12, "zero one two three four five word"),
            (13, "word")]
    docs = make_docs(rows).withColumns({c: F.lit("extra") for c in EXTRA})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("sh", F.lit(1))
    want = set()
    for i, t in items:
        for d, x in rows:
            s, found = held_shingles(t, x)
            if s and found >= 0.8 * len(s):
                want.add((d, i, len(s), found))
    got = decontaminate.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got} == want
    assert len(got) == len(want) and len(want) >= 9
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    bad = {(d, x) for d, x in rows for i, t in items
           if held_shingles(t, x)[0] and held_shingles(t, x)[1] >= 0.8 * len(held_shingles(t, x)[0])}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [r for r in rows if r not in bad], key=str)


def test_leaks_without_broadcast(spark, make_docs):
    spark.conf.set("wattsmith.broadcastBudgetBytes", "1")
    try:
        items = spark.createDataFrame([(1, words(30, 1))], "item_id long, text string")
        docs = make_docs([(i, words(20, 50 + i) + " " + words(30, 1)) for i in range(30)] + [(99, words(200, 3))])
        assert decontaminate.leaks(docs, items).count() == 30
        assert decontaminate.drop_leaks(docs, items).count() == 1
    finally:
        spark.conf.unset("wattsmith.broadcastBudgetBytes")


def test_leaks_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(make_docs([(1, "a b c d e f")]), none).count() == 0
    assert decontaminate.drop_leaks(make_docs([(1, "a b c d e f")]), none).count() == 1
    assert decontaminate.leaks(make_docs([]), none).count() == 0


# --- op5 -------------------------------------------------------------------

def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_dedup(rows):
    """Kept text by (doc_id, text)."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0, th(r[1])))
    seen, out = [], {}
    for d, t in docs:
        kept = []
        for line in t.split("\n"):
            if not line.strip(" \t\r\x0b\x0c"):
                kept.append(line)
                continue
            near = any(s == line or (min(len(s), len(line)) >= 20 and within_one(s, line)) for s in seen)
            if not near:
                kept.append(line)
            seen.append(line)
        out[d, t] = "\n".join(kept)
    return out


def th(text):
    v = xxhash.xxh64_intdigest(text.encode(), 42)
    return v - (1 << 64) if v >> 63 else v


def test_line_dedup_equals_brute_force(spark, make_docs):
    r = random.Random(5)
    base = ["".join(r.choices("abé \U0001F600", k=k)) + "x" for k in (19, 20, 21, 25, 40, 40, 60)] + ["short", "shorter one"]
    base += ["a" * 30, "a" * 31, "a" * 33]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(r.randrange(1, 6)):
            line = list(r.choice(base))
            op, p = r.randrange(6), r.randrange(len(line))
            if op == 0:
                line[p] = r.choice("abz")
            elif op == 1:
                del line[p]
            elif op == 2:
                line.insert(p, r.choice("abz"))
            lines.append("".join(line))
            if r.random() < 0.2:
                lines.append(r.choice(["", "  ", "\t"]))
        rows.append((r.choice([i, i, 3, None]), "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (73, "q" * 100_000), (74, "q" * 100_001), rows[0], rows[5]]
    docs = make_docs(rows).withColumns({c: F.lit("extra") for c in EXTRA})
    got = line_dedup.dedup(docs).collect()
    want = plain_dedup(rows)
    assert sorted(((x.doc_id, x.text) for x in got), key=str) == sorted(
        ((d, want.get((d, t))) for d, t in rows), key=str)
    assert sum(x.n_near for x in got) > 5 and sum(x.n_equal for x in got) > 5
    assert got[0].__fields__[:-3] == docs.columns


def test_line_dedup_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_dedup(rows)
    got = line_dedup.dedup(docs).collect()
    assert sorted((x.doc_id, x.text) for x in got) == sorted((d, want[d, t]) for d, t in rows)


def test_line_dedup_hot_key_stays_linear(spark, make_docs):
    """Many lines within one edit of each other: links go to the earliest only."""
    stem = "the quick brown fox jumps over the lazy dog"
    rows = [(i, stem[:10] + chr(0x4E00 + i) + stem[11:]) for i in range(400)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(make_docs(rows)).collect()}
    assert got == {i: (rows[0][1] if i == 0 else "") for i in range(400)}


def test_line_dedup_empty(make_docs):
    assert line_dedup.dedup(make_docs([])).count() == 0
    assert [r.text for r in line_dedup.dedup(make_docs([(1, None)])).collect()] == [None]


def test_no_broadcast_above_an_explode(spark):
    """Spark's estimate of an exploded side is the size before the explode."""
    from wattsmith.llm.simhash import _hot_links, links
    fps = spark.range(200_000).select(F.xxhash64("id").alias("fp"))
    hot = fps.select(F.lit(5).cast("bigint").alias("key"), "fp")
    for df in (links(fps), _hot_links(hot)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for part in plan.split("BroadcastExchange")[1:]:
            assert "Generate" not in part
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_fingerprint_across_chunks():
    """A text of more shingles than are unpacked at once."""
    from wattsmith.llm import simhash
    text = " ".join(f"w{i % 70_001}" for i in range(simhash.CHUNK + 5000))
    words = text.split()
    import xxhash
    ones = [0] * 64
    n = len(words) - 2
    for i in range(n):
        h = xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    want = sum(1 << b for b in range(64) if 2 * ones[b] > n)
    assert simhash.fingerprint(text) % (1 << 64) == want


def test_very_many_dropped_lines(spark, make_docs):
    """One text of 100,000 equal lines, and lines that stay in their order."""
    line = "the same line again and again"
    text = "\n".join(["first line of this text", *[line] * 100_000, "", "last line of this text"])
    got = line_dedup.dedup(make_docs([(1, text), (2, line)])).orderBy("doc_id").collect()
    assert got[0].text == f"first line of this text\n{line}\n\nlast line of this text"
    assert got[0].n_equal == 99_999 and got[1].text == ""
