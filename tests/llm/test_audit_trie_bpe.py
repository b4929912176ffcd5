"""Filter audit, conversation trie and byte-pair encoding against plain versions."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattsmith.llm import bpe, conversation_trie, filter_audit

# --- filter audit ---------------------------------------------------------------

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_audit(docs, labels):
    """docs: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    first = {}
    for i, _, t in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, s, t in docs:
        t = t or ""
        w = WORDS.findall(t)
        fails = {f for f, bad in zip("ABCDE", [
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and i > first[t]]) if bad}
        parts.setdefault(s or "", []).append((i, fails))
    out = set()
    for part, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                lines.append((part, "".join(order), step + 1, f, len(left), len(gone),
                              sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                              sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)))
        out |= {(*x[:3], *x[4:], shapley[x[3]]) for x in lines}
    return out


def audit_rows(spark, docs, labels, span):
    d = spark.createDataFrame([(i, s, t, "x", 1) for i, s, t in docs],
                              "doc_id long, source string, text string, part string, row long")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return filter_audit.audit(d, lab, span=span).collect()


def test_audit_by_brute_force(spark):
    r = random.Random(11)
    texts = ["", None, "a", "A B", "# x", " ".join(f"w{i}" for i in range(210)), "same " * 300,
             " ".join(f"W{i}" for i in range(250)), " ".join(f"w{i} |" for i in range(120)), "z" * 300_000]
    docs = [(r.choice([None, *range(60)]), r.choice([None, "", "hot", "hot", "b"]), r.choice(texts)) for _ in range(150)]
    docs += docs[:10]
    labels = [(r.choice([None, *range(80)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(60)]
    got = [tuple(x) for x in audit_rows(spark, docs, labels, span=7)]
    assert len(got) == 600 * len({s or "" for _, s, _ in docs})
    assert set(got) == plain_audit(docs, labels)


def test_audit_of_an_empty_table(spark):
    assert audit_rows(spark, [], [], 7) == []


def test_galloping_merges():
    r = random.Random(5)
    for _ in range(300):
        lists = [sorted(r.sample(range(60), r.randint(0, 40))) for _ in range(r.randint(0, 5))]
        assert filter_audit.union(lists) == sorted(set().union(*lists))
        a, b = (lists + [[], []])[:2]
        assert filter_audit.difference(a, b) == sorted(set(a) - set(b))
        assert filter_audit.shared(a, b) == len(set(a) & set(b))


def test_posting_lists_are_bounded(spark):
    rows = spark.range(100).select(F.lit("hot").alias("part"), F.col("id"), F.col("id").alias("row"),
                                   *[F.lit(True).alias(f) for f in [*"ABCDE", "good", "toxic"]])
    lists = filter_audit.posting_lists(rows, span=16).collect()
    assert sorted(x.n for x in lists) == [4, 16, 16, 16, 16, 16, 16]
    assert all(x.A == sorted(x.A) and len(x.A) == x.n for x in lists)


# --- conversation trie -------------------------------------------------------------

def plain_trie(turns):
    convs = {}
    for row in turns:
        if row[0] is not None:
            convs.setdefault(row[0], []).append(row[1:])
    own = {c: [(role or "", text or "") for t, role, text in
               sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
           for c, rows in convs.items()}
    new = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members = {}
    for c, s in new.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def words(p):
        return len(WORDS.findall(p[-1][1])) if p else 0

    out = set()
    for p, m in members.items():
        under, todo = [], [p]
        while todo:
            under.append(x := todo.pop())
            todo += kids.get(x, [])
        ended = ",".join(str(c) for c in sorted(c for c in m if len(new[c]) == len(p)))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])),
                 sum(x not in kids for x in under), sum((len(members[x]) - 1) * words(x) for x in under),
                 hashlib.sha256(ended.encode()).hexdigest()))
    return out


def trie_rows(spark, turns, local):
    df = spark.createDataFrame([(*t, 1, "x") for t in turns],
                               "conv_id long, turn long, role string, text string, depth long, parent string")
    return [tuple(x) for x in conversation_trie.prefix_trie(df, local).collect()]


@pytest.mark.parametrize("local", [3, 4096])
def test_trie_by_brute_force(spark, local):
    r = random.Random(2)
    turns = []
    for c in [*range(0, 70), *range(100, 118), 345]:
        for t in range(r.randint(1, 6)):
            turns.append((c, r.choice([t, t, None]), r.choice(["u", "a", None]), r.choice(["x y", "z", "", None])))
    turns += turns[:9] + [(None, 1, "u", "lost")]
    got = trie_rows(spark, turns, local)
    assert len(got) == len(set(got))
    assert set(got) == plain_trie(turns)


def test_deep_and_wide_trie(spark):
    """A conversation over several blocks, copies of it, and a hot first turn."""
    deep = [("u", f"t{i}") for i in range(600)]
    turns = [(c, i, *x) for c in (0, 20, 40) for i, x in enumerate(deep[:600 - c])]
    turns += [(c, 0, "u", "t0") for c in range(60, 300, 20)] + [(c, 1, "a", f"own {c}") for c in range(60, 300, 20)]
    assert set(trie_rows(spark, turns, 50)) == plain_trie(turns)


def test_conversation_without_turns(spark):
    """Its own turns are fewer than those it takes from a head that is absent."""
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    turns = [(c, 0, "u", "a"), (c, 1, "a", "b")]
    assert trie_rows(spark, turns, 4096) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert trie_rows(spark, [], 4096) == []


def test_local_decomposition_sums_subtrees():
    r = random.Random(9)
    for shape in ("random", "chain", "star"):
        n = 300
        parent = [-1] + [{"random": r.randrange(i), "chain": i - 1, "star": 0}[shape] for i in range(1, n)]
        own = [r.randint(0, 9) for _ in range(n)]
        weight, want = [1] * n, list(own)
        for i in range(n - 1, 0, -1):
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
        assert conversation_trie.decompose(parent, weight, [own, own]) == [want, want]


# --- byte-pair encoding ------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.MODEL)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.MODEL, "rb") as f:
        return bpe.Bpe(f.read(), bpe.unicode_differences())


def of_library(t, text):
    ids = t.encode(text, add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_encoder_equals_library(library, encoder):
    r = random.Random(1)
    letters = "abcdeéÉΣσςİıǅ'sStT123½ \n\t\x1c\x85 　ﬁ한글漢字🙂̈́#$%^࢏Ƛ<|endoftext|>"
    texts = ["", "<|startoftext|>a<|endoftext|>", "ab" * 500, "the" * 2000, "!" * 300, "é" * 400, "a" * 200_000]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(2000)]
    for x in texts:
        ids = encoder.unpack(encoder.encode(x))
        assert (ids, encoder.decode(ids)) == of_library(library, x), x[:40]


def test_scan_and_heap_agree(encoder):
    r = random.Random(4)
    for _ in range(500):
        ids = [encoder.inside[b] for b in "".join(r.choices("abehinoprstu", k=r.randint(1, 120))).encode()]
        assert encoder._scanned(list(ids)) == encoder._queued(list(ids))


def plain_bpe(file_pairs, symbols):
    """The definition: join the leftmost pair of the least rank, over and over."""
    while True:
        ranked = [(file_pairs.get((a, b), 1 << 40), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
        if not ranked or min(ranked)[0] == 1 << 40:
            return symbols
        i = min(ranked)[1]
        symbols = symbols[:i] + [symbols[i] + symbols[i + 1]] + symbols[i + 2:]


def test_encoder_equals_definition(encoder):
    import json
    with open(bpe.MODEL) as f:
        model = json.load(f)["model"]
    ranks = {tuple(p): r for r, p in enumerate(model["merges"])}
    r = random.Random(8)
    for _ in range(300):
        word = "".join(r.choices("abehinoprstul", k=r.randint(1, 14)))
        want = plain_bpe(ranks, [*word[:-1], word[-1] + "</w>"])
        assert encoder.parts(word) == [model["vocab"][p] for p in want]


def test_bpe_rows(spark, make_docs, library):
    rows = [(1, "Hello  WORLD's <|endoftext|>"), (2, None), (3, ""), (None, "x"), (1, "Hello  WORLD's <|endoftext|>"),
            (4, "Ünïcödé 漢字 123 " * 2000)]
    docs = make_docs(rows).withColumns({"ids": F.lit(1), "decoded": F.lit("clash")})
    got = bpe.encoded(docs).collect()
    assert sorted((x.doc_id is None, x.doc_id, np.frombuffer(x.ids, "<u4").tolist(), x.decoded) for x in got) == sorted(
        (i is None, i, *of_library(library, t or "")) for i, t in rows)
    wide = bpe.add_ids(docs)
    assert sorted(wide.columns) == sorted(docs.columns)
    for x in bpe.decoded(wide, out="again").collect():
        assert x.ids == of_library(library, x.text or "")[0] and x.again == x.decoded
    assert bpe.encoded(make_docs([])).collect() == []
