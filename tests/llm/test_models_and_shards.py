"""Operators 1, 6, 7 and 10, and the pipeline."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattsmith.llm import importance, language_id, sentencepiece, sharding
from wattsmith.llm.queries import registry

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
EXTRA = ["shard", "n", "key", "score", "ids", "kept"]  # clashing names


# --- op10 ------------------------------------------------------------------

def held(rows, texts, shards):
    """The contract of law ``rows``; returns shards per text."""
    n = len(rows)
    counts, slots, of_text = {}, {}, {}
    for r, t in zip(rows, texts):
        b = (t or "").encode()
        assert r.size == len(b) + 1 and r.text_crc32 == zlib.crc32(b)
        counts[r.shard] = counts.get(r.shard, 0) + 1
        slots.setdefault(r.shard, []).append(r.slot)
        of_text.setdefault(t or "", set()).add(r.shard)
    assert set(counts) <= set(range(shards))
    assert sum(counts.values()) == n and max(counts.values()) - min(
        counts.get(s, 0) for s in range(shards)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return of_text


def sharded(docs, **kw):
    """Rows in an order shared with their texts."""
    own = {}
    for r in docs.select("doc_id", "text").collect():
        own.setdefault(((r.text or "").encode().__len__() + 1, zlib.crc32((r.text or "").encode())), r.text)
    got = sharding.shard_documents(docs, **kw).collect()
    return got, [own[r.size, r.text_crc32] for r in got]


def test_shards_of_documents(spark):
    rows, texts = sharded(spark.read.parquet(f"{SF01}/documents.parquet").withColumns({c: F.lit("extra") for c in EXTRA}))
    of_text = held(rows, texts, 16)
    assert all(len(s) == 1 for s in of_text.values())  # room for all: no link is cut


def test_shards_of_a_hot_group(make_docs):
    rows = [(i, "hot") for i in range(200)] + [(1000 + i, f"t{i}") for i in range(300)]
    rows += [(2000 + i, f"pair{i // 3}") for i in range(99)] + [(None, None), (None, ""), (7, "hot"), (7, "hot")]
    got, texts = sharded(make_docs(rows))
    of_text = held(got, texts, 16)
    assert len(of_text["hot"]) <= 8  # 202 of 603 rows, 38 to a shard: six at least
    assert sum(len(s) > 1 for t, s in of_text.items() if t.startswith("pair")) <= 3
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in rows)


def test_shards_of_a_table_united_with_itself(make_docs):
    """Every document is linked and every shard is full: groups come together by exchange."""
    got, texts = sharded(make_docs([(i, f"text {i % 400}") for i in range(800)]), shards=8)
    assert all(len(s) == 1 for s in held(got, texts, 8).values())


def test_few_groups_are_cut(make_docs):
    """Copies of many numbers and no document without links: fewer cut groups than shards."""
    rows = [(g * 100 + i, f"text {g}") for g in range(150) for i in range(2 + g % 5)]
    got, texts = sharded(make_docs(rows), shards=8)
    assert sum(len(s) > 1 for s in held(got, texts, 8).values()) < 8


def test_cut_links_against_every_placement():
    """Parts on edges: rooms kept, fewer cuts than shards, and none missing where no placement of wholes exists."""
    rng = random.Random(5)
    for _ in range(60):
        room = [rng.randint(1, 6) for _ in range(3)]
        parts, left = [], sum(room)
        while left and len(parts) < 5:
            n = rng.randint(1, min(4, left))
            parts.append((len(parts), 0, n))
            left -= n
        placed = sharding.on_edges(parts, room)
        for s, r in enumerate(room):
            assert sum(n for _, _, t, n in placed if t == s) <= r
        for g, _, n in parts:
            assert sum(m for h, _, _, m in placed if h == g) == n
        cuts = len(placed) - len(parts)
        fits = any(all(sum(p[2] for p, s in zip(parts, to) if s == t) <= r for t, r in enumerate(room))
                   for to in itertools.product(range(3), repeat=len(parts)))
        assert cuts <= 2 and (fits or cuts)


def test_quotas_never_overfill():
    rng = random.Random(7)
    for shards in (2, 5, 16):
        for _ in range(40):
            demand = {(rng.randrange(shards), rng.randrange(shards)): rng.randint(1, 50) for _ in range(3 * shards)}
            demand = {e: n for e, n in demand.items() if e[0] != e[1]}
            room = [rng.randint(-5, 5) for _ in range(shards)]
            may = sharding.quotas(demand, room)
            assert all(0 <= may[e] <= n for e, n in demand.items()) and set(may) == set(demand)
            into = [sum(n for (_, b), n in may.items() if b == s) for s in range(shards)]
            out = [sum(n for (a, _), n in may.items() if a == s) for s in range(shards)]
            assert all(i - o <= max(0, r) for i, o, r in zip(into, out, room))
            # nothing more could move: no wish into room, no ring of two
            rest = {e: n - may[e] for e, n in demand.items() if n > may[e]}
            assert all(room[b] - into[b] + out[b] <= 0 for _, b in rest)
            assert not any((b, a) in rest for a, b in rest)
    assert sharding.quotas({(0, 1): 3, (1, 2): 5, (2, 0): 4}, [0, 0, 0]) == {(0, 1): 3, (1, 2): 3, (2, 0): 3}


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17])
def test_shards_of_few(make_docs, n):
    got, texts = sharded(make_docs([(i, "same") for i in range(n)]))
    assert len(got) == n
    if n:
        held(got, texts, 16)


# --- op7 -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    with open(sentencepiece.MODEL, "rb") as f:
        return sentencepiece.Tokenizer(f.read())


def test_viterbi_equals_brute_force(tokenizer):
    """The best total score over all segmentations, by plain dynamic programming."""
    score = {p: v[1] for p in tokenizer.pieces if p for v in [tokenizer.automaton.get(p)]}
    r = random.Random(1)
    texts = ["the quick brown fox", "internationalisation", "a  b", "日本語\x00", "straße œuvre", "aaaaaaaaaaaaaaaaa"]
    texts += ["".join(r.choices("abcdeé \n1\U0001F600\x01", k=30)) for _ in range(60)]
    for t in texts:
        s = (" " + t).replace(" ", sentencepiece.MARK)
        best = [0.0] + [float("-inf")] * len(s)
        for e in range(1, len(s) + 1):
            for a in range(max(0, e - 32), e):
                if s[a:e] in score:
                    best[e] = max(best[e], best[a] + score[s[a:e]])
            if s[e - 1] not in score:
                best[e] = max(best[e], best[e - 1] + tokenizer.byte_score)
        ids = tokenizer.encode(t)
        total = sum(score[tokenizer.pieces[i]] if tokenizer.pieces[i] else 0 for i in ids)
        in_bytes = [i for i in ids if tokenizer.pieces[i] is None]
        chars = len(bytes(tokenizer.bytes[i] for i in in_bytes).decode())
        assert total + chars * tokenizer.byte_score == pytest.approx(best[-1]), t


def test_segmentation_is_close_to_the_library(tokenizer):
    import re

    import sentencepiece as library
    p = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    text = sentencepiece.__doc__ + language_id.__doc__ + sharding.__doc__
    found = re.findall("[A-Za-z]+", text)
    same = sum(tokenizer.encode(w) == p.encode(w) for w in found)
    assert same >= 0.95 * len(found)
    assert p.decode(tokenizer.encode("round trip, of any kind")) == "round trip, of any kind"


def test_round_trip(spark, make_docs):
    odd = [None, "", " ", "  two", "▁", "a▁b ▁", "\U0001F600\x00￾", "x" * 50_000, "é" * 3000 + " end ", "\n\t"]
    docs = make_docs([(i, t) for i, t in enumerate(odd)]).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet")).withColumns({c: F.lit("extra") for c in EXTRA})
    got = sentencepiece.encoded(docs).collect()
    assert len(got) == 210 and all(r.round_trip for r in got)
    ids = {r.doc_id: r.ids for r in got[:len(odd)]}
    assert ids[0] is None and ids[1] == []
    assert sentencepiece.encoded(make_docs([])).count() == 0


# --- op6 -------------------------------------------------------------------

def test_kneser_ney_sums_to_one():
    grams = np.concatenate(list(language_id.gram_slices("the cat sat on the mat and the dog sat on the log")))
    keys, n = np.unique(grams, return_counts=True)
    model = language_id.KneserNey(keys, n)
    chars = np.unique(keys & np.uint64(0xFFFF))
    for context in ("the", " ca", "zzz", "t q"):
        c = [ord(x) for x in context]
        base = np.uint64(c[0] << 48 | c[1] << 32 | c[2] << 16)
        p = np.exp(model.log_probability(base | chars))
        unseen = np.exp(model.log_probability(np.array([base | np.uint64(0x4E00)])))
        assert p.sum() + unseen[0] == pytest.approx(1.0)


def test_models_equal_the_single_models():
    texts = {"x": "the cat sat on the mat", "y": "der hund lag auf der matte und schlief"}
    learned = {k: np.unique(np.concatenate(list(language_id.gram_slices(t))), return_counts=True) for k, t in texts.items()}
    models = language_id.Models(learned)
    g = np.concatenate(list(language_id.gram_slices("the hund schlaft \U0001F600 日本 sat")))
    want = [language_id.KneserNey(*learned[k]).log_probability(g).sum() for k in ("x", "y")]
    assert models.total(g) == pytest.approx(want, rel=1e-5)
    assert models.predict("the cat")[0] == "x" and models.predict("der hund")[0] == "y"


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Ünder  the -- 日本語 \U00020000\U00020000 sea, " * 20
    whole = np.concatenate(list(language_id.gram_slices(text)))
    for size in (1, 2, 3, 7, 50):
        monkeypatch.setattr(language_id, "SLICE", size)
        assert (np.concatenate(list(language_id.gram_slices(text))) == whole).all()


def test_language_accuracy_and_contract(spark):
    got = registry()["op6_language_id"](spark, SF01).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_parts_of_a_model_give_what_the_whole_gives(spark, monkeypatch):
    """No n-gram is dropped where the model takes more than a worker may hold at once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    train = docs.filter("doc_id % 2 = 0").select("lang", "text")
    learned = {}
    for r in train.collect():
        if r.text and r.lang and language_id.has_letter(r.text):
            learned.setdefault(r.lang, []).extend(language_id.gram_slices(r.text))
    whole = language_id.Models({k: np.unique(np.concatenate(v), return_counts=True) for k, v in learned.items()})
    monkeypatch.setattr(language_id, "MODEL_BYTES", 200_000)
    models = language_id.learn(train)
    assert len(models) > 2
    texts = docs.unionByName(spark.createDataFrame([(None, None, "x"), (-1, "", "x"), (-2, "日本 zzz", "x"), (0, "12", "x")], docs.schema))
    got = language_id.predict(texts, models, carry=("text",)).collect()
    assert len(got) == texts.count()
    for r in got:
        want = whole.predict(r.text)
        assert (r.lang_pred, r.n) == (want[0], want[3])
        assert r.score == pytest.approx(want[2], rel=1e-4)
        assert r.entropy == (None if want[1] is None else pytest.approx(want[1], rel=1e-5))


def test_language_edge_cases(spark, make_docs):
    train = make_docs([(1, "the cat"), (2, None), (3, "")]).withColumn("lang", F.lit("en")).select("lang", "text")
    models = language_id.learn(train)
    rows = [(1, None), (2, ""), (3, "123 !"), (4, "cat"), (None, "日本"), (5, "\U00020000")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(make_docs(rows).withColumns({c: F.lit("extra") for c in EXTRA}), models).collect()}
    assert got == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("und", 0.0), 4: ("en", 1.0), None: ("en", 1.0), 5: ("en", 1.0)}
    none = language_id.learn(train.limit(0))
    assert [r.lang_pred for r in language_id.predict(make_docs([(1, "cat")]), none).collect()] == ["und"]
    assert language_id.predict(make_docs([]), models).count() == 0


# --- op1 -------------------------------------------------------------------

@pytest.mark.parametrize("values", [[1.0], [1.0] * 50, [float(i % 7) for i in range(100)],
                                    [random.Random(i).gauss(0, 10 ** (i % 5)) for i in range(500)]])
def test_kth_largest(spark, values):
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in {1, 2, len(values) // 2, len(values)}:
        if 1 <= k <= len(values):
            assert importance.kth_largest(keys, k) == sorted(values, reverse=True)[k - 1]


def test_importance_prefers_the_target(spark, make_docs):
    r = random.Random(2)
    good = ["".join(r.choice(["sun ", "sea ", "sky ", "sand "]) for _ in range(60)) for _ in range(150)]
    bad = ["".join(r.choice(["buy ", "now ", "sun ", "win "]) for _ in range(60)) for _ in range(150)]
    docs = make_docs([(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, ""), (None, "sea sky")]).withColumns({c: F.lit("extra") for c in EXTRA})
    labels = [(i, 1, 0) for i in range(0, 75)] + [(i, 0, 0) for i in range(150, 200)] + [(i, 1, 1) for i in range(200, 225)]
    labels = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = importance.resample(docs, labels).collect()
    assert len(got) == 303 and sum(x.kept for x in got) == round(303 * 0.5)
    assert sum(x.kept for x in got if x.doc_id is not None and x.doc_id < 150) >= 145
    again = {x.doc_id: x.key for x in importance.resample(docs, labels).collect()}
    assert again == {x.doc_id: x.key for x in got}
    assert all(x.kept for x in importance.resample(docs, labels.limit(0)).collect())
    assert importance.resample(make_docs([]), labels).count() == 0


def test_importance_sees_word_order_and_numbers(spark, make_docs):
    """The same words in the target's order weigh more than in the opposite order."""
    words = "one two three four five six seven eight".split()
    texts = [" ".join(words), " ".join(reversed(words))] * 20
    docs = make_docs(list(enumerate(texts)) + [(100, "2024 7"), (101, "7 2024 9")])
    labels = spark.createDataFrame([(i, (i + 1) % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in importance.resample(docs, labels).collect()}
    assert got[30].log_weight > got[31].log_weight
    assert got[30].n_grams == 15 and got[100].n_grams == 3 and got[101].n_grams == 5


# --- pipeline --------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash", "decontaminate", "sentencepiece"]
    from wattsmith.operators.joins import materialize
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, seen, SF), name)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in seen.collect()} <= ids
        seen = out
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in seen.collect()} and all(r.round_trip for r in got)


def test_pipeline_by_brute_force(spark):
    """Each stage on the table the one before wrote, against plain Python."""
    from tests_llm_plain import leak_free, one_of_each, rules_kept
    from wattsmith.operators.joins import materialize
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = [rules_kept, None, one_of_each, lambda rows: leak_free(rows, bench)]
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain):
        out = materialize(stage(spark, docs, SF), name)
        if want:
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(want(rows)), name
        docs = out
