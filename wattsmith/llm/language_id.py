"""Operator 6: language identification by interpolated Kneser-Ney character models.

Per language, the 4-grams of letters and spaces of all training documents are
counted in Spark. From their counts an interpolated Kneser-Ney model follows:
lower orders count the distinct characters an n-gram continues, each order has its
own discount, and the lowest mixes with the uniform distribution.

The models are stored as sorted arrays of 64-bit n-gram hashes, one per order for
all languages together, beside a column of log-probabilities per language. A text
is scored by binary search in them; the language of lowest cross-entropy per
character wins. The cross-entropies of the training documents give each language
a limit (a high quantile); a document beyond its language's limit is marked
``rejected`` and its score halved.

Every n-gram is kept. Discounts and the two lowest orders are counted in Spark over
all of them. What a worker holds at once is bounded by ``MODEL_BYTES``: a larger model
is cut into parts by the two middle characters of its 4-grams, a part has all that
scoring its 4-grams needs, and the texts are read once per part, whose sums are added.
Only the 4-grams around one pair of characters are never cut apart.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. If
nothing can be learned (no training row with a language and letters), all are
``und``. Equal cross-entropies go to the language that sorts first. A null id
hashes as the empty text. Repeated rows are trained on and predicted each for
itself. Further columns are ignored. Long texts are read in slices of bounded size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsmith.operators.joins import materialize

from .common import bound_arrow, read_table

ORDER = 4
SPACE = 32
OTHER_LETTER = 0xFFFF        # letters beyond 16 bits
SLICE = 1 << 20              # characters handled at once
MODEL_BYTES = 96 << 20       # what a part of the model sent to the workers may take
FLUSH = 1 << 21              # distinct n-grams a task holds before it passes them on
REJECT_QUANTILE = 0.999
EVIDENCE = 50                # characters beyond which the score gets no surer
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Each 16-bit character's class: itself if a letter or a mark, else a space."""
    kept = [unicodedata.category(chr(c))[0] in "LM" for c in range(0x10000)]
    table = np.where(kept, np.arange(0x10000), SPACE).astype(np.uint16)
    table[OTHER_LETTER] = SPACE
    return table


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_slices(text: str) -> Iterator[np.ndarray]:
    """The packed 4-grams of a text, one per character after the first three (spaces
    stand before it and one behind it), in slices."""
    tail = np.full(ORDER - 1, SPACE, np.uint16)
    text = text.lower()
    for at in range(0, len(text), SLICE):
        wide = np.frombuffer(text[at:at + SLICE].encode("utf-32-le"), np.uint32)
        c = _letters()[np.minimum(wide, OTHER_LETTER)]
        for far in np.unique(wide[wide > 0xFFFF]):
            if chr(far).isalpha():
                c[wide == far] = OTHER_LETTER
        if at + SLICE >= len(text):
            c = np.append(c, np.uint16(SPACE))
        c = np.concatenate([tail, c])
        keep = (c != SPACE) | (np.concatenate([[np.uint16(0)], c[:-1]]) != SPACE)
        keep[:ORDER - 1] = True
        c = c[keep]
        tail = c[1 - ORDER:]
        c = c.astype(np.uint64)
        if len(c) >= ORDER:
            yield (c[:-3] << np.uint64(48)) | (c[1:-2] << np.uint64(32)) | (c[2:-1] << np.uint64(16)) | c[3:]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows():
        out = [pd.DataFrame({"lang": lang, "gram": k.view(np.int64), "n": n}) for lang, (k, n) in held.items()]
        held.clear()
        return out

    def add(lang, waiting):
        k, n = held.get(lang, (np.empty(0, np.uint64), np.empty(0, np.int64)))
        new, count = np.unique(np.concatenate(waiting), return_counts=True)
        held[lang] = _summed(np.concatenate([k, new]), np.concatenate([n, count]))

    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=False)["text"]:
            waiting, size = [], 0
            for text in texts:
                if has_letter(text):
                    for g in gram_slices(text):
                        waiting.append(g)
                        size += len(g)
                        if size >= FLUSH:
                            add(lang, waiting)
                            waiting, size = [], 0
            if waiting:
                add(lang, waiting)
            if sum(len(k) for k, _ in held.values()) > FLUSH:
                yield from rows()
    yield from rows()


def count_grams(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``train`` (lang, text)."""
    own = train.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return (own.mapInPandas(_count, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _context_sums(keys: np.ndarray, values: np.ndarray):
    """Contexts (all but the last character) in order, sums and numbers of their keys,
    and each key's place among them."""
    contexts, place = np.unique(keys >> np.uint64(16), return_inverse=True)
    return contexts, np.bincount(place, values), np.bincount(place), place


def _discount(n: np.ndarray) -> float:
    once, twice = int((n == 1).sum()), int((n == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


class KneserNey:
    """One language's model: per order, keys with log-probabilities and contexts with
    the log of the weight they leave to the order below.

    A part of a model has the 4-grams around some pairs of characters; ``lower``, by
    order, the 2- and 1-grams with counts over the whole model, and ``discounts`` each
    order's."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray,
                 lower: dict[int, tuple[np.ndarray, np.ndarray]] | None = None,
                 discounts: dict[int, float] | None = None):
        levels = [(grams, counts)]
        for order in range(ORDER - 1, 0, -1):  # continuation counts from the types above
            if lower and order in lower:
                levels.append(lower[order])
                continue
            shorter = levels[-1][0] & np.uint64((1 << (16 * order)) - 1)
            levels.append(np.unique(shorter, return_counts=True))
        self.uniform = 1.0 / (len(levels[-1][0]) + 1)
        below_keys, below = None, None
        self.keys, self.logp, self.contexts, self.left = [], [], [], []
        for order, (keys, n) in enumerate(reversed(levels), 1):
            d = discounts[order] if discounts else _discount(n)
            contexts, total, types, place = _context_sums(keys, n)
            left = d * types / total
            if order == 1:
                lower = self.uniform
            else:
                lower = below[np.searchsorted(below_keys, keys & np.uint64((1 << (16 * (order - 1))) - 1))]
            p = np.maximum(n - d, 0) / total[place] + left[place] * lower
            self.keys.append(keys)
            self.logp.append(np.log(p))
            self.contexts.append(contexts)
            self.left.append(np.log(left))
            below_keys, below = keys, p

    def log_probability(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of each n-gram's last character after the others."""
        if order == 0:
            return np.full(len(gram), np.log(self.uniform))
        keys = self.keys[order - 1]
        if not len(keys):  # a part without n-grams of this language
            return self.log_probability(gram & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        out = self.logp[order - 1][at]
        miss = np.flatnonzero(keys[at] != gram)
        if len(miss):
            contexts, g = self.contexts[order - 1], gram[miss]
            c = np.minimum(np.searchsorted(contexts, g >> np.uint64(16)), len(contexts) - 1)
            left = np.where(contexts[c] == g >> np.uint64(16), self.left[order - 1][c], 0.0)
            out[miss] = left + self.log_probability(g & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
        return out


def _hash(gram: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64 bits, so equal hashes are equal n-grams."""
    with np.errstate(over="ignore"):
        h = (gram ^ (gram >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Models:
    """All languages' models as sorted hash arrays. Level by level from the longest
    n-grams: a hash array of those any language has seen with a row of
    log-probabilities, and one of their contexts with a row of what each leaves to
    the next level. ``span``: the pairs (see ``_pair``) a part is about, above the first
    and up to the second."""

    def __init__(self, learned: dict[str, tuple], span: tuple[int, int] = (-1, 1 << 32)):
        self.langs, self.span = sorted(learned), span
        models = [KneserNey(*learned[lang]) for lang in self.langs]
        self.grams, self.contexts = [], []
        for order in range(ORDER, 0, -1) if models else ():
            keys = np.unique(np.concatenate([m.keys[order - 1] for m in models]))
            self.grams.append(self._sorted(keys, np.stack([m.log_probability(keys, order) for m in models], 1)))
            ctx = np.unique(np.concatenate([m.contexts[order - 1] for m in models]))
            left = np.zeros((len(ctx), len(models)))
            for j, m in enumerate(models):
                left[np.searchsorted(ctx, m.contexts[order - 1]), j] = m.left[order - 1]
            self.contexts.append(self._sorted(ctx, left))
        self.floor = np.array([np.log(m.uniform) for m in models], np.float32)

    @staticmethod
    def _sorted(keys, values):
        h = _hash(keys)
        order = np.argsort(h)
        return h[order], values[order].astype(np.float32)

    def total(self, gram: np.ndarray, level: int = 0) -> np.ndarray:
        """Summed log-probability of the n-grams under each language."""
        if level == ORDER:
            return len(gram) * self.floor.astype(np.float64)
        hashes, logp = self.grams[level]
        h = _hash(gram)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        seen = hashes[at] == h
        out = logp[at[seen]].sum(axis=0, dtype=np.float64)
        if not seen.all():
            g = gram[~seen]
            hashes, left = self.contexts[level]
            h = _hash(g >> np.uint64(16))
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            out = out + left[at[hashes[at] == h]].sum(axis=0, dtype=np.float64)
            out = out + self.total(g & np.uint64((1 << (16 * (ORDER - 1 - level))) - 1), level + 1)
        return out

    def sums(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """Summed log-probabilities of a text's n-grams in the span, and the number of
        all its n-grams."""
        if text is None or not self.langs or not has_letter(text):
            return None, 0
        total, n = np.zeros(len(self.langs)), 0
        for g in gram_slices(text):
            n += len(g)
            if self.span != (-1, 1 << 32):
                pair = _pair(g).astype(np.int64)
                g = g[(pair > self.span[0]) & (pair <= self.span[1])]
            total += self.total(g)
        return total, n

    def choose(self, total: np.ndarray | None, n: int) -> tuple[str, float, float, int]:
        """Language, its cross-entropy per character, score, characters."""
        if total is None:
            return UNKNOWN, None, 0.0, 0
        entropy = -np.asarray(total) / n
        best = int(np.argmin(entropy))
        weight = np.exp(-(entropy - entropy[best]) * min(n, EVIDENCE))
        return self.langs[best], float(entropy[best]), float(1 / weight.sum()), n

    def predict(self, text: str | None) -> tuple[str, float, float, int]:
        return self.choose(*self.sums(text))


def _pair(gram: np.ndarray) -> np.ndarray:
    """The third and the second character of 4-grams, as one number. Equal pairs share
    all contexts but the one of the 2-grams, which has the third character alone."""
    return ((gram >> np.uint64(16) & np.uint64(0xFFFF)) << np.uint64(16)) | (gram >> np.uint64(32) & np.uint64(0xFFFF))


def _by_lang(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams and counts of each language of (lang, gram, n)."""
    out = {}
    for lang, part in rows.toPandas().groupby("lang"):
        k = part["gram"].to_numpy().view(np.uint64)
        order = np.argsort(k)
        out[lang] = (k[order], part["n"].to_numpy()[order])
    return out


class Learned:
    """What (lang, gram, n) says of all languages, as a sequence of ``Models``, each
    about one span of pairs and made when asked for."""

    def __init__(self, counts: DataFrame):
        third = F.shiftrightunsigned("gram", 16).bitwiseAND(0xFFFF)
        second = F.shiftrightunsigned("gram", 32).bitwiseAND(0xFFFF)
        self.counts = counts.withColumn("pair", third * 0x10000 + second)
        self.orders = {ORDER: counts}
        for order in range(ORDER - 1, 0, -1):  # continuation counts from the types above
            shorter = F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1))
            self.orders[order] = materialize(self.orders[order + 1].groupBy("lang", shorter.alias("gram")).agg(
                F.count(F.lit(1)).alias("n")), f"grams{order}")
        few = [t.groupBy("lang").agg(F.lit(order).alias("order"), F.count_if(F.col("n") == 1).alias("once"),
                                     F.count_if(F.col("n") == 2).alias("twice"), F.count(F.lit(1)).alias("grams"))
               for order, t in self.orders.items()]
        seen = few[0].unionAll(few[1]).unionAll(few[2]).unionAll(few[3]).collect()  # four rows a language
        self.langs = sorted({r["lang"] for r in seen})
        self.discounts = {lang: {} for lang in self.langs}
        for r in seen:
            both = r["once"] and r["twice"]
            self.discounts[r["lang"]][r["order"]] = r["once"] / (r["once"] + 2 * r["twice"]) if both else 0.5
        # Three orders' rows at most come from a 4-gram; a row takes a hash and a column per language.
        need = sum(r["grams"] for r in seen if r["order"] == ORDER) * (8 + 4 * len(self.langs)) * 3
        parts = max(1, -(-need // MODEL_BYTES))
        cuts = []
        if parts > 1:
            *cuts, top = self.counts.agg(F.percentile_approx(
                "pair", [i / parts for i in range(1, parts + 1)], max(10_000, 100 * parts))).first()[0]
            cuts = sorted({c for c in cuts if c < top})
        self.spans = list(zip([-1, *cuts], [*cuts, 1 << 32]))
        self.ones = _by_lang(self.orders[1]) if self.langs else {}  # one row a character

    def __len__(self) -> int:
        return len(self.spans)

    def __iter__(self) -> Iterator[Models]:
        none = (np.empty(0, np.uint64), np.empty(0, np.int64))
        for low, high in self.spans if self.langs else ():
            grams = _by_lang(self.counts.filter((F.col("pair") > low) & (F.col("pair") <= high)).drop("pair"))
            # All 2-grams after the span's third characters: at most one a pair of characters.
            first = F.shiftrightunsigned("gram", 16)
            twos = _by_lang(self.orders[2].filter(first.between(max(low, 0) >> 16, high >> 16)))
            yield Models({lang: (*grams.get(lang, none), {2: twos.get(lang, none), 1: self.ones[lang]},
                                 self.discounts[lang]) for lang in self.langs}, (low, high))
        if not self.langs:
            yield Models({})


def learn(train: DataFrame) -> Learned:
    """Models of the languages of ``train`` (lang, text)."""
    bound_arrow(train.sparkSession)
    return Learned(materialize(count_grams(train), "grams"))


def predict(docs: DataFrame, models: Learned, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, entropy, score, n and ``carry``."""
    bound_arrow(docs.sparkSession)
    result = "lang_pred string, entropy double, score double, n bigint"
    columns = ["lang_pred", "entropy", "score", "n"]
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), *carry)
    if len(models) == 1:
        sent = docs.sparkSession.sparkContext.broadcast(next(iter(models)))

        @F.pandas_udf(result)
        def identify(text: pd.Series) -> pd.DataFrame:
            m = sent.value
            return pd.DataFrame([m.predict(t) for t in text], columns=columns).astype({"entropy": "float64"})

        return own.withColumn("p", identify("__text")).select("doc_id", "p.*", *carry)

    # Rows get a number that stays, by which the parts' sums meet.
    own = materialize(own.withColumn("__row", F.monotonically_increasing_id()), "texts")
    sums = None
    for part in models:
        found = materialize(_part_sums(own, part), "part_sums")
        sums = found if sums is None else sums.unionAll(found)
    added = sums.groupBy("__row").agg(F.first("n").alias("n"), *[
        F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(len(models.langs))])
    chooser = Models({})
    chooser.langs = models.langs

    @F.pandas_udf(result)
    def best(total: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([chooser.choose(t if c else None, c) for t, c in zip(total, n)],
                            columns=columns).astype({"entropy": "float64"})

    p = added.select("__row", best(F.array(*[f"t{j}" for j in range(len(models.langs))]), "n").alias("p"))
    return own.drop("__text").join(p, "__row").select("doc_id", "p.*", *carry)


def _part_sums(texts: DataFrame, part: Models) -> DataFrame:
    """(__row, total, n) of (__row, __text): sums under one part of the model."""
    sent = texts.sparkSession.sparkContext.broadcast(part)

    @F.pandas_udf("total array<double>, n bigint")
    def add(text: pd.Series) -> pd.DataFrame:
        m = sent.value
        return pd.DataFrame([m.sums(t) for t in text], columns=["total", "n"])

    return texts.select("__row", add("__text").alias("s")).select("__row", "s.*")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (rest == 2).alias("held_out"))
    docs = docs.withColumn("learns", ~F.col("held_out") & F.col("lang").isNotNull())
    models = learn(docs.filter("learns").select("lang", "text"))
    p = materialize(predict(docs, models, carry=("held_out", "learns")), "predicted")
    limits = p.filter("learns").groupBy("lang_pred").agg(
        F.percentile_approx("entropy", REJECT_QUANTILE).alias("limit"))  # a row per language
    p = p.join(F.broadcast(limits), "lang_pred", "left").withColumn(
        "rejected", F.coalesce(F.col("entropy") > F.col("limit"), F.lit(False)))
    return p.select("doc_id", "held_out", "lang_pred",
                    F.when(F.col("rejected"), F.col("score") / 2).otherwise(F.col("score")).alias("score"),
                    "entropy", "rejected")
