"""Operator 13: byte-pair encoding and decoding with a contiguous rank array.

A text is cut at the vocabulary's special tokens; the rest is brought to NFC,
lower-cased character by character, and cut into words (letters, single digits,
runs of other marks, English contractions). A word's UTF-8 bytes are written as one
character each, the last with the end-of-word mark. For a short word two arrays
are held: the parts between its boundaries and, for each boundary, the rank of deleting
it. The least rank is found by a scan, its boundary deleted, and the two ranks
beside it refreshed, until no neighbours join. In a word over ``SHORT`` characters
scanning would be quadratic; there a heap of (rank, place) over linked parts makes
the same joins in the same order.

Decoding writes the ids' pieces with a space between, which is what a vocabulary
without a decoder stands for; end-of-word marks stay visible. Ids do not hold white
space, letter case or compositions, so the text itself cannot come back.

The vocabulary file is read on the driver, from a path that is a parameter, and sent
to the workers as a broadcast (1.7 MB, whatever the table's size). Words repeat, so
a task remembers up to ``REMEMBERED`` of them and forgets them when it ends.

The library that reads such files has Unicode tables of its own, some characters older
or newer than Python's. ``unicode_differences`` asks it, once on the driver, for the
characters whose class or lower case differ; texts that hold one take a slower way.

Defined cases: a null text counts as empty and has no ids and an empty decoding. A
special token's string in a text is that token. Texts and words of any length are
read whole. Null ids, repeated rows and ties are carried through, a row per row.
Further columns are ignored by ``encoded``; ``add_ids`` keeps them, and a column
of its output's name is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_arrow, read_table

MODEL = "/opt/tokenizers/word_bpe_49k.json"
SHORT = 96                  # characters of a word that are scanned; longer ones take a heap
REMEMBERED = 1 << 18        # words a task keeps, of at most REMEMBERED_CHARS characters
REMEMBERED_CHARS = 64
NEVER = 1 << 62             # the rank of neighbours that do not join
ID_BITS = 20
# Fixed value: the word pattern of the vocabulary's file, which ``check_steps`` asserts.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the
    others, in order, for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def check_steps(model: dict) -> None:
    """Raise if the file asks for a step that this module does not take."""
    normal = [n["type"] for n in model["normalizer"]["normalizers"]]
    split, level = model["pre_tokenizer"]["pretokenizers"]
    wrong = [what for what, ok in {
        "normalizer": normal == ["NFC", "Replace", "Lowercase"],
        "word pattern": split["pattern"] == {"Regex": WORDS} and split["behavior"] == "Removed" and split["invert"],
        "byte level": level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"],
        "model": model["model"]["type"] == "BPE" and not model["model"]["dropout"]
        and not model["model"]["ignore_merges"] and not model["model"]["continuing_subword_prefix"],
        "decoder": model["decoder"] is None,
        "added tokens": not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]
                                for t in model["added_tokens"]),
    }.items() if not ok]
    if wrong:
        raise ValueError(f"the vocabulary file has another {', '.join(wrong)} than this encoder")


def unicode_differences() -> tuple[dict[str, str], str]:
    """Lower cases of the library that differ from Python's, and the characters that
    the pattern takes for letters or numbers and the library does not."""
    from tokenizers import Regex, normalizers, pre_tokenizers
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c) not in " \n"]
    theirs = normalizers.Lowercase().normalize_str("\n".join(every)).split("\n")
    lower = {c: low for c, low in zip(every, theirs, strict=True) if low != c.lower()}
    word = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True)
    spaced = "".join(regex.findall(r"[\p{L}\p{N}]", "".join(every)))
    known = {c for c, _ in word.pre_tokenize_str(spaced)}
    return lower, "".join(c for c in spaced if c not in known)


class Bpe:
    """Pieces and ranked joins of a vocabulary file. ``differences``: see
    ``unicode_differences``."""

    def __init__(self, file: bytes, differences: tuple[dict[str, str], str] = ({}, "")):
        model = json.loads(file)
        check_steps(model)
        bpe = model["model"]
        end = bpe["end_of_word_suffix"] or ""
        ids: dict[str, int] = bpe["vocab"]
        chars = byte_characters()
        if missing := [c for c in chars if c not in ids or c + end not in ids]:
            raise ValueError(f"{len(missing)} bytes have no piece")
        self.inside = [ids[c] for c in chars]           # a byte's id, and that of a word's last byte
        self.final = [ids[c + end] for c in chars]
        # Joins by the two parts' ids in one number, and what they give, by rank.
        self.rank = {ids[x] << ID_BITS | ids[y]: r for r, (x, y) in enumerate(bpe["merges"])}
        self.joined = [ids[x + y] for x, y in bpe["merges"]]
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special = special
        self.pieces = {i: p for p, i in [*ids.items(), *special.items()]}
        if max(self.pieces) >> ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        # The longest first, so that one that starts another does not hide it.
        order = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, order)) + ")") if order else None
        self.words = regex.compile(WORDS)
        self.lower, other = differences
        self.masked = dict.fromkeys(map(ord, other), "\ue000")   # neither letter nor number nor space
        self.odd = frozenset(other).union(self.lower)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}

    def parts(self, word: str) -> list[int]:
        """The ids of a word's parts."""
        *head, last = word.encode()
        ids = [*map(self.inside.__getitem__, head), self.final[last]]
        return self._scanned(ids) if len(ids) <= SHORT else self._queued(ids)

    def _scanned(self, ids: list[int]) -> list[int]:
        """``ids`` are the parts between the boundaries; ``ranks[i]`` is the rank of
        deleting the boundary after part i."""
        rank = self.rank.get
        ranks = [rank(a << ID_BITS | b, NEVER) for a, b in pairwise(ids)]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            ids[i] = self.joined[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << ID_BITS | ids[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank(ids[i] << ID_BITS | ids[i + 1], NEVER)
        return ids

    def _queued(self, ids: list[int]) -> list[int]:
        """The same joins by a heap. The part at place i is followed by the one at
        ``after[i]`` and comes after that at ``before[i]``; a joined part has id -1."""
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list[tuple[int, int]] = []

        def rank(i):
            return self.rank.get(ids[i] << ID_BITS | ids[after[i]]) if after[i] < n else None

        def offer(i):
            if (r := rank(i)) is not None:
                heapq.heappush(heap, (r, i))

        for i in range(n):
            offer(i)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:      # this part or the next has changed since
                continue
            gone = after[i]
            ids[i], ids[gone] = self.joined[r], -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> bytes:
        """A word's ids, packed."""
        if (found := self.known.get(word)) is None:
            ids = self.parts(word)
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(word) <= REMEMBERED_CHARS and len(self.known) < REMEMBERED:
                self.known[word] = found
        return found

    def words_of(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii() or self.odd.isdisjoint(text):
            return self.words.findall(lowered(text))
        low = "".join([self.lower.get(c) or c.lower() for c in unicodedata.normalize("NFC", text)])
        return [low[slice(*m.span())] for m in self.words.finditer(low.translate(self.masked))]

    def encode(self, text: str | None) -> bytes:
        """A text's ids as little-endian unsigned 32-bit integers."""
        ids: list[bytes] = []
        for k, piece in enumerate(self.cut.split(text or "") if self.cut else [text or ""]):
            if k % 2:
                ids.append(struct.pack("<I", self.special[piece]))
            elif piece:
                ids += map(self.word, self.words_of(piece))
        return b"".join(ids)

    def decode(self, ids) -> str:
        return " ".join(map(self.pieces.__getitem__, ids))

    def unpack(self, ids: bytes) -> list[int]:
        return np.frombuffer(ids, "<u4").tolist()


def lowered(text: str) -> str:
    """NFC, then each character's lower case, whatever stands beside it."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    # Only a sigma's lower case depends on its place in a whole string.
    return text.lower() if "Σ" not in text else "".join([c.lower() for c in text])


_LOADED: dict[str, Bpe] = {}


def _encoder(sent) -> Bpe:
    """This worker's encoder, built once from the broadcast file."""
    name, file, differences = sent.value
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Bpe(file, differences)
    return _LOADED[name]


def load(spark: SparkSession, path: str = MODEL):
    with open(path, "rb") as f:
        file = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(file).hexdigest(), file, unicode_differences()))


def encoding(spark: SparkSession, text: Column, path: str = MODEL) -> Column:
    """struct<ids: binary, decoded: string> of a text column."""
    bound_arrow(spark)
    sent = load(spark, path)

    @F.pandas_udf("ids binary, decoded string")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _encoder(sent)
        try:
            for batch in texts:
                ids = [bpe.encode(x) for x in batch]
                yield pd.DataFrame({"ids": ids, "decoded": [bpe.decode(bpe.unpack(x)) for x in ids]}, dtype=object)
        finally:
            bpe.forget()
    return encode(text)


def add_ids(docs: DataFrame, text_col: str = "text", path: str = MODEL, ids: str = "ids",
            out: str = "decoded") -> DataFrame:
    """``docs`` with its columns, ``ids`` (array<bigint>) and what they stand for."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (ids, out)]
    both = docs.select(*keep, encoding(docs.sparkSession, F.col(f"`{text_col}`"), path).alias("__e"))
    return both.select(*keep, unpacked(F.col("__e.ids")).alias(ids), F.col("__e.decoded").alias(out))


def unpacked(ids: Column) -> Column:
    """Packed ids as array<bigint>."""
    big_endian = F.regexp_replace(F.hex(ids), "(..)(..)(..)(..)", "$4$3$2$1")
    return F.transform(F.regexp_extract_all(big_endian, F.lit(".{8}"), F.lit(0)),
                       lambda h: F.conv(h, 16, 10).cast("bigint"))


def decoded(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = MODEL) -> DataFrame:
    """``df`` with the text that an array of ids stands for (null: null)."""
    sent = load(df.sparkSession, path)

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        bpe = _encoder(sent)
        return pd.Series([None if x is None else bpe.decode(map(int, x)) for x in rows], dtype=object)
    return df.withColumn(out, decode(F.col(f"`{ids}`")))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (packed, little-endian), decoded."""
    e = encoding(docs.sparkSession, F.col(f"`{text_col}`"), path)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), e.alias("e")).select("doc_id", "e.ids", "e.decoded")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read_table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
