"""Operator 7: SentencePiece encoding and decoding by Aho-Corasick and Viterbi.

An Aho-Corasick automaton over the model's pieces reads a text once. At each
position its output links give all pieces that end there, and each relaxes the
best score of that position: best[end] = max(best[start] + score). Walking back
from the end gives the segmentation of highest total score. Characters no piece
covers fall back to their bytes, at a score below every piece's.

No piece holds a word mark after another character (checked when the model is
loaded), and no piece joins characters of two families: two characters are of one
family if some piece holds them side by side, or both are linked so through others. So
a text's best segmentation is that of its chunks, each a run of marks and the
characters of one family that follow. Chunks repeat, so a task remembers those it has
met, in a table of bounded size that it forgets when it ends.

The model file is read on the driver, from a path that is a parameter, and sent
to the workers as a broadcast (half a megabyte). For a merge model the scores are
ranks and count as log-probabilities by Zipf's law (``log_probabilities``); the
library's own encoder merges pairs for that kind, so segmentations can differ
from it (README). Decoding returns the text exactly.

Defined cases: a null text has null ids and text; an empty text has no ids. Texts
that start with a space, hold the mark U+2581 itself, control characters or
anything outside the pieces go through bytes and come back unchanged. Null ids
and repeated rows are carried through. Further columns are ignored; ``add_ids``
keeps them. Chunks of any length are read whole.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import pairwise

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_arrow, read_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"                # stands for a space
_NONE = float("-inf")
REMEMBERED = 1 << 18           # chunks a task keeps, of at most REMEMBERED_CHARS characters
REMEMBERED_CHARS = 64


def log_probabilities(scores: dict[int, float]) -> dict[int, float]:
    """The scores as log-probabilities, which a Viterbi can add up.

    A unigram model has them. A merge model's scores are ranks (0, -1, -2, ...), so
    its pieces get the log-probability of their rank under Zipf's law.
    """
    if any(s != int(s) for s in scores.values()):
        return scores
    order = sorted(scores, key=lambda i: (-scores[i], i))
    norm = math.log(sum(1 / (r + 1) for r in range(len(order))))
    return {i: -math.log(r + 1) - norm for r, i in enumerate(order)}


def families(pieces: Iterable[str]) -> list[str]:
    """The characters that pieces link, as one string per family, the largest first."""
    above: dict[str, str] = {}

    def root(c):
        while above.setdefault(c, c) != c:
            above[c] = above[above[c]]
            c = above[c]
        return c

    for piece in pieces:
        for a, b in pairwise(piece.lstrip(MARK)):
            above[root(a)] = root(b)
    found: dict[str, list[str]] = {}
    for c in sorted(above):
        found.setdefault(root(c), []).append(c)
    return sorted(map("".join, found.values()), key=lambda f: (-len(f), f))


class Tokenizer:
    """Pieces and scores of a SentencePiece model, as an automaton."""

    def __init__(self, model: bytes):
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces: list[str | None] = [None] * p.get_piece_size()
        self.bytes: dict[int, int] = {}
        self.of_byte: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        ranked = {}
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.bytes[i] = int(piece[3:5], 16)
                self.of_byte[self.bytes[i]] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} holds a word mark after another character")
                self.pieces[i] = piece
                ranked[i] = p.get_score(i)
        if len(self.of_byte) != 256:
            raise ValueError("the model has no byte fallback")
        scores = log_probabilities(ranked)
        for i, score in scores.items():
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), score, i))
        self.automaton.make_automaton()
        self.singles = {x for x in self.pieces if x and len(x) == 1}
        self.byte_score = 2 * min(scores.values()) - 10
        # A character of no family stands alone.
        runs = [f"[{re.escape(f)}]+" for f in families(piece for piece in self.pieces if piece)]
        self.chunks = re.compile(f"{MARK}*(?:{'|'.join([*runs, f'[^{MARK}]'])})|{MARK}+", re.DOTALL)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}

    def segment(self, chunk: str) -> bytes:
        """A chunk's ids, packed."""
        if (found := self.known.get(chunk)) is None:
            ids = self._viterbi(chunk)
            found = struct.pack(f"<{len(ids)}i", *ids)
            if len(chunk) <= REMEMBERED_CHARS and len(self.known) < REMEMBERED:
                self.known[chunk] = found
        return found

    def _viterbi(self, chunk: str) -> list[int]:
        """The ids of a chunk's best segmentation."""
        n = len(chunk)
        if self.singles.issuperset(chunk):
            best, back = [0.0] + [_NONE] * n, [None] * (n + 1)
            # Matches come in the order of their end, the longest first, so all that
            # end before this one are known, and with them its start.
            for last, match in self.automaton.iter(chunk):
                end = last + 1
                total = best[end - match[0]] + match[1]
                if total > best[end]:
                    best[end], back[end] = total, match
        else:
            best, back = self._relax_with_bytes(chunk)
        out = []
        while n:
            size, _, i = back[n]
            n -= size
            out.append(i) if isinstance(i, int) else out.extend(reversed(i))
        out.reverse()
        return out

    def _relax_with_bytes(self, chunk: str):
        """As in ``_viterbi``, and a character that is no piece may be its bytes."""
        n, done = len(chunk), 0
        best, back = [0.0] + [_NONE] * n, [None] * (n + 1)

        def fall_back(to):
            nonlocal done
            while done < to:
                done += 1
                c = chunk[done - 1]
                total = best[done - 1] + self.byte_score
                if c not in self.singles and total > best[done]:
                    best[done], back[done] = total, (1, 0.0, tuple(self.of_byte[b] for b in c.encode()))

        for last, match in self.automaton.iter(chunk):
            end = last + 1
            fall_back(end - 1)
            total = best[end - match[0]] + match[1]
            if total > best[end]:
                best[end], back[end] = total, match
        fall_back(n)
        return best, back

    def encode(self, text: str) -> list[int]:
        return self.encode_array(text).tolist()

    def encode_array(self, text: str) -> np.ndarray:
        """Ids of a text, led by a word mark as the library does. A real U+2581 would
        read as a space, so it goes as bytes."""
        out: list[bytes] = []
        for k, part in enumerate((" " + text).split(MARK) if text else []):
            if k:
                out += [struct.pack("<i", self.of_byte[b]) for b in MARK.encode()]
            out += map(self.segment, self.chunks.findall(part.replace(" ", MARK)))
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return self._joined(ids)[1:]

    def _joined(self, ids) -> str:
        pieces = self.pieces
        if self.bytes.keys().isdisjoint(ids):
            return "".join([pieces[i] for i in ids]).replace(MARK, " ")
        out: list[bytes] = []
        run: list[str] = []
        for i in ids:
            piece = pieces[i]
            if piece is not None:
                run.append(piece)
            else:
                out.append("".join(run).replace(MARK, " ").encode())
                run = []
                out.append(bytes((self.bytes[i],)))
        out.append("".join(run).replace(MARK, " ").encode())
        return b"".join(out).decode("utf-8")


_LOADED: dict[int, Tokenizer] = {}


@contextmanager
def _tokenizer(sent):
    """This worker's tokenizer, built once from the broadcast model, for one task: what
    it remembers goes with the task."""
    key = hash(sent.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(sent.value)
    try:
        yield _LOADED[key]
    finally:
        _LOADED[key].forget()


def load(spark: SparkSession, path: str = MODEL):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def add_ids(docs: DataFrame, text_col: str = "text", path: str = MODEL, ids: str = "ids") -> DataFrame:
    """``docs`` with its columns and ``ids``, array<int>."""
    bound_arrow(docs.sparkSession)
    sent = load(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with _tokenizer(sent) as t:
            for text in texts:
                yield pd.Series([None if x is None else t.encode_array(x) for x in text], dtype=object)
    return docs.withColumn(ids, encode(F.col(f"`{text_col}`")))


def decoded(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = MODEL) -> DataFrame:
    """``df`` with the text that its ids stand for."""
    sent = load(df.sparkSession, path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with _tokenizer(sent) as t:
            for rows in batches:
                yield pd.Series([None if x is None else t.decode(x) for x in rows], dtype=object)
    return df.withColumn(out, decode(F.col(f"`{ids}`")))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, n_ids, and whether decoding the ids
    gave the text again. Both directions run where the text already is, so that neither
    the ids nor the decoded text travel to Python again."""
    bound_arrow(docs.sparkSession)
    sent = load(docs.sparkSession, path)

    @F.pandas_udf("ids array<int>, round_trip boolean")
    def there_and_back(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with _tokenizer(sent) as t:
            for text in texts:
                ids = [None if x is None else t.encode_array(x) for x in text]
                same = [i is None or t.decode(i) == x for i, x in zip(ids, text)]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "round_trip": same})

    both = docs.select(F.col(f"`{id_col}`").alias("doc_id"), there_and_back(F.col(f"`{text_col}`")).alias("e"))
    return both.select("doc_id", "e.ids", F.size("e.ids").alias("n_ids"), "e.round_trip")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read_table(spark, sf_dir, "documents"))
