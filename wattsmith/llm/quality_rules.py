"""Operator 9: quality rules by repetition coverage.

Each text is cut into words. Rolling polynomial hashes of its word windows, for
several window lengths, are built one from the other in numpy, and the
characters inside windows that occur twice or more are measured, as are the
characters of repeated lines. Row-wise work: no shuffle, bounded by one Arrow
batch of texts.

Defined cases: a null text has no words (all measures 0, ``base_failed``); an
empty text likewise. A null ``doc_id`` is carried through. Repeated rows are
measured each for itself. Windows longer than the text do not exist. Further
columns of the input never take part; ``apply_rules`` keeps them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_PYTHON, bound_arrow, read_table

_WORD = re.compile(WORD_PYTHON)
SYMBOLS = "#*$%&|<>"  # fixed value
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash

WINDOW = 8          # words in the contract's window
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, dup_line_share double, top_coverage double, "
          "symbol_share double, base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Limits:
    """Most a kept text may have. Coverage: the share of word characters that lie
    inside windows of so many words to which an equal window comes before (a line
    repeated once in a short text alone must not reject it)."""
    coverage: tuple[tuple[int, float], ...] = (
        (5, 0.30), (6, 0.28), (7, 0.26), (8, 0.24), (9, 0.22), (10, 0.20))
    dup_line_share: float = 0.50      # lines equal to an earlier one, of lines with a word
    dup_line_chars: float = 0.30      # their characters, of all characters in lines
    symbols_per_word: float = 0.10


def windows_repeated(ids: np.ndarray, lengths: tuple[int, ...]):
    """Yield, for each length, the starts of windows that occur twice or more, and
    those of them that an equal window comes before.

    A window can only repeat if the shorter window at its start does, so each
    length looks at the starts the length before left over.
    """
    n, power = len(ids), np.uint64(1)
    rolling = np.zeros(n, np.uint64)
    starts = np.arange(n)
    done = 0
    for length in lengths:
        with np.errstate(over="ignore"):
            for j in range(done, min(length, n)):
                rolling[: n - j] += ids[j:] * power
                power = power * _BASE
        done = length
        starts = later = starts[starts <= n - length]
        if len(starts):
            h = rolling[starts]
            s = np.sort(h)
            if not (s[1:] == s[:-1]).any():  # most texts end here; cheaper than ordering
                starts = later = starts[:0]
            else:
                order = np.argsort(h, kind="stable")
                s = h[order]
                same = s[1:] == s[:-1]
                dup = np.zeros(len(s), bool)
                dup[1:] |= same
                dup[:-1] |= same
                later = starts[order[1:][same]]  # the order is stable: first come first
                starts = np.sort(starts[order[dup]])
        yield length, starts, later


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` words lie inside a window of ``length`` at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def measure(text: str | None, limits: Limits = Limits()) -> tuple:
    """One text's measures and verdict, in the order of ``SCHEMA``."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    lens = np.fromiter(map(len, words), np.int64, n)
    word_chars = int(lens.sum())
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    seen: set[str] = set()
    n_dup = dup_chars = 0
    for x in lines:
        if x in seen:
            n_dup += 1
            dup_chars += len(x)
        else:
            seen.add(x)
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    most = dict(limits.coverage)
    n_repeat, top, over = 0, 0.0, False
    for length, starts, later in windows_repeated(ids, tuple(sorted({WINDOW, *most}))):
        if not len(starts):
            continue
        if length == WINDOW:
            n_repeat = int(covered(n, starts, length).sum())
        if length in most:
            share = float(lens[covered(n, later, length)].sum() / word_chars)
            top = max(top, share)
            over |= share > most[length]
    line_share = n_dup / len(lines) if lines else 0.0
    line_chars = dup_chars / sum(map(len, lines)) if lines else 0.0
    symbols = n_symbols / n if n else 0.0
    base_failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n
    kept = not (base_failed or over or line_share > limits.dup_line_share
                or line_chars > limits.dup_line_chars or symbols > limits.symbols_per_word)
    return (n, word_chars, n_symbols, n_dup, n_repeat, line_share, top, symbols, base_failed, kept)


def _measured(limits: Limits):
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def rules(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t, limits) for t in text], columns=names)

    return rules


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: its id, the measures and ``kept``."""
    bound_arrow(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("doc_id"), _measured(limits)(F.col(text_col)).alias("m"))
            .select("doc_id", *[f"m.{c}" for c in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "kept", "dup_line_share", "top_coverage", "symbol_share")]))


def apply_rules(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, with all their columns."""
    bound_arrow(docs.sparkSession)
    cols = docs.columns
    marked = docs.withColumn("__rules", _measured(limits)(F.col(text_col)))
    return marked.filter("__rules.kept").select(*[F.col(f"`{c}`") for c in cols])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))
