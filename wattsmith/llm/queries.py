"""Registered queries of the text operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, conversation_trie, decontaminate, filter_audit, importance, language_id, line_dedup,
               pii, quality_rules, secrets, sentencepiece, sharding, simhash)

MODULES = [importance, decontaminate, pii, simhash, line_dedup, language_id, sentencepiece, secrets,
           quality_rules, sharding, filter_audit, conversation_trie, bpe]


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in vars(m).items()
            if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE_SQL", {}).items()}
