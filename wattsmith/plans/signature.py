"""The input signature of a saved model, compared with what it is given to score.

Each column gets one verdict:

- ``same``: equal types;
- ``widened``: given in a narrower type, every value of which the saved type holds;
- ``narrowed``: given in a type whose values the saved one may not hold;
- ``other``: types with no such order (text for a number, say);
- ``missing`` / ``extra``: in one of the two only.

``same``, ``widened`` and ``extra`` pass. Scoring refuses the rest. ``conform`` may be
told to cast instead: what does not survive the cast becomes NULL, and the
number of such values is counted for each column while the rows are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSES = {"same", "widened", "extra"}
_INTS = ["tinyint", "smallint", "int", "bigint"]
# Bits of a whole number that a floating type holds exactly.
_EXACT = {"float": 24, "double": 53}
_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


@dataclass(frozen=True)
class Finding:
    column: str
    saved: str | None
    given: str | None
    verdict: str


def holds(saved: T.DataType, given: T.DataType) -> bool:
    """Whether every value of ``given`` has an equal one in ``saved``."""
    s, g = saved.simpleString(), given.simpleString()
    if s == g:
        return True
    if s in _INTS and g in _INTS:
        return _INTS.index(g) < _INTS.index(s)
    if s in _EXACT and g in _BITS:
        return _BITS[g] - 1 <= _EXACT[s]
    if isinstance(saved, T.DecimalType):
        if isinstance(given, T.DecimalType):
            return (saved.scale >= given.scale
                    and saved.precision - saved.scale >= given.precision - given.scale)
        digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}.get(g)
        return digits is not None and saved.precision - saved.scale >= digits
    return (s, g) in {("double", "float"), ("timestamp_ntz", "date")}


def _narrowed(saved: T.DataType, given: T.DataType) -> bool:
    both_numbers = isinstance(saved, T.NumericType) and isinstance(given, T.NumericType)
    return both_numbers or (isinstance(saved, T.DateType) and isinstance(given, T.TimestampNTZType))


def compare(saved: T.StructType, given: T.StructType) -> list[Finding]:
    """One finding per column, saved ones first, in their order."""
    have = {f.name: f.dataType for f in given.fields}
    out = []
    for f in saved.fields:
        if f.name not in have:
            out.append(Finding(f.name, f.dataType.simpleString(), None, "missing"))
            continue
        g = have[f.name]
        verdict = ("same" if f.dataType == g else "widened" if holds(f.dataType, g)
                   else "narrowed" if _narrowed(f.dataType, g) else "other")
        out.append(Finding(f.name, f.dataType.simpleString(), g.simpleString(), verdict))
    known = set(saved.fieldNames())
    return out + [Finding(f.name, None, f.dataType.simpleString(), "extra")
                  for f in given.fields if f.name not in known]


def model_signature(schema: T.StructType) -> T.StructType:
    """The columns of ``schema`` a model reads: neither keys, nor times, nor the label."""
    from .training import NOT_FEATURES
    return T.StructType([f for f in schema.fields if f.name not in NOT_FEATURES])


def accept(df: DataFrame, saved: T.StructType) -> DataFrame:
    """``df`` with the saved columns in their saved types, further columns as they are.
    Raises if a column is missing or its type does not pass. One projection."""
    wrong = [f for f in compare(saved, df.schema) if f.verdict not in PASSES]
    if wrong:
        raise ValueError("input does not fit the model: " + ", ".join(
            f"{f.column} {f.verdict} (saved {f.saved}, given {f.given})" for f in wrong))
    types = {f.name: f.dataType for f in saved.fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                       for c in df.columns])


def _fails(column: str, given: T.DataType, to: T.DataType) -> Column:
    """A value is there and the cast has none, or drops a part of it (a fraction, an
    hour). Rounding to a shorter floating type loses nothing in this sense."""
    c = F.col(f"`{column}`")
    lost = c.try_cast(to).isNull()
    if isinstance(given, (T.NumericType, T.TimestampNTZType)) and not isinstance(to, T.FractionalType):
        lost = lost | (c.try_cast(to).try_cast(given) != c)
    return c.isNotNull() & lost


def conform(df: DataFrame, saved: T.StructType, name: str = "conformed") -> tuple[DataFrame, dict[str, int]]:
    """``df`` cast to the saved types, written, and the values lost by column. Missing
    columns raise, since no cast can make them."""
    from ..operators.joins import materialize_observed
    found = compare(saved, df.schema)
    gone = [f.column for f in found if f.verdict == "missing"]
    if gone:
        raise ValueError(f"input lacks {gone}")
    types = {f.name: f.dataType for f in saved.fields}
    cast = [f.column for f in found if f.verdict in ("narrowed", "other")]
    # Lost values are marked beside the rows, so one pass counts and casts.
    marks = [_fails(c, df.schema[c].dataType, types[c]).alias(f"__lost_{i}") for i, c in enumerate(cast)]
    own = [F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    written, seen = materialize_observed(df.select(*own, *marks), name,
                                         **{f"lost_{i}": F.col(f"__lost_{i}") for i in range(len(cast))})
    return (written.drop(*[f"__lost_{i}" for i in range(len(cast))]),
            {c: seen[f"lost_{i}"] for i, c in enumerate(cast)})
