"""Readers and writers (scan with explicit schema, schema enforcement, feature hand-off)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import SCHEMAS


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "csv", columns: list[str] | None = None) -> DataFrame:
    """Scan one input and project ``columns`` with the types of ``schema``.

    CSV columns are matched by header *name* (files may hold more columns, in any
    order): the header line alone is read first, and the scan gets the saved types in
    the header's order (unknown columns as strings), so filters on typed columns reach
    it. Parquet is read as stored and cast the same way.
    """
    cols = columns or schema.fieldNames()
    if fmt == "csv":
        names = spark.read.option("header", True).csv(path).columns
        types = {f.name: f.dataType for f in schema.fields}
        typed = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        df = spark.read.schema(typed).option("header", True).option("mode", "FAILFAST").csv(path)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return enforce_schema(df, schema, cols)


def enforce_schema(df: DataFrame, schema: T.StructType,
                   columns: list[str] | None = None) -> DataFrame:
    """Project ``columns`` and cast each to the saved type (one ``select``)."""
    cols = columns or schema.fieldNames()
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types
                       else F.col(f"`{c}`") for c in cols])


def read_input(spark: SparkSession, root: str, name: str, fmt: str = "csv",
               columns: list[str] | None = None) -> DataFrame:
    from .schemas import FILE_NAMES
    ext = "csv" if fmt == "csv" else "parquet"
    path = os.path.join(root, f"{FILE_NAMES[name]}.{ext}")
    return read_table(spark, path, SCHEMAS[name], fmt, columns)


def write_features(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write the feature table (Parquet by default; CSV keeps the reference's hand-off)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def read_features(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = None) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("CSV features need the schema they were written with")
    return spark.read.schema(schema).option("header", True).csv(path)
