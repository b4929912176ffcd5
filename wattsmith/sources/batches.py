"""New batches that arrive as CSV: readable rows go on, unreadable lines are set aside.

``readers.read_table`` ends the job at the first bad line, which is right for a file
of our own. A batch from outside is scanned permissively: a line with too few or too
many fields, or with a value that is not of its column's type, becomes a row of the
reject table with its file and whole text. One pass over the files parses, counts and
writes both; what follows reads the written rows.

Columns are matched by the first file's header; further columns are read as text and
dropped after the check. A file with another header is refused by the scan, not misread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import enforce_schema

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Batch:
    rows: DataFrame      # the readable rows, with the asked columns
    rejects: DataFrame   # file, record
    n_rows: int
    n_rejects: int

    def refuse_above(self, share: float) -> "Batch":
        """Itself, unless more than ``share`` of its lines were rejected."""
        total = self.n_rows + self.n_rejects
        if self.n_rejects > share * total:
            first = self.rejects.limit(1).collect()[0]
            raise ValueError(f"{self.n_rejects} of {total} lines cannot be read, e.g. {first.record!r} in {first.file}")
        return self


def scan_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The permissive scan: every column of the files, the text of a bad line in
    ``CORRUPT`` and the file in ``_file``. Pruning is off in the parser, since a
    line's fields can only be counted if all are parsed."""
    names = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in schema.fields}
    typed = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names]
                         + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(typed).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False).csv(path).withColumn("_file", F.col("_metadata.file_path")))


def read_batch(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> Batch:
    """Read the CSV file or folder at ``path``; see the module's text."""
    from ..operators.joins import materialize_observed
    bad = F.col(CORRUPT).isNotNull()
    written, seen = materialize_observed(scan_batch(spark, path, schema), "batch", rejects=bad)
    rows = enforce_schema(written.filter(~bad), schema, columns)
    rejects = written.filter(bad).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record"))
    return Batch(rows, rejects, seen["n"] - seen["rejects"], seen["rejects"])
