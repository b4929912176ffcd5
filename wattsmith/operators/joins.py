"""Join helpers: hour shifts, collision suffixes and size-checked broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Broadcast budget for a materialised side. A side goes out as a broadcast only
# when its counted rows times its width stay under this; otherwise the join stays
# a shuffle (sort-merge) join. Override per session with BUDGET_CONF.
BROADCAST_BUDGET_BYTES = 128 * 1024 * 1024
BUDGET_CONF = "wattsmith.broadcastBudgetBytes"


def broadcast_budget(spark) -> int:
    v = spark.conf.get(BUDGET_CONF, None)
    return int(v) if v else BROADCAST_BUDGET_BYTES


def shift_hours(df: DataFrame, hours: int, col: str = "datetime") -> DataFrame:
    """Move ``col`` forward by ``hours`` (wall clock: the column is TIMESTAMP_NTZ)."""
    if hours == 0:
        return df
    return df.withColumn(col, F.col(col) + F.make_dt_interval(F.lit(0), F.lit(hours)))


def suffix_collisions(left_cols: list[str], right: DataFrame, on: list[str],
                      suffix: str) -> DataFrame:
    """Rename right columns whose names already exist on the left (keys excluded)."""
    taken = set(left_cols)
    renames = {c: f"{c}{suffix}" for c in right.columns if c not in on and c in taken}
    return right.withColumnsRenamed(renames) if renames else right


def left_join(left: DataFrame, right: DataFrame, on: list[str], suffix: str = "_right") -> DataFrame:
    """Left equi-join on same-named keys; right columns that collide get ``suffix``."""
    right = suffix_collisions(left.columns, right, on, suffix)
    return left.join(right, on=on, how="left")


_FIXED = {"boolean", "byte", "short", "integer", "float", "date", "long", "double",
          "timestamp", "timestamp_ntz"}


def row_width_bytes(df: DataFrame) -> int:
    """Bytes per row as a broadcast hash relation holds it: an UnsafeRow slot of 8
    bytes per field plus a 16-byte header and hash entry; strings and nested
    values are counted at 32 extra bytes."""
    return 16 + sum(8 if f.dataType.typeName() in _FIXED else 40 for f in df.schema.fields)


def scratch_root(spark) -> str:
    from ..session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/") + "/wattsmith-tables"


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark) -> None:
    """Delete every table this package materialised for the session's checkpoint
    folder. Call only after the results that read them have been written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def materialize(df: DataFrame, name: str = "side") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder; return the reread.

    Used for small derived tables (weather means, sums, snapshots) that several
    joins reuse: they are computed once in one job, their lineage is cut (a lost
    executor re-reads the files instead of re-aggregating the weather), and the
    reread carries real size statistics.
    """
    return materialize_counted(df, name)[0]


def materialize_counted(df: DataFrame, name: str = "side") -> tuple[DataFrame, int]:
    """``materialize`` that also returns the row count, observed during the write
    itself (no second job)."""
    out, counts = materialize_observed(df, name)
    return out, counts["n"]


def materialize_observed(df: DataFrame, name: str = "side", **counts) -> tuple[DataFrame, dict]:
    """``materialize`` that also returns the row count ``n`` and, by name, how many
    rows satisfy each condition in ``counts``."""
    from pyspark.sql import Observation
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    seen = [F.count_if(c).alias(k) for k, c in counts.items()]
    df.observe(obs, F.count(F.lit(1)).alias("n"), *seen).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), {k: int(v) for k, v in obs.get.items()}


def maybe_broadcast(df: DataFrame, ok: bool) -> DataFrame:
    """Apply the broadcast hint right at the join input (after any shift/rename)."""
    return F.broadcast(df) if ok else df


class SmallSide:
    """A materialised join side, its row count, and the broadcast decision.

    ``derive`` makes a side from this one (a filter, a projection, a shift) with its
    own row count, so its decision is its own and needs no further job. ``counts``
    names conditions to count while the side is written (see ``counted``).
    """

    def __init__(self, df: DataFrame, budget_bytes: int | None = None,
                 materialized: bool = False, rows: int | None = None, name: str = "side",
                 counts: dict | None = None):
        self.counted: dict = {}
        if materialized:
            self.df = df
        else:
            self.df, self.counted = materialize_observed(df, name, **(counts or {}))
            rows = self.counted["n"] if rows is None else rows
        self.budget_bytes = budget_bytes or broadcast_budget(df.sparkSession)
        # Over written Parquet files a count reads footers, not column data.
        self.rows = self.df.count() if rows is None else rows
        self.broadcast = self.rows * row_width_bytes(self.df) <= self.budget_bytes

    def derive(self, fn, rows: int | None = None) -> "SmallSide":
        """The side ``fn`` makes of this one; ``rows``: its row count (default: no more
        than this one's)."""
        return SmallSide(fn(self.df), self.budget_bytes, materialized=True,
                         rows=self.rows if rows is None else rows)

    def side(self, transform=None) -> DataFrame:
        df = transform(self.df) if transform else self.df
        return maybe_broadcast(df, self.broadcast)
