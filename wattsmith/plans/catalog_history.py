"""Registered queries over the bucketed history, and order-free sums compared with
DuckDB without rounding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history as hist
from ..operators import target as tgt
from ..operators import weather as wx
from ..sources import fixtures as fx
from . import catalog as cat
from . import oracle as ora

_STEP = "268435456e0"


def history_bucketed_lags(spark, sf):
    """The 13 lags read from the bucketed history, without an exchange."""
    rows = fx.energy(spark, sf).select("row_id", *tgt.SEGMENT_TIME_KEYS, "target")
    out = hist.history_lags(spark, hist.write_history(rows))
    return cat.rounded(out.select("row_id", *cat._lag_cols(out, "target", tgt.TARGET_LAGS)))


def history_bucketed_upsert(spark, sf):
    """A batch merged into the bucketed history: the table is not shuffled."""
    old, new = fx.split_batches(cat._history(spark, sf), "datetime", ["target"])
    table = hist.write_history(old)
    return cat.rounded(hist.read_history(spark, hist.upsert_history(spark, table, new)))


def _raw(spark, sf):
    """The events as weather rows: a third of the stations have no county."""
    county = F.when(F.col("station") < 18, F.col("county"))
    return fx.base_events(spark, sf).select("datetime", county.alias("county"), (F.col("value") / 3).alias("third"),
                                            (F.col("value") * 1e-9).alias("small"))


def exact_hourly_means(spark, sf):
    return cat.presented(wx.hourly_means(_raw(spark, sf)), ("county",))


def exact_type_sums(spark, sf):
    rows = fx.base_events(spark, sf).withColumn("target", F.col("value") / 7)
    return tgt.type_sum(rows.select(*tgt.SEGMENT_TIME_KEYS, "target"))


def _exact_sum_sql(x: str) -> str:
    """``operators.sums.exact_sum`` of an expression without NULLs below 2**56."""
    p0 = f"trunc(({x}) / {_STEP})"
    r1 = f"(({x}) - {p0} * {_STEP})"
    r2 = f"(({r1} - trunc({r1})) * {_STEP})"
    p3 = f"trunc(({r2} - trunc({r2})) * {_STEP})"
    total = [f"CAST(sum(CAST({p} AS BIGINT)) AS DOUBLE)" for p in (p0, f"trunc({r1})", f"trunc({r2})", p3)]
    return f"((({total[3]} / {_STEP} + {total[2]}) / {_STEP} + {total[1]}) + {total[0]} * {_STEP})"


def _means_sql():
    means = ", ".join(f"{_exact_sum_sql(m)} / count(*) AS {m}" for m in ("third", "small"))
    return ora.with_ctes(f"""SELECT CAST(NULL AS DOUBLE) AS county, datetime, {means}, CAST(1 AS TINYINT) AS level
FROM raw GROUP BY datetime UNION ALL
SELECT CAST(county AS DOUBLE), datetime, {means}, CAST(0 AS TINYINT) FROM raw WHERE county IS NOT NULL GROUP BY county, datetime""", {
        "raw": """SELECT datetime, CASE WHEN station < 18 THEN county END AS county, value / 3e0 AS third,
  value * 1e-9 AS small FROM base_events"""})


def registry() -> dict:
    return {"history_bucketed_lags": history_bucketed_lags, "history_bucketed_upsert": history_bucketed_upsert,
            "exact_hourly_means": exact_hourly_means, "exact_type_sums": exact_type_sums}


def oracle_sql() -> dict[str, str]:
    return {"history_bucketed_lags": ora.target_lags_sql(), "history_bucketed_upsert": ora.update_sql("target"),
            "exact_hourly_means": _means_sql(),
            "exact_type_sums": ora.with_ctes(f"""SELECT county, is_business, is_consumption, datetime,
{_exact_sum_sql('value / 7e0')} AS target FROM base_events GROUP BY ALL""")}
