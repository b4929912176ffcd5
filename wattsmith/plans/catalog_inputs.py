"""Registered queries about what comes in: CSV scans at full width, new batches with
rejects, the model's input signature, holiday rules, missing flags and sketches. Each
with its DuckDB SQL; views, batches and rounding as in ``catalog`` and ``oracle``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bins
from ..operators.joins import materialize, scratch_path
from ..functions import holidays as hol
from ..sources import fixtures as fx
from ..sources import schemas as S
from ..sources.batches import read_batch
from ..sources.readers import read_input
from . import catalog as cat
from . import oracle as ora
from .signature import compare, conform

COLUMNS = {
    "client": S.CLIENT_COLS, "gas_prices": S.GAS_PRICES_COLS,
    "electricity_prices": S.ELECTRICITY_PRICES_COLS, "forecast_weather": S.FORECAST_WEATHER_COLS,
    "historical_weather": S.HISTORICAL_WEATHER_COLS, "target": S.TARGET_COLS,
    "weather_station_to_county_mapping": S.LOCATION_COLS,
}
# Measures the weather views lack, in file order: each is the temperature plus its place.
_LACKING = {
    "forecast_weather": [c for c in S.FORECAST_WEATHER_COLS
                         if c not in ("latitude", "longitude", "hours_ahead", "forecast_datetime",
                                      *cat._MEASURES["forecast_weather"])],
    "historical_weather": [c for c in S.HISTORICAL_WEATHER_COLS
                           if c not in ("latitude", "longitude", "datetime", *cat._MEASURES["historical_weather"])],
}
_SQL_VIEW = {"weather_station_to_county_mapping": "station_map", "target": "hist"}


def whole_view(spark, sf, name: str) -> DataFrame:
    """A view with every column of its file."""
    view = fx.station_map if name == "weather_station_to_county_mapping" else cat._VIEWS[name]
    extra = {c: F.col("temperature") + F.lit(i + 1) for i, c in enumerate(_LACKING.get(name, []))}
    return view(spark, sf).withColumns(extra).select(*[F.col(f"`{c}`") for c in COLUMNS[name]])


def _whole_sql(name: str) -> str:
    extra = "".join(f', temperature + {i + 1} AS "{c}"' for i, c in enumerate(_LACKING.get(name, [])))
    return f"SELECT *{extra} FROM {_SQL_VIEW.get(name, name)}"


def _is_double(name: str, c: str) -> bool:
    return isinstance(S.SCHEMAS[name][c].dataType, T.DoubleType)


def _shown(df: DataFrame) -> DataFrame:
    """Whole numbers as DOUBLE and dates as timestamps, since both may be NULL here."""
    ints = tuple(f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegerType))
    return cat.presented(cat.rounded(df), ints)


def _shown_sql(name: str, c: str, bump: int = 0) -> str:
    q = f'"{c}"'
    if c in ("latitude", "longitude"):
        return f"round(CAST({q} AS DOUBLE), 1) AS {q}"
    if _is_double(name, c):
        return f"{ora.rnd(f'{q} + {bump}' if bump else q)} AS {q}"
    if isinstance(S.SCHEMAS[name][c].dataType, T.IntegerType):
        return f"CAST({q} + {bump} AS DOUBLE) AS {q}"
    return f"CAST({q} AS TIMESTAMP) AS {q}"


# --- S2-S7: every input as a CSV file, scanned by its schema --------------------------

def _scan_csv(name):
    def q(spark, sf):
        root = scratch_path(spark, "csv")
        whole_view(spark, sf, name).write.option("header", True).csv(f"{root}/{S.FILE_NAMES[name]}.csv")
        return _shown(read_input(spark, root, name, "csv", COLUMNS[name]))
    q.__doc__ = f"The {name} file written as CSV and scanned with its column list and types."
    return q


def _scan_csv_sql(name):
    cols = ", ".join(_shown_sql(name, c) for c in COLUMNS[name])
    return ora.with_ctes(f"SELECT {cols} FROM whole", {"whole": _whole_sql(name)})


# --- S8: a new batch as CSV, with lines that cannot be read -----------------------------

def _bad_measure(name):
    return cat._MEASURES[name][0]


def _key_text(c):
    return F.round(F.col(c) * 10).cast("int").cast("string") if c in ("latitude", "longitude") else F.col(c).cast("string")


def write_batch_csv(spark, sf, name: str, path: str) -> None:
    """The new half of a view as CSV with a further column ``origin`` (its key) in
    front. On days of the month 1 more than a multiple of five a measure is no number; on
    the next day lines lack their last field."""
    cols = COLUMNS[name]
    measures = cat._MEASURES[name] + _LACKING.get(name, [])
    _, new = fx.split_batches(whole_view(spark, sf, name), cat._TIME[name], measures)
    day = F.dayofmonth(F.col(cat._TIME[name])) % 5
    fields = [F.concat_ws("|", *[_key_text(k) for k in S.UPDATE_KEYS[name]])]
    for c in cols:
        text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        fields.append(F.when(day == 1, "n/a").otherwise(text) if c == _bad_measure(name) else text)
    line = F.when(day == 2, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *fields))
    # One text column whose name is the header line: no separator, no quotes.
    (new.select(line.alias(",".join(["origin", *cols]))).write.option("header", True)
     .option("sep", "\u0001").option("quote", "\u0000").csv(path))


def _new_batch(name):
    def q(spark, sf):
        path = scratch_path(spark, "batch-csv")
        write_batch_csv(spark, sf, name, path)
        batch = read_batch(spark, path, S.SCHEMAS[name], COLUMNS[name])
        good = _shown(batch.rows).withColumn("rejected", F.lit(None).cast("string"))
        bad = batch.rejects.select(F.split("record", ",")[0].alias("rejected"))
        return good.unionByName(bad, allowMissingColumns=True).withColumns(
            {"n_rows": F.lit(batch.n_rows).cast("bigint"), "n_rejects": F.lit(batch.n_rejects).cast("bigint")})
    q.__doc__ = f"The readable rows of a new {name} batch, its rejected lines by origin, and both counts."
    return q


def _new_batch_sql(name):
    time, bumped = cat._TIME[name], set(cat._MEASURES[name] + _LACKING.get(name, []))
    keys = " || '|' || ".join(f"CAST(CAST(round({k} * 10) AS INT) AS VARCHAR)" if k in ("latitude", "longitude")
                              else f"CAST({k} AS VARCHAR)" for k in S.UPDATE_KEYS[name])
    good = ", ".join(_shown_sql(name, c, 1000 if c in bumped else 0) for c in COLUMNS[name])
    null = ", ".join(f'NULL AS "{c}"' for c in COLUMNS[name])
    body = f"""SELECT *, (SELECT count(*) FROM fresh WHERE bad = 0) AS n_rows,
  (SELECT count(*) FROM fresh WHERE bad = 1) AS n_rejects
FROM (SELECT {good}, NULL AS rejected FROM fresh WHERE bad = 0
      UNION ALL SELECT {null}, {keys} AS rejected FROM fresh WHERE bad = 1)"""
    fresh = (f"SELECT *, CASE WHEN day({time}) % 5 IN (1, 2) THEN 1 ELSE 0 END AS bad FROM whole "
             f"WHERE CAST({time} AS TIMESTAMP) >= TIMESTAMP '{fx.CUT_NEW}'")
    return ora.with_ctes(body, {"whole": _whole_sql(name), "fresh": fresh})


# --- S16: the saved signature against a table of other types ----------------------------

def signature_check(spark, sf):
    """The client table in other types, compared with the saved ones: a verdict for each
    column and the values its cast to the saved type loses."""
    day = F.dayofmonth("date")
    given = fx.client(spark, sf).select(
        "date", F.col("county").cast("smallint").alias("county"),
        (F.col("product_type").cast("bigint") + F.when(day % 7 == 0, 3000000000).otherwise(0)).alias("product_type"),
        F.when(day % 5 == 1, "n/a").otherwise(F.col("eic_count").cast("string")).alias("eic_count"),
        F.col("installed_capacity").cast("float").alias("installed_capacity"), F.lit("x").alias("origin"))
    saved = S.SCHEMAS["client"]
    found = compare(saved, given.schema)
    _, lost = conform(given, T.StructType([f for f in saved.fields if f.name in given.columns]))
    return spark.createDataFrame([(f.column, f.saved, f.given, f.verdict, lost.get(f.column, 0)) for f in found],
                                 "column string, saved string, given string, verdict string, n_lost bigint")


_SIGNATURE_SQL = """SELECT * FROM (VALUES ('product_type', 'int', 'bigint', 'narrowed'), ('county', 'int', 'smallint', 'widened'),
  ('eic_count', 'int', 'string', 'other'), ('installed_capacity', 'double', 'float', 'widened'),
  ('is_business', 'int', NULL, 'missing'), ('date', 'date', 'date', 'same'), ('origin', NULL, 'string', 'extra'))
  AS v("column", saved, given, verdict)"""


# --- J12, F19: holidays by rules ---------------------------------------------------------

_AROUND = 5  # years before and after those of the data


def _years(spark, sf):
    y = F.year("datetime")
    return cat._base(spark, sf).select(F.explode(F.sequence(y - _AROUND, y + _AROUND)).alias("year")).distinct()


def holiday_rules(spark, sf):
    """Every holiday of three countries in the data's years and five around them."""
    years = materialize(_years(spark, sf), "years")
    out = [hol.holiday_table(years, rules).select(F.lit(c).alias("country"), F.col("date").cast("timestamp_ntz").alias("date"))
           for c, rules in sorted(hol.RULES.items())]
    return out[0].unionByName(out[1]).unionByName(out[2])


def holiday_rules_flag(spark, sf):
    """The flag of each row by each country's rules, as expressions."""
    day = F.col("datetime").cast("date")
    return cat._base(spark, sf).select("row_id", *[hol.is_holiday(day, r).alias(f"is_holiday_{c.lower()}")
                                                   for c, r in sorted(hol.RULES.items())])


def _after(m: int, d: int, weekday: int) -> str:
    first = f"make_date(y, {m}, {d})"
    return f"({first} + CAST(({weekday} - isodow({first}) + 7) % 7 AS INT))"


def _nearest(m: int, d: int) -> str:
    date = f"make_date(y, {m}, {d})"
    return f"CASE isodow({date}) WHEN 6 THEN {date} - 1 WHEN 7 THEN {date} + 1 ELSE {date} END"


def _holiday_ctes() -> dict:
    day = lambda m, d: f"make_date(y, {m}, {d})"
    ee = [day(1, 1), day(2, 24), day(5, 1), day(6, 23), day(6, 24), f"CASE WHEN y >= 1998 THEN {day(8, 20)} END",
          f"CASE WHEN y >= 2005 THEN {day(12, 24)} END", day(12, 25), day(12, 26), "e - 2", "e", "e + 49"]
    fi = [day(1, 1), day(1, 6), "e - 2", "e", "e + 1", day(5, 1), "e + 39", "e + 49", _after(6, 20, 6),
          _after(10, 31, 6), day(12, 6), day(12, 25), day(12, 26)]
    us = [_nearest(1, 1), f"CASE WHEN y >= 1986 THEN {_after(1, 15, 1)} END", _after(2, 15, 1), _after(5, 25, 1),
          f"CASE WHEN y >= 2021 THEN {_nearest(6, 19)} END", _nearest(7, 4), _after(9, 1, 1), _after(10, 8, 1),
          _nearest(11, 11), _after(11, 22, 4), _nearest(12, 25)]
    lists = " UNION ALL ".join(f"SELECT '{c}' AS country, unnest([{', '.join(d)}]) AS date FROM sundays"
                               for c, d in (("EE", ee), ("FI", fi), ("US", us)))
    return {
        # a year more on either side: a shifted New Year's Day lies in the year before
        "years": f"SELECT DISTINCT CAST(year(datetime) + o AS INT) AS y FROM base, range(-{_AROUND + 1}, {_AROUND + 2}) t(o)",
        "moons": """SELECT y, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - y % 19) // 11)) AS i, y // 100 AS c
FROM (SELECT y, (y // 100 - y // 400 - (8 * (y // 100) + 13) // 25 + 19 * (y % 19) + 15) % 30 AS h FROM years)""",
        "sundays": """SELECT y, make_date(y, CAST(3 + (l + 40) // 44 AS INT), CAST(l + 28 - 31 * ((3 + (l + 40) // 44) // 4) AS INT)) AS e
FROM (SELECT y, i - (y + y // 4 + i + 2 - c + c // 4) % 7 AS l FROM moons)""",
        "by_rule": lists,
        "days_off": """SELECT DISTINCT country, date FROM by_rule WHERE date IS NOT NULL
  AND year(date) BETWEEN (SELECT min(y) + 1 FROM years) AND (SELECT max(y) - 1 FROM years)""",
    }


# --- M1: missing flags and sketches -------------------------------------------------------

def _inputs(spark, sf):
    from .training import feature_columns
    df = cat._model_rows(spark, sf)
    return df, [c for c in feature_columns(df) if c != "segment"]


def assemble_flags(spark, sf):
    """The missing flag of every numeric model input."""
    df, features = _inputs(spark, sf)
    return df.select("row_id", *[bins.missing_flag(c).cast("int").alias(f"{c}__m") for c in features])


def feature_sketches(spark, sf):
    """Rows and missing values of each model input, from sketches of two parts of
    the table merged; and the rows the sketch itself counts."""
    df, features = _inputs(spark, sf)
    half = F.col("row_id") % 2 == 0
    parts = bins.sketches(df.filter(half), features).unionByName(bins.sketches(df.filter(~half), features))
    return bins.merge_sketches(parts).select("feature", "n", "n_missing",
                                             F.kll_sketch_get_n_double("sketch").alias("n_sketched"))


def _numeric_features():
    return [c for c in ora._feature_columns() if c not in ("target", "row_id", "segment")]


def _flags_sql():
    cols = ", ".join(f'CAST("{c}" IS NULL AS INT) AS "{c}__m"' for c in _numeric_features())
    return f"WITH feats AS ({ora.features_sql(False)}) SELECT row_id, {cols} FROM feats"


def _sketches_sql():
    each = " UNION ALL ".join(f"""SELECT '{c}' AS feature, count("{c}") AS n, count(*) - count("{c}") AS n_missing,
  count("{c}") AS n_sketched FROM feats""" for c in _numeric_features())
    return f"WITH feats AS ({ora.features_sql(False)}) {each}"


_BATCHES = ["client", "gas_prices", "electricity_prices", "forecast_weather", "historical_weather", "target"]
_SCANS = ["client", "gas_prices", "electricity_prices", "forecast_weather", "historical_weather",
          "weather_station_to_county_mapping"]


def registry() -> dict:
    out = {f"scan_{n}_csv": _scan_csv(n) for n in _SCANS} | {f"new_batch_{n}": _new_batch(n) for n in _BATCHES}
    return out | {"signature_check": signature_check, "holiday_rules": holiday_rules,
                  "holiday_rules_flag": holiday_rules_flag, "assemble_flags": assemble_flags,
                  "feature_sketches": feature_sketches}


def oracle_sql() -> dict[str, str]:
    out = {f"scan_{n}_csv": _scan_csv_sql(n) for n in _SCANS} | {f"new_batch_{n}": _new_batch_sql(n) for n in _BATCHES}
    flags = ", ".join(f"CAST(datetime AS DATE) IN (SELECT date FROM days_off WHERE country = '{c}') AS is_holiday_{c.lower()}"
                      for c in ("EE", "FI", "US"))
    return out | {
        "signature_check": ora.with_ctes(f"""SELECT *, CASE "column"
  WHEN 'product_type' THEN (SELECT count(*) FROM client WHERE day(date) % 7 = 0)
  WHEN 'eic_count' THEN (SELECT count(*) FROM client WHERE day(date) % 5 = 1) ELSE 0 END AS n_lost
FROM ({_SIGNATURE_SQL})"""),
        "holiday_rules": ora.with_ctes("SELECT country, CAST(date AS TIMESTAMP) AS date FROM days_off", _holiday_ctes()),
        "holiday_rules_flag": ora.with_ctes(f"SELECT row_id, {flags} FROM base", _holiday_ctes()),
        "assemble_flags": _flags_sql(), "feature_sketches": _sketches_sql(),
    }
