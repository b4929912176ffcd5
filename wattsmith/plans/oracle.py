"""DuckDB SQL for each registered query (the correctness oracle).

Only the driver's base tables are registered in DuckDB, so every statement inlines
the fixture views as CTEs. DOUBLE results are rounded to 6 decimals like the Spark
side.
"""

from __future__ import annotations

from ..operators import target as tgt
from ..operators import weather as wx

LATLON = ("CAST(57.6 + 0.3 * (station % 8) AS FLOAT) AS latitude, "
          "CAST(21.7 + 0.5 * floor(station / 8) AS FLOAT) AS longitude")

FIXTURE_CTES = {
    "base_events": """SELECT event_id, ts, user_id, value,
  CAST(date_trunc('hour', ts) AS TIMESTAMP) AS datetime, CAST(ts AS DATE) AS date,
  CAST(user_id % 3 AS INT) AS county,
  CASE WHEN event_type IN ('purchase','signup') THEN 1 ELSE 0 END AS is_business,
  CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
                  WHEN 'signup' THEN 3 ELSE 4 END AS product_type,
  CAST(event_id % 2 AS INT) AS is_consumption,
  CAST(user_id % 24 AS INT) AS station, CAST(event_id % 48 AS INT) + 1 AS hours_ahead
FROM events""",
    "energy": """SELECT datetime, county, is_business, product_type, is_consumption,
  min(event_id) AS row_id,
  CASE WHEN min(event_id) % 50 = 0 THEN NULL ELSE sum(value) END AS target
FROM base_events GROUP BY datetime, county, is_business, product_type, is_consumption""",
    "client": """SELECT date, county, is_business, product_type,
  CAST(count(DISTINCT user_id) AS INT) AS eic_count, sum(value) AS installed_capacity
FROM base_events GROUP BY date, county, is_business, product_type""",
    "station_map": f"""SELECT DISTINCT {LATLON},
  CAST(CASE WHEN station < 18 THEN station % 3 END AS INT) AS county FROM base_events""",
    "historical_weather": f"""SELECT datetime, {LATLON}, avg(value) AS temperature,
  max(value) AS rain, min(value) AS snowfall, CAST(count(*) AS DOUBLE) AS surface_pressure
FROM base_events GROUP BY datetime, station""",
    "forecast_weather": f"""SELECT datetime AS forecast_datetime, {LATLON}, hours_ahead,
  avg(value) AS temperature, max(value) AS dewpoint, min(value) AS snowfall
FROM base_events GROUP BY datetime, station, hours_ahead""",
    "gas_prices": """SELECT date AS forecast_date, min(value) AS lowest_price_per_mwh,
  max(value) AS highest_price_per_mwh FROM base_events GROUP BY date""",
    "electricity_prices": """SELECT datetime AS forecast_date, avg(value) AS euros_per_mwh
FROM base_events GROUP BY datetime""",
}

FORECAST_MEASURES = ["temperature", "dewpoint", "snowfall"]
HISTORICAL_MEASURES = ["temperature", "rain", "snowfall", "surface_pressure"]


def rnd(expr: str) -> str:
    """6-decimal rounding through DECIMAL(38,10), exactly as the Spark side does it
    (both engines then break decimal ties the same way; no negative zero)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 10)), 6) AS DOUBLE)"


def R(expr: str, alias: str) -> str:
    return f"{rnd(expr)} AS {alias}"


def q(name):
    return f'"{name}"'


def iv(h: int) -> str:
    return f"INTERVAL {h} HOUR"


# Derived CTEs shared by several statements (each may name fixture CTEs it uses).
def _fw(horizon=True):
    cond = "f.hours_ahead BETWEEN 22 AND 45" if horizon else "f.hours_ahead IS NOT NULL"
    ms = ", ".join(f"f.{m}" for m in FORECAST_MEASURES)
    return f"""SELECT f.forecast_datetime AS datetime, {ms}, s.county
FROM forecast_weather f LEFT JOIN station_map s
  ON CAST(f.longitude AS FLOAT) = s.longitude AND CAST(f.latitude AS FLOAT) = s.latitude
WHERE {cond}"""


def _hw():
    ms = ", ".join(f"h.{m}" for m in HISTORICAL_MEASURES)
    return f"""SELECT h.datetime, {ms}, s.county
FROM historical_weather h LEFT JOIN station_map s
  ON CAST(h.longitude AS FLOAT) = s.longitude AND CAST(h.latitude AS FLOAT) = s.latitude"""


def _gmean(src, ms):
    return f"SELECT datetime, {', '.join(f'avg({m}) AS {m}' for m in ms)} FROM {src} GROUP BY datetime"


def _lmean(src, ms):
    return (f"SELECT county, datetime, {', '.join(f'avg({m}) AS {m}' for m in ms)} FROM {src} "
            f"WHERE county IS NOT NULL GROUP BY county, datetime")


DERIVED = {
    "fw": _fw(True), "fw_all": _fw(False), "hw": _hw(),
    "fg": _gmean("fw", FORECAST_MEASURES), "fl": _lmean("fw", FORECAST_MEASURES),
    "hg": _gmean("hw", HISTORICAL_MEASURES), "hl": _lmean("hw", HISTORICAL_MEASURES),
    "hist": "SELECT target, county, is_business, product_type, is_consumption, datetime FROM energy",
    "tsum": """SELECT datetime, county, is_business, is_consumption,
  coalesce(sum(target), 0.0) AS target FROM hist
GROUP BY datetime, county, is_business, is_consumption""",
    "ctsum": """SELECT datetime, is_business, is_consumption,
  coalesce(sum(target), 0.0) AS target FROM hist GROUP BY datetime, is_business, is_consumption""",
    "base": "SELECT row_id, datetime, county, is_business, product_type, is_consumption FROM energy",
}

_ORDER = ["base_events", "energy", "client", "station_map", "historical_weather",
          "forecast_weather", "gas_prices", "electricity_prices", "fw", "fw_all", "hw",
          "fg", "fl", "hg", "hl", "hist", "tsum", "ctsum", "base"]


def with_ctes(body: str, extra: dict | None = None) -> str:
    """Prefix ``body`` with every known CTE it (transitively) mentions."""
    import re
    defs = dict(FIXTURE_CTES)
    defs.update(DERIVED)
    extra = extra or {}
    order = _ORDER + [k for k in extra if k not in _ORDER]
    defs.update(extra)
    needed: set[str] = set()

    def visit(text):
        for name in defs:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(defs[name])
    visit(body)
    ctes = [f"{n} AS ({defs[n]})" for n in order if n in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


# --- weather lag joins -----------------------------------------------------

def _steps():
    """(kind, lag, measures, suffix, morning) for every weather join, in build order."""
    out = []
    for h in wx.FORECAST_LAGS:
        out.append(("fg", h, FORECAST_MEASURES, f"_forecast_{h}h", False))
        out.append(("fl", h, FORECAST_MEASURES, f"_forecast_local_{h}h", False))
    for h in wx.HISTORICAL_LAGS:
        out.append(("hg", h, HISTORICAL_MEASURES, f"_historical_{h}h", False))
        out.append(("hl", h, HISTORICAL_MEASURES, f"_historical_local_{h}h", False))
    h = wx.HISTORICAL_MORNING_LAG
    out.append(("hg", h, HISTORICAL_MEASURES, f"_historical_{h}h", True))
    return out


def _resolve(steps):
    """Output names, resolved the way collision suffixes work: a right column is
    suffixed only if its name is already taken on the left."""
    taken = {"row_id", "datetime", "county", "is_business", "product_type", "is_consumption"}
    plan = []
    for kind, h, ms, sfx, morning in steps:
        names = {m: (m + sfx if m in taken else m) for m in ms}
        taken |= set(names.values())
        plan.append((kind, h, names, morning))
    return plan


def _weather_join_sql(plan, round_out=True):
    joins, cols = [], []
    for i, (kind, h, names, morning) in enumerate(plan):
        a = f"w{i}"
        local = kind in ("fl", "hl")
        sel = ", ".join([f"datetime + {iv(h)} AS datetime"] + (["county"] if local else [])
                        + list(names))
        where = f" WHERE hour(datetime + {iv(h)}) <= 10" if morning else ""
        on = f"b.datetime = {a}.datetime" + (f" AND b.county = {a}.county" if local else "")
        joins.append(f"LEFT JOIN (SELECT {sel} FROM {kind}{where}) {a} ON {on}")
        for m, out in names.items():
            cols.append(R(f"{a}.{m}", q(out)) if round_out
                        else f"CAST({a}.{m} AS FLOAT) AS {q(out)}")
    return joins, cols


def weather_sql(kinds, lags, morning=False):
    steps = [s for s in _steps() if s[0] in kinds and s[1] in lags and s[4] == morning]
    joins, cols = _weather_join_sql(_resolve(steps))
    return with_ctes(f"SELECT b.row_id, {', '.join(cols)} FROM base b\n" + "\n".join(joins))


def weather_features_sql():
    joins, cols = _weather_join_sql(_resolve(_steps()))
    return with_ctes(f"SELECT b.row_id, {', '.join(cols)} FROM base b\n" + "\n".join(joins))


# --- target lags ---------------------------------------------------------------

def _lag_joins(prefix, src, keys, lags, base_alias="b", cast=None):
    joins, cols = [], []
    for h in lags:
        a = f"{prefix}{h}"
        on = " AND ".join(f"{base_alias}.{k} = {a}.{k}" for k in keys)
        kk = ", ".join(k for k in keys if k != "datetime")
        joins.append(f"LEFT JOIN (SELECT {kk}, datetime + {iv(h)} AS datetime, target FROM {src}) {a} ON {on}")
        cols.append((f"{a}.target", h))
    return joins, cols


SEG = ["county", "is_business", "product_type", "is_consumption", "datetime"]
TSK = ["county", "is_business", "is_consumption", "datetime"]
CTSK = ["is_business", "is_consumption", "datetime"]


def target_lags_sql():
    joins, cols = _lag_joins("t", "hist", SEG, tgt.TARGET_LAGS)
    sel = ", ".join(R(e, f"target_{h}h") for e, h in cols)
    return with_ctes(f"SELECT b.row_id, {sel} FROM base b\n" + "\n".join(joins))


def sum_lags_sql(src, keys, name):
    joins, cols = _lag_joins("s", src, keys, tgt.SUM_LAGS)
    sel = ", ".join(R(e, f"{name}_{h}h") for e, h in cols)
    return with_ctes(f"SELECT b.row_id, {sel} FROM base b\n" + "\n".join(joins))


def _all_lags_cte():
    """``lagged``: base rows with every target lag and sum lag as DOUBLE."""
    j1, c1 = _lag_joins("t", "hist", SEG, tgt.TARGET_LAGS)
    j2, c2 = _lag_joins("s", "tsum", TSK, tgt.SUM_LAGS)
    j3, c3 = _lag_joins("c", "ctsum", CTSK, tgt.SUM_LAGS)
    cols = ([f"{e} AS target_{h}h" for e, h in c1]
            + [f"{e} AS target_all_type_sum_{h}h" for e, h in c2]
            + [f"{e} AS target_all_county_type_sum_{h}h" for e, h in c3])
    return f"SELECT b.*, {', '.join(cols)} FROM base b\n" + "\n".join(j1 + j2 + j3)


def _stats_exprs():
    xs = [f"target_{h}h" for h in tgt.STATS_LAGS]
    lst = "[" + ", ".join(xs) + "]"
    mean = f"list_avg({lst})"
    std = f"list_stddev_samp({lst})"
    return mean, std


def _ratio_exprs():
    return {f"{p}_ratio_{n}_{d}": f"{p}_{n}h / nullif({p}_{d}h + 0.001, 0)"
            for p, n, d in tgt.RATIOS}


def target_stat_sql(which):
    mean, std = _stats_exprs()
    if which == "mean":
        sel = R(mean, "target_mean")
    elif which == "std":
        sel = R(std, "target_std")
    else:
        sel = ", ".join(R(e, n) for n, e in _ratio_exprs().items())
    return with_ctes(f"SELECT row_id, {sel} FROM lagged", {"lagged": _all_lags_cte()})


# --- full feature table -----------------------------------------------------------

EE_HOLIDAY_SQL = """SELECT DISTINCT d AS date FROM (
  SELECT unnest([make_date(y, 1, 1), make_date(y, 2, 24), make_date(y, 5, 1),
                 make_date(y, 6, 23), make_date(y, 6, 24),
                 CASE WHEN y >= 1998 THEN make_date(y, 8, 20) END,
                 CASE WHEN y >= 2005 THEN make_date(y, 12, 24) END,
                 make_date(y, 12, 25), make_date(y, 12, 26),
                 CAST(easter - INTERVAL 2 DAY AS DATE), easter,
                 CAST(easter + INTERVAL 49 DAY AS DATE)]) AS d
  FROM (SELECT y, make_date(y, CAST((h + l - 7 * m + 114) // 31 AS INT),
                           CAST((h + l - 7 * m + 114) % 31 + 1 AS INT)) AS easter
        FROM (SELECT y, h, l, (a + 11 * h + 22 * l) // 451 AS m
              FROM (SELECT y, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l
                    FROM (SELECT y, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h
                          FROM (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c,
                                       (y // 100) // 4 AS d, (y // 100) % 4 AS e,
                                       ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 AS g,
                                       (y % 100) // 4 AS i, (y % 100) % 4 AS k
                                FROM (SELECT DISTINCT CAST(year(datetime) AS INT) AS y
                                      FROM holiday_rows)))))))
WHERE d IS NOT NULL"""


# The start of the data's last two calendar days.
LAST_DAYS = "(SELECT date_trunc('day', max(datetime)) - INTERVAL 1 DAY FROM energy)"


def features_sql(test: bool = False) -> str:
    """The whole feature table. ``test``: rows of the last two days, no target."""
    rows = ("SELECT row_id, datetime, county, is_business, product_type, is_consumption"
            + ("" if test else ", target") + " FROM energy"
            + (f" WHERE datetime >= {LAST_DAYS}" if test else ""))
    joins, wcols = _weather_join_sql(_resolve(_steps()), round_out=False)
    j1, c1 = _lag_joins("t", "hist", SEG, tgt.TARGET_LAGS)
    j2, c2 = _lag_joins("s", "tsum", TSK, tgt.SUM_LAGS)
    j3, c3 = _lag_joins("c", "ctsum", CTSK, tgt.SUM_LAGS)
    lagcols = ([f"{e} AS target_{h}h" for e, h in c1]
               + [f"{e} AS target_all_type_sum_{h}h" for e, h in c2]
               + [f"{e} AS target_all_county_type_sum_{h}h" for e, h in c3])
    wide = (f"""SELECT b.*, cl.eic_count, CAST(cl.installed_capacity AS FLOAT) AS installed_capacity,
  {', '.join(wcols)}, {', '.join(lagcols)}
FROM base b
LEFT JOIN (SELECT county, is_business, product_type, CAST(date + INTERVAL 2 DAY AS DATE) AS date,
                  eic_count, installed_capacity FROM client) cl
  ON b.county = cl.county AND b.is_business = cl.is_business
 AND b.product_type = cl.product_type AND CAST(b.datetime AS DATE) = cl.date
""" + "\n".join(joins + j1 + j2 + j3))
    mean, std = _stats_exprs()
    lag_names = ([f"target_{h}h" for h in tgt.TARGET_LAGS]
                 + [f"target_all_type_sum_{h}h" for h in tgt.SUM_LAGS]
                 + [f"target_all_county_type_sum_{h}h" for h in tgt.SUM_LAGS])
    ratios = _ratio_exprs()
    wnames = [n for _, _, names, _ in _resolve(_steps()) for n in names.values()]
    target = "" if test else "target, "
    doy = "dayofyear(datetime)"
    hr = "hour(datetime)"
    body = f"""SELECT county, is_business, product_type, is_consumption, {target}row_id,
  CAST(day(datetime) AS INT) AS day, CAST(isodow(datetime) AS INT) AS weekday,
  CAST(month(datetime) AS INT) AS month, CAST(year(datetime) AS INT) AS year,
  CAST(county AS VARCHAR) || '_' || CAST(is_business AS VARCHAR) || '_' ||
    CAST(product_type AS VARCHAR) || '_' || CAST(is_consumption AS VARCHAR) AS segment,
  CAST(sin(pi() * {doy} / 183) AS FLOAT) AS "sin(dayofyear)",
  CAST(cos(pi() * {doy} / 183) AS FLOAT) AS "cos(dayofyear)",
  CAST(sin(pi() * {hr} / 12) AS FLOAT) AS "sin(hour)",
  CAST(cos(pi() * {hr} / 12) AS FLOAT) AS "cos(hour)",
  eic_count, installed_capacity,
  {', '.join(q(n) for n in wnames)},
  {', '.join(f'CAST({n} AS FLOAT) AS {n}' for n in lag_names)},
  CAST({mean} AS FLOAT) AS target_mean, CAST({std} AS FLOAT) AS target_std,
  {', '.join(f'CAST({e} AS FLOAT) AS {n}' for n, e in ratios.items())},
  (CAST(datetime AS DATE) IN (SELECT date FROM holidays)) AS is_holiday
FROM wide""" + ("" if test else " WHERE target IS NOT NULL")
    return with_ctes(body, {"rows": rows, "holiday_rows": rows, "holidays": EE_HOLIDAY_SQL,
                            "base": rows, "wide": wide})


# --- selection, folds, updates -------------------------------------------------

def _feature_columns(test=False):
    """(name, kind) of the feature table's columns, in the order the SQL emits them."""
    wnames = [n for _, _, names, _ in _resolve(_steps()) for n in names.values()]
    lag_names = ([f"target_{h}h" for h in tgt.TARGET_LAGS]
                 + [f"target_all_type_sum_{h}h" for h in tgt.SUM_LAGS]
                 + [f"target_all_county_type_sum_{h}h" for h in tgt.SUM_LAGS])
    cols = ["county", "is_business", "product_type", "is_consumption"]
    if not test:
        cols.append("target")
    cols += ["row_id", "day", "weekday", "month", "year", "segment", "sin(dayofyear)",
             "cos(dayofyear)", "sin(hour)", "cos(hour)", "eic_count", "installed_capacity"]
    cols += wnames + lag_names + ["target_mean", "target_std"] + list(_ratio_exprs())
    cols.append("is_holiday")
    return cols


def _as_double(c):
    if c == "segment":
        return "CAST(replace(segment, '_', '') AS DOUBLE)"
    if c == "is_holiday":
        return "CAST(CAST(is_holiday AS INT) AS DOUBLE)"
    return f"CAST({q(c)} AS DOUBLE)"


def corr_sql(ranked=False, topk=None):
    feats = [c for c in _feature_columns() if c not in ("target", "row_id")]
    items = ", ".join(f"{{'feature': '{c}', 'corr': corr({_as_double(c)}, target)}}"
                      for c in feats)
    body = f"""SELECT s.feature AS feature,
  CASE WHEN isnan(s.corr) THEN NULL ELSE s.corr END AS corr
FROM (SELECT unnest(l) AS s FROM (SELECT [{items}] AS l FROM feats))"""
    stmt = features_sql(False)
    if not ranked:
        return f"WITH feats AS ({stmt}), c AS ({body}) SELECT feature, {rnd('corr')} AS corr FROM c"
    rank = (f"SELECT feature, {rnd('corr')} AS corr, {rnd('abs(corr)')} AS abs_corr, "
            "row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS rank FROM c")
    out = f"WITH feats AS ({stmt}), c AS ({body}), r AS ({rank}) SELECT * FROM r"
    if topk:
        out += f" WHERE rank <= {topk - 1}"
    return out


_RANKED = """SELECT row_id, row_number() OVER (ORDER BY datetime, row_id) - 1 AS pos,
  count(*) OVER () AS n FROM energy WHERE target IS NOT NULL"""
_FOLD_OF = """CAST(CASE WHEN pos < n - 6 * (n // 7) THEN -1
  ELSE (pos - (n - 6 * (n // 7))) // (n // 7) END AS INT)"""


def folds_sql():
    return with_ctes(f"SELECT row_id, {_FOLD_OF} AS fold FROM ranked", {"ranked": _RANKED})


def mae_sql():
    return with_ctes(f"""SELECT f.fold, {rnd('avg(abs(e.target - l.target))')} AS mae, count(*) AS n
FROM energy e JOIN ranked_folds f ON e.row_id = f.row_id
JOIN hist l ON e.county = l.county AND e.is_business = l.is_business
 AND e.product_type = l.product_type AND e.is_consumption = l.is_consumption
 AND e.datetime = l.datetime + INTERVAL 168 HOUR
WHERE e.target IS NOT NULL AND l.target IS NOT NULL GROUP BY f.fold""",
                     {"ranked": _RANKED,
                      "ranked_folds": f"SELECT row_id, {_FOLD_OF} AS fold FROM ranked"})


UPDATE_SPECS = {
    # name: (view, time column, key columns, [(column, type, is_measure)])
    "client": ("client", "date", ["date", "county", "is_business", "product_type"],
               [("date", None, 0), ("county", None, 0), ("is_business", None, 0),
                ("product_type", None, 0), ("eic_count", "INT", 1),
                ("installed_capacity", "DOUBLE", 1)]),
    "gas_prices": ("gas_prices", "forecast_date", ["forecast_date"],
                   [("forecast_date", None, 0), ("lowest_price_per_mwh", "DOUBLE", 1),
                    ("highest_price_per_mwh", "DOUBLE", 1)]),
    "electricity_prices": ("electricity_prices", "forecast_date", ["forecast_date"],
                           [("forecast_date", None, 0), ("euros_per_mwh", "DOUBLE", 1)]),
    "forecast_weather": ("forecast_weather", "forecast_datetime",
                         ["forecast_datetime", "latitude", "longitude", "hours_ahead"],
                         [("forecast_datetime", None, 0), ("latitude", None, 0),
                          ("longitude", None, 0), ("hours_ahead", None, 0),
                          ("temperature", "DOUBLE", 1), ("dewpoint", "DOUBLE", 1),
                          ("snowfall", "DOUBLE", 1)]),
    "historical_weather": ("historical_weather", "datetime", ["datetime", "latitude", "longitude"],
                           [("datetime", None, 0), ("latitude", None, 0), ("longitude", None, 0),
                            ("temperature", "DOUBLE", 1), ("rain", "DOUBLE", 1),
                            ("snowfall", "DOUBLE", 1), ("surface_pressure", "DOUBLE", 1)]),
    "target": ("hist", "datetime", ["datetime", "county", "is_business", "product_type",
                                    "is_consumption"],
               [("target", "DOUBLE", 1), ("county", None, 0), ("is_business", None, 0),
                ("product_type", None, 0), ("is_consumption", None, 0), ("datetime", None, 0)]),
}


def _batches_sql(name):
    view, tcol, keys, cols = UPDATE_SPECS[name]
    old = ", ".join(c for c, _, _ in cols)
    new = ", ".join(f"CAST({c} + 1000 AS {t}) AS {c}" if m else c for c, t, m in cols)
    t = f"CAST({tcol} AS TIMESTAMP)"
    return (f"SELECT {old}, 0 AS batch FROM {view} WHERE {t} < TIMESTAMP '2024-01-27 00:00:00' "
            f"UNION ALL SELECT {new}, 1 AS batch FROM {view} "
            f"WHERE {t} >= TIMESTAMP '2024-01-25 00:00:00'")


def _out(cols):
    return ", ".join(R(c, c) if t == "DOUBLE" else c for c, t, _ in cols)


def union_sql():
    cols = UPDATE_SPECS["target"][3]
    return with_ctes(f"SELECT {_out(cols)}, batch FROM batches", {"batches": _batches_sql("target")})


def update_sql(name):
    _, _, keys, cols = UPDATE_SPECS[name]
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
              f"ORDER BY batch DESC) AS rn FROM batches")
    return with_ctes(f"SELECT {_out(cols)} FROM ranked_b WHERE rn = 1",
                     {"batches": _batches_sql(name), "ranked_b": ranked})


def corr_matrix_sql():
    feats = [c for c in _feature_columns() if c != "row_id"]
    items = []
    for i, a in enumerate(feats):
        for b in feats[i:]:
            items.append(f"{{'feature_a': '{a}', 'feature_b': '{b}', "
                         f"'corr': corr({_as_double(a)}, {_as_double(b)})}}")
    body = f"""SELECT least(s.feature_a, s.feature_b) AS feature_a,
  greatest(s.feature_a, s.feature_b) AS feature_b,
  CASE WHEN isnan(s.corr) THEN NULL ELSE s.corr END AS corr
FROM (SELECT unnest(l) AS s FROM (SELECT [{', '.join(items)}] AS l FROM feats))"""
    return (f"WITH feats AS ({features_sql(False)}), c AS ({body}) "
            f"SELECT feature_a, feature_b, {rnd('corr')} AS corr FROM c")


def categorical_index_sql():
    cats = ["county", "is_business", "product_type", "is_consumption", "segment"]
    ctes = [f"feats AS ({features_sql(False)})"]
    joins, cols = [], []
    for c in cats:
        ctes.append(f"""i_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx
  FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM feats GROUP BY 1))""")
        joins.append(f"JOIN i_{c} ON CAST(f.{c} AS VARCHAR) = i_{c}.v")
        cols.append(f"i_{c}.idx AS {c}_index")
    return ("WITH " + ", ".join(ctes) + f" SELECT f.row_id, {', '.join(cols)} FROM feats f "
            + " ".join(joins))


def assemble_sql():
    """Every model input as DOUBLE, NULL as the sentinel, and the segment's index."""
    nums = [c for c in _feature_columns() if c not in ("target", "row_id", "segment")]
    cols = [rnd(f"coalesce({_as_double(c)}, -1e9)") + f' AS "{c}__x"' for c in nums]
    return f"""WITH feats AS ({features_sql(False)}), i AS (
  SELECT segment AS s, CAST(row_number() OVER (ORDER BY n DESC, segment) - 1 AS DOUBLE) AS idx
  FROM (SELECT segment, count(*) AS n FROM feats GROUP BY 1))
SELECT row_id, {', '.join(cols)}, i.idx AS segment__i FROM feats JOIN i ON segment = i.s"""


def cv_blocks_sql():
    return with_ctes(f"""SELECT fold, n_test, CAST(n_train AS BIGINT) AS n_train, {rnd('lag168_mae')} AS lag168_mae
FROM (SELECT fold, n_test, lag168_mae, coalesce(sum(n_test) OVER (ORDER BY fold
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_train
      FROM (SELECT f.fold, count(*) AS n_test, avg(abs(e.target - CAST(CAST(l.target AS FLOAT) AS DOUBLE))) AS lag168_mae
            FROM energy e JOIN ranked_folds f ON e.row_id = f.row_id
            LEFT JOIN hist l ON e.county = l.county AND e.is_business = l.is_business
              AND e.product_type = l.product_type AND e.is_consumption = l.is_consumption
              AND e.datetime = l.datetime + INTERVAL 168 HOUR
            WHERE e.target IS NOT NULL GROUP BY f.fold))
WHERE fold >= 0 AND fold < 6""", {"ranked": _RANKED,
                                  "ranked_folds": f"SELECT row_id, {_FOLD_OF} AS fold FROM ranked"})


def _scored_sql():
    return with_ctes(f"SELECT row_id, true AS scored FROM energy WHERE datetime >= {LAST_DAYS}")


def _sel(view, cols):
    return with_ctes(f"SELECT {cols} FROM {view}")


def oracle_sql() -> dict[str, str]:
    fm = ", ".join(R(m, m) for m in FORECAST_MEASURES)
    hm = ", ".join(R(m, m) for m in HISTORICAL_MEASURES)
    seg = ("CAST(county AS VARCHAR) || '_' || CAST(is_business AS VARCHAR) || '_' || "
           "CAST(product_type AS VARCHAR) || '_' || CAST(is_consumption AS VARCHAR)")
    keys = "county, is_business, product_type, is_consumption"
    out = {
        "scan_energy": _sel("energy", f"{R('target', 'target')}, {keys}, datetime, row_id"),
        "scan_energy_csv": _sel("energy", f"{R('target', 'target')}, {keys}, datetime, row_id"),
        "scan_client": _sel("client", "product_type, county, eic_count, "
                            f"{R('installed_capacity', 'installed_capacity')}, is_business, date"),
        "scan_gas": _sel("gas_prices", f"forecast_date, {R('lowest_price_per_mwh', 'lowest_price_per_mwh')}, "
                         f"{R('highest_price_per_mwh', 'highest_price_per_mwh')}"),
        "scan_electricity": _sel("electricity_prices",
                                 f"forecast_date, {R('euros_per_mwh', 'euros_per_mwh')}"),
        "scan_forecast": _sel("forecast_weather",
                              f"{R('CAST(latitude AS DOUBLE)', 'latitude')}, "
                              f"{R('CAST(longitude AS DOUBLE)', 'longitude')}, hours_ahead, "
                              f"{R('temperature', 'temperature')}, {R('dewpoint', 'dewpoint')}, "
                              f"forecast_datetime, {R('snowfall', 'snowfall')}"),
        "scan_historical": _sel("historical_weather",
                                f"datetime, {hm}, {R('CAST(latitude AS DOUBLE)', 'latitude')}, "
                                f"{R('CAST(longitude AS DOUBLE)', 'longitude')}"),
        "scan_stations": _sel("station_map", "CAST(longitude AS DOUBLE) AS longitude, "
                              "CAST(latitude AS DOUBLE) AS latitude, county"),
        "enforce_schema": _sel("client", "product_type, county, eic_count, "
                               f"{R('installed_capacity', 'installed_capacity')}, is_business, date"),
        "preprocess_test": _sel("energy", f"{keys}, datetime, row_id"),
        "target_history": _sel("energy", f"{R('target', 'target')}, {keys}, datetime"),
        "filter_since": with_ctes(f"SELECT row_id, datetime, {keys}, {R('target', 'target')} "
                                  "FROM energy WHERE datetime >= TIMESTAMP '2024-01-15 00:00:00'"),
        "forecast_station_join": with_ctes(
            f"SELECT f.forecast_datetime, f.hours_ahead, {', '.join(R('f.' + m, m) for m in FORECAST_MEASURES)}, "
            "s.county FROM forecast_weather f LEFT JOIN station_map s ON "
            "CAST(f.longitude AS FLOAT) = s.longitude AND CAST(f.latitude AS FLOAT) = s.latitude"),
        "historical_station_join": with_ctes(
            f"SELECT h.datetime, {', '.join(R('h.' + m, m) for m in HISTORICAL_MEASURES)}, "
            "s.county FROM historical_weather h LEFT JOIN station_map s ON "
            "CAST(h.longitude AS FLOAT) = s.longitude AND CAST(h.latitude AS FLOAT) = s.latitude"),
        "forecast_means_grouping_sets": with_ctes(
            f"SELECT NULL::INT AS county, datetime, {fm}, 1 AS level FROM fg "
            f"UNION ALL SELECT county, datetime, {fm}, 0 AS level FROM fl"),
        "forecast_horizon": _sel("fw", f"datetime, {fm}, county"),
        "forecast_all_horizons": _sel("fw_all", f"datetime, {fm}, county"),
        "forecast_global_mean": _sel("fg", f"datetime, {fm}"),
        "forecast_local_mean": _sel("fl", f"county, datetime, {fm}"),
        "historical_global_mean": _sel("hg", f"datetime, {hm}"),
        "historical_local_mean": _sel("hl", f"county, datetime, {hm}"),
        "forecast_global_lags": weather_sql(["fg"], wx.FORECAST_LAGS),
        "forecast_local_lags": weather_sql(["fl"], wx.FORECAST_LAGS),
        "historical_global_lags": weather_sql(["hg"], wx.HISTORICAL_LAGS),
        "historical_local_lags": weather_sql(["hl"], wx.HISTORICAL_LAGS),
        "historical_lag24_morning": weather_sql(["hg"], [wx.HISTORICAL_MORNING_LAG], morning=True),
        "weather_features": weather_features_sql(),
        "client_lag2d": with_ctes(
            f"SELECT b.row_id, cl.eic_count, {R('cl.installed_capacity', 'installed_capacity')} "
            "FROM base b LEFT JOIN client cl ON b.county = cl.county AND "
            "b.is_business = cl.is_business AND b.product_type = cl.product_type AND "
            "CAST(b.datetime AS DATE) = CAST(cl.date + INTERVAL 2 DAY AS DATE)"),
        "target_type_sum": _sel("tsum", f"county, is_business, is_consumption, datetime, {R('target', 'target')}"),
        "target_county_type_sum": _sel("ctsum", f"is_business, is_consumption, datetime, {R('target', 'target')}"),
        "target_lags": target_lags_sql(),
        "target_lags_plain": target_lags_sql(),
        "target_type_sum_lags": sum_lags_sql("tsum", TSK, "target_all_type_sum"),
        "target_county_type_sum_lags": sum_lags_sql("ctsum", CTSK, "target_all_county_type_sum"),
        "target_row_mean": target_stat_sql("mean"),
        "target_row_std": target_stat_sql("std"),
        "target_ratios": target_stat_sql("ratios"),
        "target_lag_range_frame": with_ctes(
            f"SELECT e.row_id, {R('l.target', 'target_48h')} FROM energy e LEFT JOIN energy l "
            "ON e.county = l.county AND e.is_business = l.is_business AND "
            "e.product_type = l.product_type AND e.is_consumption = l.is_consumption AND "
            "l.datetime = e.datetime - INTERVAL 48 HOUR"),
        "calendar_features": _sel("base", "row_id, CAST(dayofyear(datetime) AS INT) AS dayofyear, "
                                  "CAST(hour(datetime) AS INT) AS hour, CAST(day(datetime) AS INT) AS day, "
                                  "CAST(isodow(datetime) AS INT) AS weekday, "
                                  "CAST(month(datetime) AS INT) AS month, CAST(year(datetime) AS INT) AS year"),
        "segment_key": _sel("base", f"row_id, {seg} AS segment"),
        "cyclic_features": _sel("base", ", ".join(["row_id"] + [
            R(f"{fn}(pi() * {part}(datetime) / {div})", q(f"{fn}({name})"))
            for name, part, div in [("dayofyear", "dayofyear", 183), ("hour", "hour", 12)]
            for fn in ("sin", "cos")])),
        "feature_date": _sel("base", "row_id, CAST(datetime AS DATE) AS date"),
        "holiday_calendar": with_ctes("SELECT date FROM holidays",
                                      {"holiday_rows": DERIVED["base"], "holidays": EE_HOLIDAY_SQL}),
        "holiday_flag": with_ctes("SELECT row_id, (CAST(datetime AS DATE) IN (SELECT date FROM holidays)) "
                                  "AS is_holiday FROM base",
                                  {"holiday_rows": DERIVED["base"], "holidays": EE_HOLIDAY_SQL}),
        "holiday_expr": with_ctes("SELECT row_id, (CAST(datetime AS DATE) IN (SELECT date FROM holidays)) "
                                  "AS is_holiday FROM base",
                                  {"holiday_rows": DERIVED["base"], "holidays": EE_HOLIDAY_SQL}),
        "segment_numeric": _sel("base", f"row_id, CAST(replace({seg}, '_', '') AS DOUBLE) AS segment_numeric"),
        "downcast_float": _sel("historical_weather", "datetime, latitude, longitude, " + ", ".join(
            f"CAST({m} AS FLOAT) AS {m}" for m in HISTORICAL_MEASURES)),
        "features_train": features_sql(False),
        "features_test": features_sql(True),
        "union_batches": union_sql(),
        "corr_with_target": corr_sql(),
        "corr_ranked": corr_sql(ranked=True),
        "topk_features": corr_sql(ranked=True, topk=60),
        "categorical_as_string": f"WITH feats AS ({features_sql(False)}) SELECT row_id, "
                                 "CAST(county AS VARCHAR) AS county, CAST(is_business AS VARCHAR) AS is_business, "
                                 "CAST(product_type AS VARCHAR) AS product_type, "
                                 "CAST(is_consumption AS VARCHAR) AS is_consumption, segment FROM feats",
        "ts_folds": folds_sql(),
        "mae_baseline": mae_sql(),
    }
    for name in UPDATE_SPECS:
        out[f"update_{name}"] = update_sql(name)
    out["stream_update"] = update_sql("target")
    lm = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = {"li": """SELECT CAST(date_trunc('hour', l.l_shipdate) AS TIMESTAMP) AS datetime,
  n.n_regionkey AS county, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""}
    avgs = ", ".join(R(f"avg({m})", m) for m in lm)
    out["lineitem_region_means"] = with_ctes(
        f"SELECT CAST(NULL AS INT) AS county, datetime, {avgs}, CAST(1 AS TINYINT) AS level "
        f"FROM li GROUP BY datetime UNION ALL "
        f"SELECT county, datetime, {avgs}, CAST(0 AS TINYINT) AS level FROM li "
        f"WHERE county IS NOT NULL GROUP BY county, datetime", li)
    out["target_key_duplicates"] = with_ctes(
        "SELECT datetime, county, is_business, product_type, is_consumption, count(*) AS n "
        "FROM hist GROUP BY ALL HAVING count(*) > 1")
    out["client_key_duplicates"] = with_ctes(
        "SELECT date, county, is_business, product_type, count(*) AS n FROM batches "
        "GROUP BY ALL HAVING count(*) > 1", {"batches": _batches_sql("client")})
    out["features_roundtrip"] = features_sql(False)
    out["corr_matrix"] = corr_matrix_sql()
    out["categorical_index"] = categorical_index_sql()
    from .catalog import DATE_COLUMNS, NULLABLE_INTS
    for name, col in DATE_COLUMNS.items():
        out[name] = f"SELECT * REPLACE (CAST({col} AS TIMESTAMP) AS {col}) FROM ({out[name]})"
    for name, cols in NULLABLE_INTS.items():
        repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
        out[name] = f"SELECT * REPLACE ({repl}) FROM ({out[name]})"
    out["target_lags_fused"] = out["target_lags"]
    out["stream_update_replayed"] = out["stream_update"]
    out["assemble"] = assemble_sql()
    out["cv_blocks"] = cv_blocks_sql()
    out["scored_rows"] = out["stream_scored_rows"] = _scored_sql()
    out["gbt_quality"] = with_ctes("SELECT count(*) AS n_rows, 0 AS n_missing, count(*) // 7 AS n_held_out, "
                                   "true AS beats_mean, true AS beats_lag168 FROM energy WHERE target IS NOT NULL")
    out["runs_record"] = ("SELECT 'gbt' AS model, '60' AS n_features, '10' AS max_depth, 'gbt' AS experiment, "
                          "least(count(*), 5) AS n_examples, true AS has_error FROM events")
    return out
