"""The queries of the catalog once more, as SQL over the raw tables."""

from __future__ import annotations

import re
from itertools import combinations

ORACLES: dict[str, str] = {}

MEASURES = [
    "system_demand_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "nuclear_mw",
    "hydro_mw",
    "thermal_gas_mw",
    "curtailment_mw",
    "lmp_usd",
    "temperature_c",
    "wind_speed_mps",
    "ghi_estimated",
    "net_load_mw",
]
LAGGED = ["solar_generation_mw", "wind_generation_mw", "net_load_mw", "curtailment_mw"]
ROLLED = LAGGED[:3]
PI2 = "(2 * pi())"


# ---- building blocks --------------------------------------------------------
def add(name: str, ctes: list[str], body: str, rounded: list[str] = (), places: int = 4) -> None:
    """Register ``body`` with ``rounded`` columns rounded as in the catalog."""
    fixed = ", ".join(f'ROUND("{c}" + 3.7e-8, {places}) AS "{c}"' for c in rounded)
    select = f"SELECT * REPLACE ({fixed})" if rounded else "SELECT *"
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    ORACLES[name] = f"{head}{select} FROM (\n{body}\n)"


def half_up(x: str, places: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {places}) AS DOUBLE)"


def exact_avg(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(16,4))) AS DOUBLE) / COUNT({c})"


def local(ts: str = "ts") -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles')"


def hours(ts: str = "ts") -> str:
    return f"CAST(FLOOR(epoch({ts}) / 3600) AS BIGINT)"


def season(month: str, labels: list[str]) -> str:
    a, b, c, d = labels
    return (
        f"CASE WHEN {month} IN (3,4,5) THEN '{a}' WHEN {month} IN (6,7,8) THEN '{b}' "
        f"WHEN {month} IN (9,10,11) THEN '{c}' ELSE '{d}' END"
    )


REPORT_SEASONS = ["1_Spring", "2_Summer", "3_Fall", "4_Winter"]
PLOT_SEASONS = [
    "Spring (Runoff & Solar Peak)",
    "Summer (High A/C Peak)",
    "Fall (Moderate Load)",
    "Winter (Heating & Low Solar)",
]


def _dispatch(name: str, users: int, empty: str | None) -> str:
    def s(factor: int, kind: str | None = None) -> str:
        cond = f" FILTER (WHERE event_type = '{kind}')" if kind else ""
        total = f"CAST({factor} * (SUM(CAST(value AS DECIMAL(18,2))){cond}) AS DOUBLE)"
        return f"COALESCE({total}, {empty})" if empty else total

    mean = "(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value))"
    return f"""{name} AS (
  SELECT *, system_demand_mw - (solar_generation_mw + wind_generation_mw) AS net_load_mw FROM (
    SELECT CAST(user_id // {users} AS BIGINT) AS series_id,
           CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts,
           {s(60)} AS system_demand_mw,
           {s(60, 'click')} AS solar_generation_mw,
           {s(60, 'view')} AS wind_generation_mw,
           {s(60, 'signup')} AS nuclear_mw,
           {s(60, 'purchase')} AS hydro_mw,
           CAST(0 AS DOUBLE) AS thermal_gas_mw,
           {s(3, 'error')} AS curtailment_mw,
           {mean} - 40 AS lmp_usd,
           {mean} / 2 AS temperature_c,
           {mean} / 10 AS wind_speed_mps,
           MAX(value) * 10 AS ghi_estimated
    FROM events GROUP BY 1, 2))"""


DISPATCH = _dispatch("dispatch", 50, "0.0")
SPARSE = _dispatch("dispatch", 10, None)

LONG = """dispatch_long AS (
  SELECT *, system_demand_mw - (solar_generation_mw + wind_generation_mw) AS net_load_mw FROM (
    SELECT CAST(0 AS BIGINT) AS series_id, ts, d AS system_demand_mw,
           d * CAST(0.30 AS DOUBLE) * tilt AS solar_generation_mw,
           d * CAST(0.15 AS DOUBLE) * tilt AS wind_generation_mw,
           d * CAST(0.05 AS DOUBLE) * tilt AS nuclear_mw,
           d * CAST(0.10 AS DOUBLE) * tilt AS hydro_mw,
           c AS curtailment_mw, lmp_usd
    FROM (
      SELECT CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER) AS ts,
             CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 10 AS d,
             1 + CAST(SUM(o_orderkey % 7) AS DOUBLE) / COUNT(*) / 10 AS tilt,
             COALESCE(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)))
                      FILTER (WHERE o_orderkey % 5 = 0) AS DOUBLE) / 4000, 0.0) AS c,
             (CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*)) % 100 - 30 AS lmp_usd
      FROM orders GROUP BY 1)))"""

FEED = """fuel_feed AS (
  SELECT l_suppkey % 4 AS series_id,
         CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(l_orderkey % 24 AS INTEGER) AS ts,
         CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'SUN' WHEN 'AO' THEN 'WND'
              WHEN 'NF' THEN 'NG' WHEN 'NO' THEN 'WAT' WHEN 'RF' THEN 'NUC'
              WHEN 'RO' THEN 'OTH' END AS fueltype,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.1 AS DECIMAL(18,3)) AS value_mw
  FROM lineitem)"""


def _weather(ts: str) -> str:
    return f"""weather AS (
  SELECT CASE user_id % 5 WHEN 0 THEN '72295023174' WHEN 1 THEN '72494023234'
              WHEN 2 THEN '72389093193' WHEN 3 THEN '72290003131' ELSE '99999999999' END AS station_id,
         CAST({ts} AS TIMESTAMP) AS ts,
         CASE WHEN event_type <> 'error' THEN value / 4 END AS temperature_c,
         value / 20 AS wind_speed_mps, value * 3 AS ghi_estimated
  FROM events)"""


WEATHER = _weather("date_trunc('hour', ts)")
BLEND = """blend AS (
  SELECT ts,
         COALESCE(SUM(temperature_c * w), 0) / SUM(w) AS temperature_c,
         COALESCE(SUM(wind_speed_mps * w), 0) / SUM(w) AS wind_speed_mps,
         COALESCE(SUM(ghi_estimated * w), 0) / SUM(w) AS ghi_estimated
  FROM (SELECT *, CAST(CASE station_id WHEN '72295023174' THEN 0.35 WHEN '72494023234' THEN 0.25
                  WHEN '72389093193' THEN 0.25 WHEN '72290003131' THEN 0.15 ELSE 0.1 END AS DOUBLE) AS w
        FROM weather) GROUP BY ts)"""


def tier(x: str) -> str:
    return (
        f"CASE WHEN {x} < 250 THEN 'LOW (Green)' WHEN {x} < 1000 THEN 'MODERATE (Amber)' "
        "ELSE 'CRITICAL (Red)' END"
    )


LOG = f"""forecast_log AS (
  SELECT *, GREATEST(0.0, p - 80) AS lower_bound_mw, p + 80 AS upper_bound_mw, {tier('p')} AS alert_tier
  FROM (SELECT series_id, ts AS target_ts, model_name, curtailment_mw AS y,
               curtailment_mw * (CAST(0.7 AS DOUBLE) + CAST(({hours()} * k + series_id) % 61 AS DOUBLE) / 100) AS p
        FROM dispatch, (VALUES ('prophet', 17), ('lstm', 29), ('ensemble', 41)) AS m(model_name, k)))"""

PROB = "round_even(LEAST(GREATEST({x} / (2.5 * 250), 0), 1), 3)"
WIDE = f"""wide AS (
  SELECT d.series_id, d.ts, prophet_mw, lstm_mw, ensemble_mw, lower_bound_mw, upper_bound_mw,
         {tier('ensemble_mw')} AS curtailment_alert,
         {PROB.format(x='ensemble_mw')} AS curtailment_event_prob,
         d.curtailment_mw AS actual_curtailment_mw, d.net_load_mw, d.solar_generation_mw,
         d.wind_generation_mw, d.temperature_c
  FROM (SELECT series_id, target_ts AS ts,
               MAX(p) FILTER (WHERE model_name = 'prophet') AS prophet_mw,
               MAX(p) FILTER (WHERE model_name = 'lstm') AS lstm_mw,
               MAX(p) FILTER (WHERE model_name = 'ensemble') AS ensemble_mw,
               MAX(lower_bound_mw) FILTER (WHERE model_name = 'ensemble') AS lower_bound_mw,
               MAX(upper_bound_mw) FILTER (WHERE model_name = 'ensemble') AS upper_bound_mw
        FROM forecast_log GROUP BY 1, 2) f JOIN dispatch d USING (series_id, ts))"""

SPAN = "span AS (SELECT series_id, MIN(ts) AS lo, MAX(ts) AS hi FROM dispatch GROUP BY 1)"
CAL = "cal AS (SELECT series_id, UNNEST(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM span)"
HOLES = f"""holes AS (
  SELECT cal.series_id, cal.ts, {hours('cal.ts')} AS h, {', '.join('d.' + c for c in MEASURES)}
  FROM cal LEFT JOIN dispatch d ON d.series_id = cal.series_id AND d.ts = cal.ts)"""


def _neighbours(c: str) -> str:
    up = "(PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = "(PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {c} IS NOT NULL THEN h END"
    return (
        f"LAST_VALUE({c} IGNORE NULLS) OVER {up} AS av_{c}, LAST_VALUE({at} IGNORE NULLS) OVER {up} AS at_{c}, "
        f"FIRST_VALUE({c} IGNORE NULLS) OVER {down} AS bv_{c}, FIRST_VALUE({at} IGNORE NULLS) OVER {down} AS bt_{c}"
    )


def _fill(c: str) -> str:
    def line(x: str) -> str:
        return f"av_{c} + (bv_{c} - av_{c}) * ({x} - at_{c}) / (bt_{c} - at_{c})"

    return f"""CASE WHEN {c} IS NOT NULL THEN {c}
      WHEN at_{c} IS NOT NULL AND bt_{c} IS NOT NULL THEN
        CASE WHEN h - at_{c} <= 3 OR bt_{c} - h <= 3 THEN {line('h')} ELSE {line(f'(bt_{c} - 3)')} END
      ELSE COALESCE(av_{c}, bv_{c}) END AS {c}"""


GRID = [
    SPAN,
    CAL,
    HOLES,
    f"near AS (SELECT *, {', '.join(_neighbours(c) for c in MEASURES)} FROM holes)",
    f"grid AS (SELECT series_id, ts, h, {', '.join(_fill(c) for c in MEASURES)} FROM near)",
]
BY_TS = "PARTITION BY series_id ORDER BY ts"



def _dot(a: str, b: str, n: int) -> str:
    return f"list_dot_product({a}, {b})" if n else "0"


def _solved(source: str, keep: str, xs: list[str], alpha: float, steps_ahead: int = 0) -> list[str]:
    """Tables that end in ``solved``: ``keep``, n and the ridge coefficients ``beta`` of y on ``xs`` within each ``keep``.

    With ``steps_ahead`` there are as many targets, y0 and on, and a row for each ``step``.

    Column by column of the lower factor, then forward and backward substitution; g and r hold a row of the matrix and of the factor.
    """
    p = len(xs)
    grams = [f"[{', '.join(f'SUM(x{i} * x{j})' for j in range(i + 1))}] AS g{i}" for i in range(p)]
    targets = [f"y{k}" for k in range(steps_ahead)] or ["y"]
    rights = [f"[{', '.join(f'SUM(x{i} * {y})' for i in range(p))}]" for y in targets]
    right = f"[{', '.join(rights)}] AS b" if steps_ahead else f"{rights[0]} AS b"
    none = ", ".join(f"CAST([] AS DOUBLE[]) AS r{i}" for i in range(p))
    steps = [f"f0 AS (SELECT {keep}, COUNT(*) AS n, {', '.join(grams)}, {right}, {none} FROM {source} WHERE {targets[0]} IS NOT NULL GROUP BY {keep})"]
    for j in range(p):
        steps.append(f"d{j} AS (SELECT *, SQRT(g{j}[{j + 1}] + {alpha} - {_dot(f'r{j}', f'r{j}', j)}) AS d FROM f{j})")
        below = [f"list_append(r{i}, (g{i}[{j + 1}] - {_dot(f'r{i}', f'r{j}', j)}) / d) AS r{i}" for i in range(j + 1, p)]
        steps.append(f"f{j + 1} AS (SELECT * EXCLUDE (d) REPLACE ({', '.join([f'list_append(r{j}, d) AS r{j}', *below])}) FROM d{j})")
    steps.append(f"right_sides AS (SELECT * EXCLUDE (b), b[step + 1] AS b FROM f{p}, (SELECT UNNEST(range({steps_ahead})) AS step))")
    steps.append(f"z0 AS (SELECT *, [b[1] / r0[1]] AS z FROM {'right_sides' if steps_ahead else f'f{p}'})")
    for i in range(1, p):
        steps.append(f"z{i} AS (SELECT * REPLACE (list_append(z, (b[{i + 1}] - {_dot(f'r{i}[1:{i}]', 'z', i)}) / r{i}[{i + 1}]) AS z) FROM z{i - 1})")
    steps.append(f"w{p - 1} AS (SELECT *, [z[{p}] / r{p - 1}[{p}]] AS w FROM z{p - 1})")
    for i in range(p - 2, -1, -1):
        later = " + ".join(f"w[{p - q}] * r{q}[{i + 1}]" for q in range(i + 1, p))
        steps.append(f"w{i} AS (SELECT * REPLACE (list_append(w, (z[{i + 1}] - ({later})) / r{i}[{i + 1}]) AS w) FROM w{i + 1})")
    steps = [x.replace(" AS (", " AS MATERIALIZED (", 1) for x in steps]
    if steps_ahead:
        keep += ", step"
    else:
        steps = [x for x in steps if not x.startswith("right_sides")]
    return [*steps, f"solved AS (SELECT {keep}, n, list_reverse(w) AS beta FROM w0)"]


# ---- reports ----------------------------------------------------------------
add(
    "duck_curve",
    [LONG],
    f"""SELECT series_id, EXTRACT(HOUR FROM {local()}) AS hour_pst,
  {season('EXTRACT(MONTH FROM ts)', REPORT_SEASONS)} AS season,
  {half_up(exact_avg('system_demand_mw'), 1)} AS avg_demand_mw,
  {half_up(exact_avg('solar_generation_mw'), 1)} AS avg_solar_mw,
  {half_up(exact_avg('net_load_mw'), 1)} AS avg_net_load_mw,
  {half_up(exact_avg('curtailment_mw'), 1)} AS avg_curtailment_mw,
  {half_up(exact_avg('system_demand_mw') + ' - ' + exact_avg('net_load_mw'), 1)} AS solar_penetration_mw
FROM dispatch_long GROUP BY 1, 2, 3""",
)
add(
    "evening_ramp_top50",
    [
        DISPATCH,
        f"""ramps AS (SELECT series_id, ts, {local()} AS lt, net,
  LAG(net, 3) OVER ({BY_TS}) AS start, net - LAG(net, 3) OVER ({BY_TS}) AS ramp
  FROM (SELECT series_id, ts, CAST(net_load_mw AS DECIMAL(16,4)) AS net FROM dispatch))""",
    ],
    f"""SELECT series_id, CAST(lt AS DATE) AS dispatch_date, EXTRACT(HOUR FROM lt) AS ramp_end_hour_pst,
  {half_up('start', 1)} AS start_net_load_mw, {half_up('net', 1)} AS end_net_load_mw,
  {half_up('ramp', 1)} AS upward_ramp_3h_mw,
  CASE WHEN ramp >= 12000 THEN 'CRITICAL RAMP (>12 GW)' WHEN ramp >= 8000 THEN 'SEVERE RAMP (8-12 GW)'
       ELSE 'MODERATE RAMP' END AS ramp_severity_tier
FROM ramps WHERE EXTRACT(HOUR FROM lt) BETWEEN 17 AND 21 AND ramp >= 8000
ORDER BY upward_ramp_3h_mw DESC, series_id, ts LIMIT 50""",
)
add(
    "weekly_hydro_solar",
    [LONG],
    f"""SELECT series_id, CAST(date_trunc('week', ts) AS DATE) AS dispatch_week,
  {half_up(exact_avg('hydro_mw'), 1)} AS weekly_avg_hydro_mw,
  {half_up(exact_avg('solar_generation_mw'), 1)} AS weekly_avg_solar_mw,
  {half_up('MIN(CAST(net_load_mw AS DECIMAL(16,4)))', 1)} AS weekly_min_net_load_mw,
  {half_up('SUM(CAST(curtailment_mw AS DECIMAL(16,4)))', 1)} AS total_weekly_curtailment_mwh,
  COUNT(CASE WHEN lmp_usd < 0 THEN 1 END) AS negative_price_hours,
  {half_up(exact_avg('lmp_usd'), 2)} AS avg_wholesale_lmp_usd
FROM dispatch_long GROUP BY 1, 2 HAVING SUM(CAST(curtailment_mw AS DECIMAL(16,4))) > 500
ORDER BY total_weekly_curtailment_mwh DESC, series_id, dispatch_week LIMIT 25""",
)
add(
    "forecast_scorecard",
    [
        DISPATCH,
        LOG,
        """scored AS (SELECT model_name, ABS(CAST(f.p AS DECIMAL(16,4)) - CAST(d.curtailment_mw AS DECIMAL(16,4))) AS e,
  CAST(f.p AS DECIMAL(16,4)) >= 250 AS said, CAST(d.curtailment_mw AS DECIMAL(16,4)) >= 250 AS real
  FROM forecast_log f JOIN dispatch d ON d.series_id = f.series_id AND d.ts = f.target_ts
  WHERE f.target_ts >= (SELECT MAX(target_ts) FROM forecast_log) - INTERVAL 30 DAY)""",
    ],
    f"""SELECT model_name, COUNT(*) AS total_forecast_hours,
  {half_up('CAST(SUM(e) AS DOUBLE) / COUNT(*)', 2)} AS mae_mw,
  {half_up('SQRT(CAST(SUM(e * e) AS DOUBLE) / COUNT(*))', 2)} AS rmse_mw,
  COUNT(*) FILTER (WHERE said AND real) AS tp, COUNT(*) FILTER (WHERE said AND NOT real) AS fp,
  COUNT(*) FILTER (WHERE NOT said AND real) AS fn,
  {half_up('COUNT(*) FILTER (WHERE said AND real) / NULLIF(CAST(COUNT(*) FILTER (WHERE said) AS DOUBLE), 0)', 4)} AS precision_score,
  {half_up('COUNT(*) FILTER (WHERE said AND real) / NULLIF(CAST(COUNT(*) FILTER (WHERE real) AS DOUBLE), 0)', 4)} AS recall_score
FROM scored GROUP BY 1""",
)


def _kpi(model: str, thr: float, n: int) -> str:
    def money(x: str, head: str, tail: str) -> str:
        return f"'{head}' || format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)) || '{tail}'"

    return f"""SELECT *, CASE WHEN peak_mw >= 1000 THEN 'CRITICAL OVER-SUPPLY ALERT'
    WHEN peak_mw >= {thr} THEN 'ELEVATED CURTAILMENT RISK' ELSE 'SYSTEM BALANCED' END AS status,
  {money('peak_mw', '', ' MW')} AS peak_text,
  strftime(peak_ts, 'At %b %d, %H:%M UTC') AS peak_time_text,
  {money('total_mwh', '', ' MWh')} AS total_text, {money('economic_loss_usd', '$', '')} AS loss_text,
  {money('min_net_load_mw', '', ' MW')} AS min_net_load_text
FROM (SELECT series_id, MAX({model}) AS peak_mw, MIN(ts) FILTER (WHERE {model} = top) AS peak_ts,
             SUM({model}) AS total_mwh, SUM({model}) * 25.0 AS economic_loss_usd,
             MIN(net_load_mw) AS min_net_load_mw
      FROM (SELECT *, MAX({model}) OVER (PARTITION BY series_id) AS top FROM (
              SELECT *, MIN(ts) OVER (PARTITION BY series_id) AS lo FROM wide)
            WHERE ts < lo + INTERVAL {n} HOUR)
      GROUP BY 1)"""


# the peak is taken after the horizon filter
def _kpi_rows(model: str, thr: float, n: int) -> str:
    first = f"""(SELECT * FROM (SELECT *, MIN(ts) OVER (PARTITION BY series_id) AS lo FROM wide)
            WHERE ts < lo + INTERVAL {n} HOUR)"""
    inner = f"(SELECT *, MAX({model}) OVER (PARTITION BY series_id) AS top FROM {first})"
    old = _kpi(model, thr, n)
    start, end = old.index("      FROM (SELECT *, MAX("), old.index("      GROUP BY 1)")
    return old[:start] + f"      FROM {inner}\n" + old[end:]


KPI_DOUBLES = ["peak_mw", "total_mwh", "economic_loss_usd", "min_net_load_mw"]
add("kpi_summary", [DISPATCH, LOG, WIDE], _kpi_rows("ensemble_mw", 250, 48), KPI_DOUBLES)
add("kpi_summary_24h", [DISPATCH, LOG, WIDE], _kpi_rows("lstm_mw", 500, 24), KPI_DOUBLES)
add(
    "alert_table",
    [DISPATCH, LOG, WIDE],
    """SELECT series_id, strftime(ts, '%Y-%m-%d %H:%M UTC') AS "Event Timestamp",
  ensemble_mw AS "Curtailed Volume (MW)", net_load_mw AS "Net Load (MW)",
  curtailment_alert AS "Risk Tier", curtailment_event_prob AS "Event Probability"
FROM wide WHERE ensemble_mw >= 250""",
    ["Curtailed Volume (MW)", "Net Load (MW)", "Event Probability"],
)

# ---- sources ----------------------------------------------------------------
FUEL_COLUMNS = {
    "SUN": "solar_generation_mw",
    "WND": "wind_generation_mw",
    "NG": "thermal_gas_mw",
    "WAT": "hydro_mw",
    "NUC": "nuclear_mw",
    "OTH": "other_mw",
}
add(
    "fuel_mix_wide",
    [FEED],
    "SELECT series_id, ts, "
    + ", ".join(
        f"CAST(SUM(value_mw) FILTER (WHERE fueltype = '{f}') AS DOUBLE) AS {c}"
        for f, c in FUEL_COLUMNS.items()
    )
    + " FROM fuel_feed GROUP BY 1, 2",
)
WIDE_DOUBLES = [
    "prophet_mw",
    "lstm_mw",
    "ensemble_mw",
    "lower_bound_mw",
    "upper_bound_mw",
    "curtailment_event_prob",
    "actual_curtailment_mw",
    "net_load_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "temperature_c",
]
add(
    "fuel_pages",
    [FEED],
    """SELECT CAST(series_id AS VARCHAR) AS series_id, fueltype, CAST(ts AS DATE) AS day,
  CAST(SUM(value_mw) AS DOUBLE) AS value_mw, COUNT(*) AS n FROM fuel_feed
WHERE series_id IN (0, 2) AND fueltype IN ('SUN', 'WND')
  AND ts BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1999-12-31 23:00:00' GROUP BY 1, 2, 3""",
)
add("forecast_export", [DISPATCH, LOG, WIDE], "SELECT * FROM wide", WIDE_DOUBLES)
REQUIRED = ["series_id", "ts", *[c for c in MEASURES[:7]]]


def _not_null(table: str, source: str, cols: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, 'not_null' AS rule, '{name}' AS column_name, "
        f"COUNT(*) FILTER (WHERE {col} IS NULL) AS violations FROM {source}"
        for name, col in cols.items()
    ]


def _unique(table: str, source: str, key: str, cols: str) -> str:
    return (
        f"SELECT '{table}', 'unique', '{key}', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
        f"FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {cols})"
    )


add(
    "constraint_violations",
    [
        SPARSE,
        _dispatch("dense", 50, "0.0"),
        WEATHER,
        LOG.replace("FROM dispatch,", "FROM dense,"),
        "log AS (SELECT *, strftime(target_ts, '%Y-%m-%d') AS run_id FROM forecast_log)",
    ],
    "\nUNION ALL ".join(
        _not_null("dispatch", "dispatch", {c: c for c in REQUIRED})
        + [_unique("dispatch", "dispatch", "series_id,ts", "series_id, ts")]
        + _not_null("weather", "weather", {c: c for c in ("station_id", "ts")})
        + [_unique("weather", "weather", "station_id,ts", "station_id, ts")]
        + _not_null(
            "forecast_log",
            "log",
            {
                "run_id": "run_id",
                "generated_at": "target_ts",
                "target_ts": "target_ts",
                "model_name": "model_name",
                "predicted_curtailment_mw": "p",
            },
        )
        + [
            _unique(
                "forecast_log",
                "log",
                "run_id,series_id,target_ts,model_name",
                "run_id, series_id, target_ts, model_name",
            )
        ]
    ),
)
DEFAULTED = ["solar_generation_mw", "wind_generation_mw", "nuclear_mw", "hydro_mw", "thermal_gas_mw", "curtailment_mw"]
add(
    "dispatch_defaults",
    [SPARSE],
    "SELECT series_id, ts, system_demand_mw, "
    + ", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in DEFAULTED)
    + """, COALESCE(lmp_usd, 35.0) AS lmp_usd, temperature_c, wind_speed_mps, ghi_estimated,
  system_demand_mw - (COALESCE(solar_generation_mw, 0.0) + COALESCE(wind_generation_mw, 0.0)) AS net_load_mw
FROM dispatch""",
    MEASURES,
)

# ---- sources and sinks ------------------------------------------------------
for _name in ("parquet_round_trip", "csv_round_trip"):
    add(_name, [SPARSE], f"SELECT series_id, ts, {', '.join(MEASURES)} FROM dispatch", MEASURES)

# ---- cleaning ---------------------------------------------------------------
LA = "'America/Los_Angeles'"
CLOCK = [
    f"""utcs AS (SELECT *, (wall AT TIME ZONE {LA}) AT TIME ZONE 'UTC' AS utc,
  ((date_trunc('hour', wall) + INTERVAL 1 HOUR) AT TIME ZONE {LA}) AT TIME ZONE 'UTC' AS shifted
  FROM walls WHERE wall IS NOT NULL)""",
    f"""marked AS (SELECT *, {local('utc')} <> wall AS skipped,
  {local('(utc - INTERVAL 1 HOUR)')} = wall OR {local('(utc + INTERVAL 1 HOUR)')} = wall AS fold,
  CASE WHEN {local('(utc - INTERVAL 1 HOUR)')} = wall THEN utc - INTERVAL 1 HOUR ELSE utc END AS daylight
  FROM utcs)""",
    """steps AS (SELECT *, CASE WHEN wall <= LAG(wall) OVER (PARTITION BY series_id, CAST(wall AS DATE)
  ORDER BY record_seq) THEN 1 ELSE 0 END AS back FROM marked WHERE fold)""",
    """sides AS (SELECT *, SUM(back) OVER (PARTITION BY series_id, CAST(wall AS DATE)) AS n,
  SUM(back) OVER (PARTITION BY series_id, CAST(wall AS DATE) ORDER BY record_seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after FROM steps)""",
]
CLOCKED = """SELECT series_id, record_seq, CASE WHEN skipped THEN shifted ELSE utc END AS ts, value
FROM marked WHERE NOT fold
UNION ALL
SELECT series_id, record_seq, daylight + INTERVAL 1 HOUR * CAST(after AS INTEGER), value FROM sides WHERE n = 1"""
add(
    "local_to_utc",
    [
        """records AS (SELECT o_custkey % 2 AS series_id, o_orderkey AS record_seq, o_totalprice AS value,
  CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE strftime(CAST(o_orderdate AS TIMESTAMP)
    + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER), '%Y-%m-%d %H:%M:%S') END AS txt FROM orders)""",
        "walls AS (SELECT *, TRY_CAST(txt AS TIMESTAMP) AS wall FROM records)",
        *CLOCK,
    ],
    CLOCKED,
    ["value"],
)
add(
    "zoned_to_utc",
    [
        """records AS (SELECT o_custkey % 2 AS series_id, o_orderkey AS record_seq, o_totalprice AS value,
  CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER) AS wall FROM orders)""",
        "walls AS (SELECT * FROM records WHERE record_seq % 3 = 2)",
        *CLOCK,
    ],
    CLOCKED + """
UNION ALL
SELECT series_id, record_seq, wall + INTERVAL 7 HOUR * CAST(record_seq % 3 AS INTEGER), value FROM records WHERE record_seq % 3 < 2""",
    ["value"],
)
MET = ["temperature_c", "wind_speed_mps", "ghi_estimated"]
add(
    "dedupe_mean",
    [WEATHER],
    f"SELECT station_id, ts, {', '.join(f'AVG({c}) AS {c}' for c in MET)} FROM weather GROUP BY 1, 2",
    MET,
)
add("station_blend", [WEATHER, BLEND], "SELECT * FROM blend", MET)
aware = BLEND
for _c in MET:
    aware = aware.replace(
        f"COALESCE(SUM({_c} * w), 0) / SUM(w)", f"SUM({_c} * w) / SUM(w) FILTER (WHERE {_c} IS NOT NULL)"
    )
add("station_blend_null_aware", [WEATHER, aware], "SELECT * FROM blend", MET)
add(
    "dispatch_with_weather",
    [DISPATCH, WEATHER, BLEND],
    f"SELECT series_id, d.ts, system_demand_mw, {', '.join('b.' + c for c in MET)} "
    "FROM dispatch d LEFT JOIN blend b ON b.ts = d.ts",
    ["system_demand_mw", *MET],
)
add(
    "hourly_grid",
    [SPARSE, SPAN, CAL, HOLES],
    f"SELECT series_id, ts, {', '.join(MEASURES)} FROM holes",
    MEASURES,
)
add("gap_fill", [SPARSE, *GRID], f"SELECT series_id, ts, {', '.join(MEASURES)} FROM grid", MEASURES)
BOUNDED = ["solar_generation_mw", "wind_generation_mw", "system_demand_mw", "curtailment_mw"]
CENTRED = f"({BY_TS} ROWS BETWEEN 84 PRECEDING AND 83 FOLLOWING)"


def _cap(c: str) -> str:
    top = f"(quantile_cont({c}, 0.5) OVER {CENTRED} + 4.0 * stddev_samp({c}) OVER {CENTRED})"
    return (
        f"CASE WHEN COUNT({c}) OVER {CENTRED} >= 24 AND {c} > 100 AND {c} > {top} "
        f"THEN {top} ELSE {c} END AS {c}"
    )


CAPPED = [
    f"floored AS (SELECT series_id, ts, {', '.join(f'GREATEST(0.0, {c}) AS {c}' for c in BOUNDED)} FROM grid)",
    f"capped AS (SELECT series_id, ts, {', '.join(_cap(c) for c in BOUNDED)} FROM floored)",
]
add(
    "outlier_cap",
    [DISPATCH, *GRID, *CAPPED],
    """SELECT series_id, ts, solar_generation_mw, wind_generation_mw, system_demand_mw,
  LEAST(curtailment_mw, solar_generation_mw + wind_generation_mw) AS curtailment_mw,
  system_demand_mw - (solar_generation_mw + wind_generation_mw) AS net_load_mw FROM capped""",
    [*BOUNDED, "net_load_mw"],
)

# ---- features ---------------------------------------------------------------
CALENDAR = {
    "hour": "EXTRACT(HOUR FROM ts)",
    "day_of_week": "EXTRACT(ISODOW FROM ts) - 1",
    "day_of_year": "EXTRACT(DOY FROM ts)",
    "month": "EXTRACT(MONTH FROM ts)",
    "quarter": "EXTRACT(QUARTER FROM ts)",
    "is_weekend": "CASE WHEN EXTRACT(ISODOW FROM ts) >= 6 THEN 1 ELSE 0 END",
}
CYCLES = {
    "hour": ("EXTRACT(HOUR FROM ts)", "24.0"),
    "day_of_week": ("(EXTRACT(ISODOW FROM ts) - 1)", "7.0"),
    "month": ("(EXTRACT(MONTH FROM ts) - 1)", "12.0"),
    "day_of_year": ("(EXTRACT(DOY FROM ts) - 1)", "365.25"),
}
CALENDAR_SQL = ", ".join(f"CAST({x} AS BIGINT) AS {c}" for c, x in CALENDAR.items())
CYCLE_SQL = ", ".join(
    f"{f}({PI2} * {x} / CAST({n} AS DOUBLE)) AS {c}_{f}" for c, (x, n) in CYCLES.items() for f in ("sin", "cos")
)
CYCLE_COLUMNS = [f"{c}_{f}" for c in CYCLES for f in ("sin", "cos")]
add(
    "calendar_features",
    [DISPATCH],
    f"SELECT series_id, ts, {CALENDAR_SQL}, {CYCLE_SQL} FROM dispatch",
    CYCLE_COLUMNS,
)


def _sun(source: str) -> list[str]:
    lat, lon = 36.7783, -119.4179
    return [
        f"clock AS (SELECT *, EXTRACT(HOUR FROM ts) + EXTRACT(MINUTE FROM ts) / CAST(60 AS DOUBLE) AS hr FROM {source})",
        f"gam AS (SELECT *, {PI2} / 365.0 * (EXTRACT(DOY FROM ts) - 1 + (hr - 12) / 24.0) AS g FROM clock)",
        """sun1 AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g)
    - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eqt,
  0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g)
    - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS decl FROM gam)""",
        f"sun2 AS (SELECT *, ((hr * 60 + eqt + 4 * ({lon})) % 1440 + 1440) % 1440 AS tst FROM sun1)",
        f"""sun AS (SELECT * EXCLUDE (hr, g, eqt, decl, tst), GREATEST(0.0, 90 - degrees(acos(LEAST(1, GREATEST(-1,
    sin(radians({lat})) * sin(decl) + cos(radians({lat})) * cos(decl) * cos(radians(tst / 4 - 180))))))) AS solar_elevation_deg
  FROM sun2)""",
    ]


DAYLIGHT = "CAST(CASE WHEN solar_elevation_deg > 2 THEN 1 ELSE 0 END AS BIGINT) AS is_daylight"
add(
    "solar_elevation",
    [LONG, *_sun("(SELECT series_id, ts FROM dispatch_long)")],
    f"SELECT *, {DAYLIGHT} FROM sun",
    ["solar_elevation_deg"],
)
ORDERS = {"d": (24, 5), "w": (168, 3), "a": (8766, 4)}
FOURIER = {
    f"fourier_{n}{k}_{f}": f"{f}({PI2} * {k} * eh / CAST({p} AS DOUBLE))"
    for n, (p, order) in ORDERS.items()
    for k in range(1, order + 1)
    for f in ("sin", "cos")
}
FOURIER_SQL = ", ".join(f"{x} AS {c}" for c, x in FOURIER.items())
ELAPSED = "(epoch_us(ts) - epoch_us(lo)) / CAST(3600000000 AS DOUBLE) AS eh"
add(
    "fourier_terms",
    [DISPATCH, SPAN, f"el AS (SELECT d.series_id, ts, {ELAPSED} FROM dispatch d JOIN span USING (series_id))"],
    f"SELECT series_id, ts, {FOURIER_SQL} FROM el",
    list(FOURIER),
)
LAGS = {
    f"{c}_lag_{k}h": f"LAG({c}, {k}) OVER ({BY_TS})" for c in LAGGED for k in (1, 2, 3, 6, 12, 24, 48)
} | {f"{c}_ramp_{k}h": f"{c} - LAG({c}, {k}) OVER ({BY_TS})" for c in LAGGED for k in (1, 3)}
LAGS_SQL = ", ".join(f"{x} AS {c}" for c, x in LAGS.items())
PENETRATION = (
    "LEAST(GREATEST((solar_generation_mw + wind_generation_mw) / (system_demand_mw + 1e-5), 0), 2.5)"
    " AS renewable_penetration_ratio"
)
add(
    "lags_and_ramps",
    [DISPATCH, *GRID],
    f"SELECT series_id, ts, {LAGS_SQL}, {PENETRATION} FROM grid",
    [*LAGS, "renewable_penetration_ratio"],
)
ROLLS = {}
for _c in ROLLED:
    for _w in (6, 24, 168):
        _f = f"({BY_TS} ROWS BETWEEN {_w} PRECEDING AND 1 PRECEDING)"
        _ok = f"COUNT({_c}) OVER {_f} >= {max(1, _w // 4)}"
        ROLLS |= {
            f"{_c}_roll_{_w}h_mean": f"CASE WHEN {_ok} THEN AVG({_c}) OVER {_f} END",
            f"{_c}_roll_{_w}h_std": f"COALESCE(CASE WHEN {_ok} THEN STDDEV_SAMP({_c}) OVER {_f} END, 0)",
            f"{_c}_roll_{_w}h_min": f"CASE WHEN {_ok} THEN MIN({_c}) OVER {_f} END",
            f"{_c}_roll_{_w}h_max": f"CASE WHEN {_ok} THEN MAX({_c}) OVER {_f} END",
        }
ROLLS_SQL = ", ".join(f"{x} AS {c}" for c, x in ROLLS.items())
EVENT = "CAST(CASE WHEN curtailment_mw >= 250 THEN 1 ELSE 0 END AS BIGINT) AS curtailment_event"
add(
    "rolling_stats",
    [DISPATCH, *GRID],
    f"SELECT series_id, ts, {ROLLS_SQL}, {EVENT} FROM grid",
    list(ROLLS),
)
FEATURES = [
    f"feat AS (SELECT grid.* EXCLUDE (h), {ELAPSED}, {LAGS_SQL}, {ROLLS_SQL} FROM grid JOIN span USING (series_id))",
    *_sun("feat"),
]
FEATURE_DOUBLES = [
    *MEASURES,
    *LAGS,
    *ROLLS,
    "solar_elevation_deg",
    "renewable_penetration_ratio",
    *CYCLE_COLUMNS,
    *FOURIER,
]
_present = " AND ".join(f"{c} IS NOT NULL" for c in [*MEASURES, *LAGS, *ROLLS])
add(
    "feature_table",
    [DISPATCH, *GRID, *FEATURES],
    f"""SELECT * EXCLUDE (eh), {CALENDAR_SQL}, {CYCLE_SQL}, {DAYLIGHT}, {FOURIER_SQL}, {PENETRATION}, {EVENT}
FROM sun WHERE {_present}""",
    FEATURE_DOUBLES,
)

_renewables = "solar_generation_mw + wind_generation_mw"
CLEAN = [
    *GRID[:-1],
    GRID[-1].replace("grid AS", "raw_grid AS", 1),
    f"floored AS (SELECT * REPLACE ({', '.join(f'GREATEST(0.0, {c}) AS {c}' for c in BOUNDED)}) FROM raw_grid)",
    f"capped AS (SELECT * REPLACE ({', '.join(_cap(c) for c in BOUNDED)}) FROM floored)",
    f"""grid AS (SELECT * REPLACE (LEAST(curtailment_mw, {_renewables}) AS curtailment_mw,
  system_demand_mw - ({_renewables}) AS net_load_mw) FROM capped)""",
]
add(
    "clean_features",
    [DISPATCH, *CLEAN, *FEATURES],
    f"""SELECT * EXCLUDE (eh), {CALENDAR_SQL}, {CYCLE_SQL}, {DAYLIGHT}, {FOURIER_SQL}, {PENETRATION}, {EVENT}
FROM sun WHERE {_present}""",
    FEATURE_DOUBLES,
)

# ---- splits and evaluation --------------------------------------------------
AGED = f"aged AS (SELECT grid.*, {hours('hi')} - h AS age, lo, hi FROM grid JOIN span USING (series_id))"
add(
    "time_split_counts",
    [DISPATCH, *GRID, AGED],
    """SELECT series_id, CASE WHEN age < 48 THEN 'test' WHEN age < 216 THEN 'val' ELSE 'train' END AS split,
  COUNT(*) AS hours, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM aged GROUP BY 1, 2""",
)
add(
    "backtest_windows",
    [DISPATCH, SPAN],
    """SELECT series_id, CAST(w AS BIGINT) AS "window",
  hi + INTERVAL 1 HOUR - INTERVAL 48 HOUR * (5 - w) AS test_end,
  hi + INTERVAL 1 HOUR - INTERVAL 48 HOUR * (6 - w) AS test_start,
  hi + INTERVAL 1 HOUR - INTERVAL 48 HOUR * (6 - w) - INTERVAL 168 HOUR AS train_end
FROM span, (VALUES (1), (2), (3), (4)) AS v(w)""",
)
add(
    "sample_week",
    [DISPATCH, *GRID],
    """SELECT series_id, ts, system_demand_mw, net_load_mw FROM (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM grid) WHERE rn BETWEEN 101 AND 268""",
    ["system_demand_mw", "net_load_mw"],
)


def _padded(kind: str, have: int, want: int) -> str:
    def col(c: str) -> str:
        return f"CASE WHEN a.ts > l.lt THEN l.{c} ELSE f.{c} END AS {c}"

    first = f"(SELECT * FROM (SELECT *, MIN(ts) OVER (PARTITION BY series_id) AS lo FROM wide) WHERE ts < lo + INTERVAL {have} HOUR)"
    return f"""SELECT '{kind}' AS kind, a.series_id, a.ts, {col('prophet_mw')}, {col('lstm_mw')}
FROM (SELECT series_id, UNNEST(generate_series(MIN(ts), MIN(ts) + INTERVAL {want - 1} HOUR, INTERVAL 1 HOUR)) AS ts
      FROM wide GROUP BY series_id) a
JOIN (SELECT series_id, MAX(ts) AS lt, arg_max(prophet_mw, ts) AS prophet_mw, arg_max(lstm_mw, ts) AS lstm_mw
      FROM {first} GROUP BY 1) l ON l.series_id = a.series_id
LEFT JOIN {first} f ON f.series_id = a.series_id AND f.ts = a.ts"""


add(
    "horizon_padding",
    [DISPATCH, LOG, WIDE],
    _padded("padded", 30, 48) + "\nUNION ALL\n" + _padded("cut", 48, 24),
    ["prophet_mw", "lstm_mw"],
)


def _regression(y: str, p: str) -> str:
    return f"""COUNT(*) AS n, round_even(AVG(ABS({y} - {p})), 4) AS mae,
  round_even(SQRT(AVG(({y} - {p}) * ({y} - {p}))), 4) AS rmse,
  round_even(CASE WHEN MAX({y}) - MIN({y}) > 1e-5 THEN SQRT(AVG(({y} - {p}) * ({y} - {p}))) / (MAX({y}) - MIN({y})) ELSE 0 END, 4) AS nrmse,
  round_even(COALESCE(AVG(ABS(({y} - {p}) / {y})) FILTER (WHERE ABS({y}) > 1e-2) * 100, 0), 4) AS mape,
  round_even(CASE WHEN VAR_POP({y}) > 0 THEN 1 - AVG(({y} - {p}) * ({y} - {p})) / VAR_POP({y})
       WHEN AVG(({y} - {p}) * ({y} - {p})) = 0 THEN 1 ELSE 0 END, 4) AS r2"""


def _events(y: str, p: str, thr: float) -> str:
    def n(a: str, b: str) -> str:
        return f"COUNT(*) FILTER (WHERE {y} {a} {thr} AND {p} {b} {thr})"

    tp, fp, tn, fn = n(">=", ">="), n("<", ">="), n("<", "<"), n(">=", "<")

    def share(a: str, b: str) -> str:
        return f"round_even(COALESCE(CAST({a} AS DOUBLE) / NULLIF({b}, 0), 0), 4)"

    return f"""CAST({thr} AS DOUBLE) AS threshold_mw, {share(tp, f'({tp} + {fp})')} AS "precision",
  {share(tp, f'({tp} + {fn})')} AS recall, {share(f'2 * {tp}', f'(2 * {tp} + {fp} + {fn})')} AS f1,
  {tp} AS tp, {fp} AS fp, {tn} AS tn, {fn} AS fn"""


REGRESSION = ["mae", "rmse", "nrmse", "mape", "r2"]
EVENTS = ["threshold_mw", "precision", "recall", "f1"]


def _lagged(lag: int) -> str:
    return f"""SELECT CAST({lag} AS BIGINT) AS lag_hours, series_id, {_regression('y', 'p')}, {_events('y', 'p', 250.0)}
FROM (SELECT a.series_id, a.curtailment_mw AS y, b.curtailment_mw AS p FROM grid a
      JOIN grid b ON b.series_id = a.series_id AND b.h = a.h - {lag}) GROUP BY 2"""


add(
    "persistence_eval",
    [DISPATCH, *GRID],
    _lagged(24) + "\nUNION ALL\n" + _lagged(168),
    REGRESSION + EVENTS,
)
add(
    "backtest_persistence",
    [
        DISPATCH,
        *GRID,
        AGED,
        """tested AS (SELECT CAST(5 - age // 48 AS BIGINT) AS "window", a.curtailment_mw AS y,
  COALESCE(b.curtailment_mw, 0.0) AS p FROM aged a
  LEFT JOIN grid b ON b.series_id = a.series_id AND b.h = a.h - 168 WHERE a.age // 48 BETWEEN 1 AND 4)""",
    ],
    f"""SELECT "window", {_regression('y', 'p')}, {_events('y', 'p', 250.0)} FROM tested GROUP BY 1""",
    REGRESSION + EVENTS,
)
RANKED = [
    "tops AS (SELECT model_name, GREATEST(MAX(p), 500.0) AS top, COUNT(*) FILTER (WHERE y >= 250) AS ev, "
    "COUNT(*) FILTER (WHERE y < 250) AS ot FROM forecast_log GROUP BY 1)",
    """points AS (SELECT model_name, score, SUM(e) AS pos, SUM(1 - e) AS neg, ANY_VALUE(ev) AS ev, ANY_VALUE(ot) AS ot
  FROM (SELECT model_name, LEAST(GREATEST(p / top, 0.0), 1.0) AS score,
               CASE WHEN y >= 250 THEN 1 ELSE 0 END AS e, ev, ot FROM forecast_log JOIN tops USING (model_name))
  GROUP BY 1, 2)""",
    """cum AS (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM points
  WINDOW w AS (PARTITION BY model_name ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
]
ROC = "SUM(CAST(neg AS DOUBLE) * (tp - pos + pos / 2.0)) / ANY_VALUE(ev * ot)"
AP = "SUM(CAST(pos AS DOUBLE) * tp / (tp + fp)) / ANY_VALUE(ev)"
add(
    "roc_pr_auc",
    [DISPATCH, LOG, *RANKED],
    f"SELECT model_name, round_even({ROC}, 4) AS roc_auc, round_even({AP}, 4) AS pr_auc FROM cum GROUP BY 1",
    ["roc_auc", "pr_auc"],
)
add(
    "roc_pr_curve",
    [DISPATCH, LOG, *RANKED],
    """SELECT model_name, score, CAST(tp AS DOUBLE) / ev AS tpr, CAST(fp AS DOUBLE) / ot AS fpr,
  CAST(tp AS DOUBLE) / (tp + fp) AS "precision" FROM cum""",
    ["score", "tpr", "fpr", "precision"],
)
add(
    "roc_pr_areas",
    [
        DISPATCH,
        LOG,
        *RANKED,
        """trap AS (SELECT *, LAG(tp, 1, 0) OVER o AS tp0, LAG(fp, 1, 0) OVER o AS fp0,
  LAG(CAST(tp AS DOUBLE) / (tp + fp), 1, 1.0) OVER o AS pr0 FROM cum
  WINDOW o AS (PARTITION BY model_name ORDER BY score DESC))""",
    ],
    """SELECT model_name, COUNT(*) AS points,
  SUM(CAST(fp - fp0 AS DOUBLE) * (tp + tp0) / 2.0 / (ev * ot)) AS roc_area,
  SUM(CAST(tp - tp0 AS DOUBLE) * (CAST(tp AS DOUBLE) / (tp + fp) + pr0) / 2.0 / ev) AS pr_area
FROM trap GROUP BY 1""",
    ["roc_area", "pr_area"],
)
add(
    "model_benchmark",
    [DISPATCH, LOG, *RANKED],
    f"""SELECT * FROM (SELECT model_name, {_regression('y', 'p')}, {_events('y', 'p', 250.0)} FROM forecast_log GROUP BY 1)
JOIN (SELECT model_name, round_even({ROC}, 4) AS roc_auc, round_even({AP}, 4) AS pr_auc FROM cum GROUP BY 1)
USING (model_name)""",
    REGRESSION + EVENTS + ["roc_auc", "pr_auc"],
)
add(
    "model_benchmark_severe",
    [DISPATCH, LOG],
    f"""SELECT model_name, {season('EXTRACT(MONTH FROM target_ts)', REPORT_SEASONS)} AS season,
  {_events('y', 'p', 1000.0)} FROM forecast_log GROUP BY 1, 2""",
    EVENTS,
)

# ---- exploration ------------------------------------------------------------
add(
    "curtailment_heatmap",
    [LONG],
    "SELECT EXTRACT(MONTH FROM ts) AS month, "
    + ", ".join(f"AVG(curtailment_mw) FILTER (WHERE EXTRACT(HOUR FROM ts) = {h}) AS h{h}" for h in range(24))
    + " FROM dispatch_long GROUP BY 1",
    [f"h{h}" for h in range(24)],
)
add(
    "net_load_profile",
    [LONG],
    f"""SELECT EXTRACT(HOUR FROM ts) AS hour, {season('EXTRACT(MONTH FROM ts)', PLOT_SEASONS)} AS season,
  AVG(net_load_mw) AS avg_net_load_mw, COUNT(net_load_mw) AS hours FROM dispatch_long GROUP BY 1, 2""",
    ["avg_net_load_mw"],
)
add(
    "ramp_boxplot",
    [
        DISPATCH,
        f"ramps AS (SELECT EXTRACT(HOUR FROM ts) AS hour, net_load_mw - LAG(net_load_mw, 3) OVER ({BY_TS}) AS ramp FROM dispatch)",
        """box AS (SELECT hour, quantile_cont(ramp, 0.25) AS q1, quantile_cont(ramp, 0.5) AS median,
  quantile_cont(ramp, 0.75) AS q3 FROM ramps WHERE ramp IS NOT NULL GROUP BY 1)""",
        """sided AS (SELECT *, ramp BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
  FROM ramps JOIN box USING (hour) WHERE ramp IS NOT NULL)""",
    ],
    """SELECT hour, q1, median, q3, MIN(ramp) FILTER (WHERE inside) AS whisker_low,
  MAX(ramp) FILTER (WHERE inside) AS whisker_high, COUNT(*) FILTER (WHERE NOT inside) AS outliers, COUNT(*) AS n
FROM sided GROUP BY 1, 2, 3, 4""",
    ["q1", "median", "q3", "whisker_low", "whisker_high"],
)
PROFILE = ["mean", "std", "min", "q1", "median", "q3", "max"]
add(
    "numeric_profile",
    [SPARSE],
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS "count", round_even(AVG({c}), 2) AS mean,
  round_even(STDDEV_SAMP({c}), 2) AS std, round_even(MIN({c}), 2) AS "min", round_even(MAX({c}), 2) AS "max",
  round_even(quantile_cont({c}, 0.25), 2) AS q1, round_even(quantile_cont({c}, 0.5), 2) AS median,
  round_even(quantile_cont({c}, 0.75), 2) AS q3 FROM dispatch"""
        for c in MEASURES
    ),
    PROFILE,
)
add(
    "column_info",
    [SPARSE],
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, COUNT({c}) AS non_null FROM dispatch"
        for c, kind in {"series_id": "bigint", "ts": "timestamp"}.items() | dict.fromkeys(MEASURES, "double").items()
    ),
)
add(
    "event_hours",
    [DISPATCH],
    "SELECT series_id, ts, curtailment_mw FROM dispatch WHERE curtailment_mw > 250",
    ["curtailment_mw"],
)
CORRELATED = [
    "system_demand_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "nuclear_mw",
    "hydro_mw",
    "net_load_mw",
    "temperature_c",
    "wind_speed_mps",
    "ghi_estimated",
    "curtailment_mw",
]
add(
    "correlation_matrix",
    [DISPATCH],
    "\nUNION ALL ".join(
        [f"SELECT '{a}' AS a, '{b}' AS b, CORR({a}, {b}) AS r FROM dispatch" for a, b in combinations(CORRELATED, 2)]
        + [f"SELECT '{b}', '{a}', CORR({a}, {b}) FROM dispatch" for a, b in combinations(CORRELATED, 2)]
        + [f"SELECT '{c}', '{c}', 1.0" for c in CORRELATED]
    ),
    ["r"],
)
add(
    "overgeneration_estimate",
    [DISPATCH],
    f"""SELECT series_id, ts, net_load_mw, solar_generation_mw,
  CASE WHEN EXTRACT(HOUR FROM {local()}) BETWEEN 9 AND 17 AND raw > 150 THEN LEAST(raw, 4800.0) ELSE 0.0 END AS overgeneration_mw
FROM (SELECT *, GREATEST(0.0, (4500 - net_load_mw) * CASE WHEN solar_generation_mw > 11000 THEN 1.25 ELSE 1.0 END) AS raw
      FROM dispatch)""",
    ["net_load_mw", "solar_generation_mw", "overgeneration_mw"],
)

# ---- forecasting ------------------------------------------------------------
add(
    "model_frame",
    [SPARSE],
    """SELECT series_id, ts AS ds, curtailment_mw AS y, COALESCE(net_load_mw, 0.0) AS net_load_mw,
  CAST(0 AS DOUBLE) AS temperature_c, COALESCE(wind_speed_mps, 0.0) AS wind_speed_mps FROM dispatch""",
    ["y", "net_load_mw", "temperature_c", "wind_speed_mps"],
)
DIFF = [
    DISPATCH,
    LOG,
    WIDE,
    """fixed AS (SELECT series_id, CAST(prophet_mw AS DECIMAL(17,6)) AS p, CAST(lstm_mw AS DECIMAL(17,6)) AS l,
  CAST(actual_curtailment_mw AS DECIMAL(17,6)) AS a FROM wide)""",
    "diff AS (SELECT series_id, CAST(p - l AS DECIMAL(17,6)) AS d, CAST(a - l AS DECIMAL(17,6)) AS e FROM fixed)",
]


def _blend(key: str, group: str) -> str:
    d, e = "CAST(d AS DECIMAL(19,6))", "CAST(e AS DECIMAL(19,6))"
    sums = {"sd": "d", "se": "e", "dd": f"{d} * {d}", "ee": f"{e} * {e}", "de": f"{d} * {e}"}
    moments = ", ".join(f"CAST(SUM({x}) AS DOUBLE) AS {name}" for name, x in sums.items())
    return f"""SELECT {key} AS series_id, w1, 1 - w1 AS w2, SQRT(GREATEST(
  (ee - 2 * w1 * de + w1 * w1 * dd) / n - ((se - w1 * sd) / n) * ((se - w1 * sd) / n), 0)) AS residual_std, n
FROM (SELECT *, COALESCE(LEAST(GREATEST(de / NULLIF(dd, 0), 0), 1), 0.5) AS w1
      FROM (SELECT {group or '1 AS one'}, {moments}, COUNT(*) AS n
            FROM diff WHERE d IS NOT NULL AND e IS NOT NULL {'GROUP BY ' + group if group else ''}))"""


add(
    "blend_weights",
    DIFF,
    _blend("series_id", "series_id") + "\nUNION ALL\n" + _blend("CAST(-1 AS BIGINT)", ""),
    ["w1", "w2", "residual_std"],
)
STACKED = f"""SELECT series_id, ts, round_even(prophet_mw, 1) AS prophet_mw, round_even(lstm_mw, 1) AS lstm_mw,
  round_even(mw, 1) AS ensemble_mw, round_even(GREATEST(0.0, mw - half), 1) AS lower_bound_mw,
  round_even(mw + half, 1) AS upper_bound_mw, {tier('mw')} AS curtailment_alert,
  {PROB.format(x='mw')} AS curtailment_event_prob FROM mixed"""
STACKED_DOUBLES = ["prophet_mw", "lstm_mw", "ensemble_mw", "lower_bound_mw", "upper_bound_mw", "curtailment_event_prob"]
add(
    "stacked_forecast",
    [
        *DIFF,
        f"weights AS ({_blend('series_id', 'series_id')})",
        """mixed AS (SELECT series_id, ts, prophet_mw, lstm_mw, GREATEST(0.0, lstm_mw + w1 * (prophet_mw - lstm_mw)) AS mw,
  1.645 * GREATEST(residual_std, 25.0) AS half FROM wide JOIN weights USING (series_id))""",
    ],
    STACKED,
    STACKED_DOUBLES,
)
DESIGN = [
    "CAST(1 AS DOUBLE)",
    "eh / 8760",
    *[f"{f}({PI2} * {k} * eh / 24.0)" for k in (1, 2, 3) for f in ("sin", "cos")],
    "net_load_mw / 1000",
    "solar_elevation_deg",
    "temperature_c",
    "wind_speed_mps",
]
add(
    "seasonal_ridge_grams",
    [
        DISPATCH,
        *GRID,
        f"started AS (SELECT grid.*, {ELAPSED} FROM grid JOIN span USING (series_id))",
        *_sun("started"),
        "design AS (SELECT series_id, curtailment_mw / 1000 AS y, "
        + ", ".join(f"{x} AS x{i}" for i, x in enumerate(DESIGN))
        + " FROM sun)",
    ],
    "\nUNION ALL ".join(
        [
            f"SELECT series_id, CAST({i * 12 + j} AS BIGINT) AS cell, SUM(x{i} * x{j}) AS value FROM design GROUP BY 1"
            for i in range(12)
            for j in range(12)
        ]
        + [
            f"SELECT series_id, CAST({i - 12} AS BIGINT), SUM(x{i} * y) FROM design GROUP BY 1"
            for i in range(12)
        ]
    ),
    ["value"],
)


DESIGN_MW = [x.replace(" / 1000", "") for x in DESIGN]
STARTED = [DISPATCH, *GRID, f"started AS (SELECT grid.*, {ELAPSED} FROM grid JOIN span USING (series_id))", *_sun("started")]
XS = ", ".join(f"x{i}" for i in range(len(DESIGN)))
MODEL = [
    *STARTED,
    "design AS (SELECT series_id, ts, curtailment_mw AS y, " + ", ".join(f"{x} AS x{i}" for i, x in enumerate(DESIGN_MW)) + " FROM sun)",
]
YHAT = "GREATEST(0.0, " + " + ".join(f"beta[{i + 1}] * x{i}" for i in range(len(DESIGN))) + ")"
add(
    "seasonal_ridge_fit",
    [*MODEL, *_solved("design", "series_id", DESIGN, 10)],
    f"""SELECT series_id, n, CAST(term AS BIGINT) AS term, beta[term + 1] AS beta
FROM solved, (SELECT UNNEST(range({len(DESIGN)})) AS term)""",
    ["beta"],
)
add(
    "seasonal_ridge_forecast",
    [
        *MODEL,
        "trained AS (SELECT design.* FROM design JOIN span USING (series_id) WHERE ts < hi + INTERVAL 1 HOUR - INTERVAL 216 HOUR)",
        *_solved("trained", "series_id", DESIGN, 10),
        f"""scored AS (SELECT series_id, ts, y, {YHAT} AS yhat FROM design JOIN solved USING (series_id) JOIN span USING (series_id)
  WHERE ts > hi - INTERVAL 48 HOUR)""",
        "banded AS (SELECT *, 1.96 * (STDDEV_POP(yhat) OVER (PARTITION BY series_id) * 0.15 + 20.0) AS reach FROM scored)",
    ],
    """SELECT series_id, ts, y AS curtailment_mw, yhat, GREATEST(0.0, yhat - reach) AS yhat_lower, yhat + reach AS yhat_upper FROM banded""",
    ["curtailment_mw", "yhat", "yhat_lower", "yhat_upper"],
)
CUTOFFS = f"""cutoffs AS (SELECT series_id, k, hi + INTERVAL 1 HOUR - INTERVAL 120 HOUR * k - INTERVAL 48 HOUR AS test_start,
  hi + INTERVAL 1 HOUR - INTERVAL 120 HOUR * k AS test_end
  FROM (SELECT *, UNNEST(range(({hours('hi')} - {hours('lo')} - 408) // 120 + 1)) AS k FROM span
        WHERE {hours('hi')} - {hours('lo')} >= 408))"""


def _cross_validation(name: str, ctes: list[str], terms: list[str], y: str, yhat: str) -> None:
    """Cutoffs every 5 days after 15 days of history, 2 days ahead."""
    add(
        name,
        [
            *ctes,
            CUTOFFS,
            f"""trained AS (SELECT series_id, k, {y} AS y, {', '.join(f'x{i}' for i in range(len(terms)))}
  FROM design JOIN cutoffs USING (series_id) WHERE ts < test_start)""",
            *_solved("trained", "series_id, k", terms, 10),
            f"""scored AS (SELECT series_id, {hours('ts')} - {hours('test_start')} AS ahead, y, GREATEST(0.0, {yhat}) AS yhat
  FROM design JOIN cutoffs USING (series_id) JOIN solved USING (series_id, k) WHERE ts >= test_start AND ts < test_end)""",
            """ahead AS (SELECT series_id, ahead, COUNT(*) AS n, AVG(ABS(y - yhat)) AS mae, SQRT(AVG((y - yhat) * (y - yhat))) AS rmse,
  COALESCE(AVG(ABS((y - yhat) / y)) FILTER (WHERE ABS(y) > 1e-2) * 100, 0) AS mape FROM scored GROUP BY 1, 2)""",
        ],
        """SELECT series_id, COUNT(*) AS horizons, CAST(SUM(n) AS BIGINT) AS n, round_even(AVG(mae), 4) AS mae,
  round_even(AVG(rmse), 4) AS rmse, round_even(AVG(mape), 4) AS mape FROM ahead GROUP BY 1""",
        ["mae", "rmse", "mape"],
    )


_cross_validation("cross_validation", MODEL, DESIGN, "y", " + ".join(f"beta[{i + 1}] * x{i}" for i in range(len(DESIGN))))


def _fixed_holiday(d: str) -> str:
    return f"""CASE WHEN month({d}) = 1 AND day({d}) = 1 THEN 'New Year''s Day'
  WHEN month({d}) = 6 AND day({d}) = 19 AND year({d}) >= 2021 THEN 'Juneteenth'
  WHEN month({d}) = 7 AND day({d}) = 4 THEN 'Independence Day'
  WHEN month({d}) = 11 AND day({d}) = 11 THEN 'Veterans Day'
  WHEN month({d}) = 12 AND day({d}) = 25 THEN 'Christmas Day' END"""


HOLIDAYS = f"""days AS (SELECT ts, curtailment_mw, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS d
  FROM dispatch_long),
named AS (SELECT *, COALESCE({_fixed_holiday('d')}, CASE
  WHEN month(d) = 1 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
  WHEN month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Washington''s Birthday'
  WHEN month(d) = 5 AND isodow(d) = 1 AND day(d) >= 25 THEN 'Memorial Day'
  WHEN month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7 THEN 'Labor Day'
  WHEN month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14 THEN 'Columbus Day'
  WHEN month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving' END,
  CASE WHEN isodow(d) = 5 THEN {_fixed_holiday('(d + 1)')} || ' (observed)'
  WHEN isodow(d) = 1 THEN {_fixed_holiday('(d - 1)')} || ' (observed)' END) AS holiday
  FROM days)"""
add(
    "holiday_lookup",
    [LONG, HOLIDAYS],
    """SELECT holiday, CAST(CASE WHEN holiday IS NULL THEN 0 ELSE 1 END AS BIGINT) AS is_holiday,
  COUNT(*) AS hours, AVG(curtailment_mw) AS avg_curtailment_mw FROM named GROUP BY 1, 2""",
    ["avg_curtailment_mw"],
)
FULL_CYCLES = {"d": (24.0, 8), "w": (168.0, 3), "a": (8766.0, 10)}
FULL_DESIGN = [
    *DESIGN_MW[:2],
    *[f"{f}({PI2} * {k} * eh / {n})" for n, top in FULL_CYCLES.values() for k in range(1, top + 1) for f in ("sin", "cos")],
    *DESIGN_MW[-4:],
    "CAST(CASE WHEN holiday IS NULL THEN 0 ELSE 1 END AS DOUBLE)",
]
_cross_validation(
    "full_seasonal_cross_validation",
    [
        *STARTED,
        HOLIDAYS.replace("ts, curtailment_mw,", "*,").replace("dispatch_long", "sun"),
        "design AS (SELECT series_id, ts, curtailment_mw AS y, " + ", ".join(f"{x} AS x{i}" for i, x in enumerate(FULL_DESIGN)) + " FROM named)",
    ],
    FULL_DESIGN,
    "LN(1 + GREATEST(y, 0.0))",
    "EXP(" + " + ".join(f"beta[{i + 1}] * x{i}" for i in range(len(FULL_DESIGN))) + ") - 1",
)
# hours after the data: the newest run out by then is the second, two percent above the week before
AHEAD = [
    "ahead AS (SELECT series_id, lo, hi + INTERVAL 1 HOUR * k AS ts FROM span, (SELECT UNNEST(range(1, 49)) AS k))",
    "driven AS (SELECT a.series_id, a.ts, a.lo, "
    + ", ".join(f"COALESCE(d.{c} * 1.02, g.{c}) AS {c}" for c in ("net_load_mw", "temperature_c", "wind_speed_mps"))
    + """ FROM ahead a LEFT JOIN dispatch d ON d.series_id = a.series_id AND d.ts = a.ts - INTERVAL 168 HOUR
  LEFT JOIN grid g ON g.series_id = a.series_id AND g.ts = a.ts - INTERVAL 168 HOUR)""",
]
_inputs = "net_load_mw, temperature_c, wind_speed_mps"
add(
    "future_frame",
    [DISPATCH, *GRID, *AHEAD, f"started AS (SELECT series_id, ts, {_inputs}, {ELAPSED} FROM driven)", *_sun("started")],
    f"""SELECT sun.* EXCLUDE (eh), hi + INTERVAL 1 HOUR AS origin_ts, {CALENDAR_SQL}, {CYCLE_SQL}, {DAYLIGHT}, {FOURIER_SQL}
FROM sun JOIN span USING (series_id)""",
    ["net_load_mw", "temperature_c", "wind_speed_mps", "solar_elevation_deg", *CYCLE_COLUMNS, *FOURIER],
)
add(
    "forecast_future_naive",
    [
        DISPATCH,
        *GRID,
        *AHEAD,
        f"""started AS (SELECT series_id, ts, curtailment_mw, {_inputs}, {ELAPSED} FROM grid JOIN span USING (series_id)
  UNION ALL SELECT series_id, ts, NULL, {_inputs}, {ELAPSED} FROM driven)""",
        *_sun("started"),
        "design AS (SELECT series_id, ts, curtailment_mw AS y, " + ", ".join(f"{x} AS x{i}" for i, x in enumerate(DESIGN_MW)) + " FROM sun)",
        "trained AS (SELECT design.* FROM design JOIN span USING (series_id) WHERE ts < hi + INTERVAL 1 HOUR - INTERVAL 168 HOUR)",
        *_solved("trained", "series_id", DESIGN, 10),
        f"""both_models AS (SELECT d.series_id, d.ts, y, {YHAT} AS prophet_mw, g.curtailment_mw AS lstm_mw, d.ts > hi AS later
  FROM design d JOIN solved USING (series_id) JOIN span USING (series_id)
  JOIN grid g ON g.series_id = d.series_id AND g.ts = d.ts - INTERVAL 168 HOUR WHERE d.ts > hi - INTERVAL 168 HOUR)""",
        """fixed AS (SELECT series_id, CAST(prophet_mw AS DECIMAL(17,6)) AS p, CAST(lstm_mw AS DECIMAL(17,6)) AS l,
  CAST(y AS DECIMAL(17,6)) AS a FROM both_models WHERE NOT later)""",
        DIFF[-1],
        f"weights AS ({_blend('series_id', 'series_id')})",
        """mixed AS (SELECT series_id, ts, prophet_mw, lstm_mw, GREATEST(0.0, lstm_mw + w1 * (prophet_mw - lstm_mw)) AS mw,
  1.645 * GREATEST(residual_std, 25.0) AS half FROM both_models JOIN weights USING (series_id) WHERE later)""",
    ],
    STACKED,
    STACKED_DOUBLES,
)
# the direct model with one feature: 48 hours of net load to 48 hours of curtailment
_hours = range(48)
DIRECT = [
    "lagged AS (SELECT series_id, ts, "
    + ", ".join(f"LAG(net_load_mw, {48 - k}) OVER ({BY_TS}) AS a{k}, LEAD(curtailment_mw, {k}) OVER ({BY_TS}) AS c{k}" for k in _hours)
    + " FROM grid)",
    """scaler AS (SELECT series_id, "window", ANY_VALUE(train_end) AS train_end, ANY_VALUE(test_start) AS test_start,
  quantile_cont(net_load_mw, 0.5) AS mid, quantile_cont(net_load_mw, 0.75) - quantile_cont(net_load_mw, 0.25) AS iqr,
  MIN(curtailment_mw) AS low, MAX(curtailment_mw) - MIN(curtailment_mw) AS wide
  FROM grid JOIN wins USING (series_id) WHERE ts < train_end GROUP BY 1, 2)""",
    """scaled AS (SELECT series_id, "window", ts, train_end, test_start, low, CASE WHEN wide = 0 THEN 1 ELSE wide END AS wide, 1.0 AS x0, """
    + ", ".join(f"(a{k} - mid) / CASE WHEN iqr = 0 THEN 1 ELSE iqr END AS x{k + 1}" for k in _hours)
    + ", "
    + ", ".join(f"(c{k} - low) / CASE WHEN wide = 0 THEN 1 ELSE wide END AS y{k}" for k in _hours)
    + " FROM lagged JOIN scaler USING (series_id))",
    "taught AS (SELECT * FROM scaled WHERE ts + INTERVAL 47 HOUR < train_end AND x1 IS NOT NULL AND y47 IS NOT NULL)",
]
DIRECT_YHAT = "GREATEST(0.0, GREATEST(0.0, " + " + ".join(f"direct.beta[{i + 1}] * x{i}" for i in range(49)) + ") * wide + low)"
DIRECT_SOLVED = [
    x.replace("solved AS", "direct AS", 1) if x.startswith("solved") else x for x in _solved("taught", 'series_id, "window"', [""] * 49, 50, 48)
]
DIRECT_ROWS = f"""SELECT series_id, "window", test_start + INTERVAL 1 HOUR * step AS ts, step, {DIRECT_YHAT} AS yhat
  FROM scaled JOIN direct USING (series_id, "window") WHERE ts = test_start"""
add(
    "multi_horizon_ridge_net_load",
    [
        DISPATCH,
        *GRID,
        """wins AS (SELECT series_id, 1 AS "window", hi - INTERVAL 47 HOUR AS test_start, hi - INTERVAL 215 HOUR AS train_end FROM span)""",
        *DIRECT,
        *DIRECT_SOLVED,
    ],
    f"""SELECT series_id, ts, step, yhat FROM ({DIRECT_ROWS})""",
    ["yhat"],
)
_prefixed = [re.sub(r"\b([fdzw])(\d+)\b", r"s\1\2", x) for x in _solved("trained", 'series_id, "window"', DESIGN, 10)]
add(
    "rolling_backtest_net_load",
    [
        *MODEL,
        """wins AS (SELECT series_id, w AS "window", hi + INTERVAL 1 HOUR - INTERVAL 48 HOUR * (5 - w) AS test_end,
  hi + INTERVAL 1 HOUR - INTERVAL 48 HOUR * (6 - w) AS test_start,
  hi + INTERVAL 1 HOUR - INTERVAL 48 HOUR * (6 - w) - INTERVAL 168 HOUR AS train_end FROM span, (VALUES (1), (2), (3), (4)) AS v(w))""",
        *DIRECT,
        *DIRECT_SOLVED,
        """trained AS (SELECT "window", design.* FROM design JOIN wins USING (series_id) WHERE ts < train_end)""",
        *_prefixed,
        f"seasonal AS (SELECT design.*, \"window\", {YHAT} AS p1 FROM design JOIN wins USING (series_id) JOIN solved USING (series_id, \"window\") "
        "WHERE ts >= test_start AND ts < test_end)",
        f"""tested AS (SELECT s.series_id, s.ts, s.y, p1, x.yhat AS p2, COALESCE(g.curtailment_mw, 0.0) AS p0
  FROM seasonal s JOIN ({DIRECT_ROWS}) x USING (series_id, "window", ts)
  LEFT JOIN grid g ON g.series_id = s.series_id AND g.ts = s.ts - INTERVAL 168 HOUR)""",
        """forecast_log AS (SELECT y, p0 AS p, 'Persistence_168h' AS model_name FROM tested UNION ALL SELECT y, p1, 'Prophet' FROM tested
  UNION ALL SELECT y, p2, 'LSTM' FROM tested
  UNION ALL SELECT y, round_even(GREATEST(0.0, p2 + 0.4 * (p1 - p2)), 1), 'Stacked_Ensemble' FROM tested)""",
        *RANKED,
    ],
    f"""SELECT model_name AS model, * EXCLUDE (model_name)
FROM (SELECT model_name, {_regression('y', 'p')}, {_events('y', 'p', 250.0)} FROM forecast_log GROUP BY 1)
JOIN (SELECT model_name, round_even({ROC}, 4) AS roc_auc, round_even({AP}, 4) AS pr_auc FROM cum GROUP BY 1) USING (model_name)""",
    REGRESSION + EVENTS + ["roc_auc", "pr_auc"],
)
# the newest two days: blended on six validation origins a day apart, 24 hours of each
_direct_at = f"""SELECT series_id, scaled.ts + INTERVAL 1 HOUR * step AS ts, scaled.ts AS origin, test_start, step, {DIRECT_YHAT} AS yhat
  FROM scaled JOIN direct USING (series_id, "window")"""
add(
    "forecast_48h_net_load",
    [
        *MODEL,
        """wins AS (SELECT series_id, 1 AS "window", hi - INTERVAL 47 HOUR AS test_start, hi - INTERVAL 215 HOUR AS train_end FROM span)""",
        *DIRECT,
        *DIRECT_SOLVED,
        "trained AS (SELECT design.* FROM design JOIN wins USING (series_id) WHERE ts < train_end)",
        *[re.sub(r"\b([fdzw])(\d+)\b", r"s\1\2", x) for x in _solved("trained", "series_id", DESIGN, 10)],
        f"""both_models AS (SELECT d.series_id, d.ts, y, {YHAT} AS prophet_mw, x.yhat AS lstm_mw, x.origin = x.test_start AS later
  FROM design d JOIN solved USING (series_id) JOIN ({_direct_at}) x USING (series_id, ts)
  WHERE x.origin = x.test_start OR (step < 24 AND x.origin <= x.test_start - INTERVAL 48 HOUR
    AND x.origin >= x.test_start - INTERVAL 168 HOUR AND date_diff('hour', x.origin, x.test_start) % 24 = 0))""",
        """fixed AS (SELECT series_id, CAST(prophet_mw AS DECIMAL(17,6)) AS p, CAST(lstm_mw AS DECIMAL(17,6)) AS l,
  CAST(y AS DECIMAL(17,6)) AS a FROM both_models WHERE NOT later)""",
        DIFF[-1],
        f"weights AS ({_blend('series_id', 'series_id')})",
        """mixed AS (SELECT series_id, ts, prophet_mw, lstm_mw, GREATEST(0.0, lstm_mw + w1 * (prophet_mw - lstm_mw)) AS mw,
  1.645 * GREATEST(residual_std, 25.0) AS half FROM both_models JOIN weights USING (series_id) WHERE later)""",
    ],
    STACKED,
    STACKED_DOUBLES,
)
add(
    "holdout_net_load",
    [
        DISPATCH,
        *GRID,
        f"""wins AS (SELECT series_id, 1 AS "window", hi AS test_start, lo + INTERVAL 1 HOUR *
  (CAST(FLOOR(({hours('hi')} - {hours('lo')} + 1 - 95) * CAST(0.85 AS DOUBLE)) AS BIGINT) + 95) AS train_end FROM span)""",
        *DIRECT,
        *DIRECT_SOLVED,
        f"""errors AS (SELECT series_id, origin, g.curtailment_mw - yhat AS e FROM ({_direct_at.replace('test_start,', 'train_end,')}) x
  JOIN grid g USING (series_id, ts) JOIN span USING (series_id) WHERE origin >= train_end - INTERVAL 47 HOUR AND origin <= hi - INTERVAL 47 HOUR)""",
    ],
    """SELECT series_id, COUNT(DISTINCT origin) AS sequences, COUNT(*) AS hours, AVG(ABS(e)) AS mae, SQRT(AVG(e * e)) AS rmse
FROM errors GROUP BY 1""",
    ["mae", "rmse"],
)


def _face(members: tuple[int, ...]) -> str:
    """The optimum over some of three forecasts, by their inverse matrix times ones; NULL where a weight would be negative."""
    if len(members) == 1:
        inverse = {members[0]: "1.0"}
    elif len(members) == 2:
        a, b = members
        inverse = {a: f"({_cell(b, b)} - {_cell(a, b)})", b: f"({_cell(a, a)} - {_cell(a, b)})"}
    else:
        minors = [
            [f"({_cell((i + 1) % 3, (j + 1) % 3)} * {_cell((i + 2) % 3, (j + 2) % 3)} - {_cell((i + 1) % 3, (j + 2) % 3)} * {_cell((i + 2) % 3, (j + 1) % 3)})" for j in range(3)]
            for i in range(3)
        ]
        inverse = {i: "(" + " + ".join(minors[i]) + ")" for i in range(3)}
    whole = "(" + " + ".join(inverse.values()) + ")"
    return "[" + ", ".join(f"{inverse[i]} / {whole}" if i in inverse else "0.0" for i in range(3)) + "]"


def _cell(i: int, j: int) -> str:
    return f"(e{min(i, j)}{max(i, j)}{' + pull' if i == j else ''})"


_errors = ["prophet_mw", "lstm_mw", "ensemble_mw"]
_pairs = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
add(
    "simplex_blend",
    [
        DISPATCH,
        LOG,
        WIDE,
        "errors AS (SELECT series_id, "
        + ", ".join(f"CAST(CAST(actual_curtailment_mw AS DECIMAL(17,6)) - CAST({c} AS DECIMAL(17,6)) AS DECIMAL(19,6)) AS e{i}" for i, c in enumerate(_errors))
        + " FROM wide)",
        "moments AS (SELECT series_id, COUNT(*) AS n, "
        + ", ".join(f"CAST(SUM(e{i} * e{j}) AS DOUBLE) AS e{i}{j}" for i, j in _pairs)
        + ", "
        + ", ".join(f"CAST(SUM(e{i}) AS DOUBLE) AS s{i}" for i in range(3))
        + " FROM errors WHERE e0 IS NOT NULL AND e1 IS NOT NULL AND e2 IS NOT NULL GROUP BY 1)",
        "pulled AS (SELECT *, 1e-9 * GREATEST((e00 + e11 + e22) / 3, 1e-6) AS pull FROM moments)",
        "faces AS (SELECT *, UNNEST(["
        + ", ".join(_face(f) for k in (1, 2, 3) for f in combinations(range(3), k))
        + "]) AS w FROM pulled)",
        "costs AS (SELECT *, "
        + " + ".join(f"{1 if i == j else 2} * w[{i + 1}] * w[{j + 1}] * {_cell(i, j)}" for i, j in _pairs)
        + " AS cost FROM faces WHERE list_min(w) >= 0)",
        "best AS (SELECT * FROM costs QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY cost) = 1)",
    ],
    "SELECT series_id, n, w[1] AS w1, w[2] AS w2, w[3] AS w3, SQRT(GREATEST(("
    + " + ".join(f"{1 if i == j else 2} * w[{i + 1}] * w[{j + 1}] * e{i}{j}" for i, j in _pairs)
    + ") / n - POWER((w[1] * s0 + w[2] * s1 + w[3] * s2) / n, 2), 0)) AS residual_std FROM best",
    ["w1", "w2", "w3", "residual_std"],
)
add(
    "blend_evaluation",
    [
        *DIFF,
        f"weights AS ({_blend('series_id', 'series_id')})",
        """blended AS (SELECT series_id, actual_curtailment_mw AS y, GREATEST(0.0, lstm_mw + w1 * (prophet_mw - lstm_mw)) AS p, w1, w2
  FROM wide JOIN weights USING (series_id))""",
    ],
    f"""SELECT series_id, {_regression('y', 'p')}, {_events('y', 'p', 250.0)}, ANY_VALUE(w1) AS weight_prophet_mw,
  ANY_VALUE(w2) AS weight_lstm_mw FROM blended WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1""",
    [*REGRESSION, *EVENTS, "weight_prophet_mw", "weight_lstm_mw"],
)
add(
    "latest_forecast",
    [DISPATCH, LOG, WIDE],
    """SELECT series_id, ts, CASE WHEN hour(ts) >= 12 THEN ensemble_mw + 10 ELSE ensemble_mw END AS ensemble_mw, net_load_mw,
  CASE WHEN hour(ts) >= 12 THEN '2024-01-02' ELSE '2024-01-01' END AS run FROM wide""",
    ["ensemble_mw", "net_load_mw"],
)
add("available_columns", [DISPATCH], "SELECT ts, net_load_mw, series_id FROM dispatch", ["net_load_mw"])
_past = f"({BY_TS} ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING)"
_next = f"({BY_TS} ROWS BETWEEN CURRENT ROW AND 47 FOLLOWING)"
add(
    "sequences",
    [
        DISPATCH,
        *GRID,
        f"""framed AS (SELECT series_id, ts, LAG(net_load_mw, 48) OVER ({BY_TS}) AS first_net_load,
  LAG(solar_generation_mw, 1) OVER ({BY_TS}) AS last_solar,
  SUM(net_load_mw + solar_generation_mw) OVER {_past} AS x_sum, SUM(curtailment_mw) OVER {_next} AS y_sum,
  COUNT(*) OVER {_past} AS np, COUNT(*) OVER {_next} AS nn FROM grid)""",
    ],
    """SELECT series_id, ts, CAST(96 AS BIGINT) AS x_size, first_net_load, last_solar, x_sum, y_sum
FROM framed WHERE np = 48 AND nn = 48""",
    ["first_net_load", "last_solar", "x_sum", "y_sum"],
)
_scaled = ["net_load_mw", "solar_generation_mw", "thermal_gas_mw"]
add(
    "scaler_statistics",
    [DISPATCH, *GRID],
    "SELECT series_id, MIN(curtailment_mw) AS y_min, "
    "COALESCE(NULLIF(MAX(curtailment_mw) - MIN(curtailment_mw), 0), 1) AS y_range, "
    + ", ".join(
        f"quantile_cont({c}, 0.5) AS center_{c}, "
        f"COALESCE(NULLIF(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) AS scale_{c}"
        for c in _scaled
    )
    + " FROM grid GROUP BY 1",
    ["y_min", "y_range", *[f"center_{c}" for c in _scaled], *[f"scale_{c}" for c in _scaled]],
)

# ---- streaming --------------------------------------------------------------
CLOSED = """closed AS (SELECT * FROM dispatch
  WHERE ts + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 2 HOUR)"""
ROLLED_UP = [c for c in MEASURES[:5]] + ["curtailment_mw", "net_load_mw"]
add(
    "stream_hourly_rollup",
    [
        DISPATCH,
        CLOSED,
        """sizes AS (SELECT CAST(user_id // 50 AS BIGINT) AS series_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts,
  COUNT(*) AS records FROM events GROUP BY 1, 2)""",
    ],
    f"SELECT series_id, ts, {', '.join(ROLLED_UP)}, records FROM closed JOIN sizes USING (series_id, ts)",
    ROLLED_UP,
)
add(
    "stream_ramp",
    [DISPATCH, CLOSED],
    f"""SELECT * FROM (SELECT series_id, ts, net_load_mw, net_load_mw - LAG(net_load_mw, 3) OVER ({BY_TS}) AS ramp FROM closed)
WHERE ts < (SELECT MAX(ts) FROM closed) - INTERVAL 2 HOUR""",
    ["net_load_mw", "ramp"],
)
add(
    "stream_alerts",
    [DISPATCH, LOG, WIDE],
    """SELECT series_id, ts, ensemble_mw AS mw, curtailment_alert AS tier, curtailment_event_prob AS probability
FROM wide WHERE ensemble_mw >= 250""",
    ["mw", "probability"],
)
ORACLES["stream_kpi_refresh"] = ORACLES["kpi_summary"]
ORACLES["scorecard_round_trip"] = ORACLES["forecast_scorecard"]
add("model_state", [*DIFF], _blend("series_id", "series_id"), ["w1", "w2", "residual_std"])
add(
    "station_stack",
    [WEATHER],
    """SELECT station_id, ts, temperature_c,
  CASE WHEN station_id <> (SELECT MIN(station_id) FROM weather) THEN wind_speed_mps END AS wind_speed_mps FROM weather""",
    ["temperature_c", "wind_speed_mps"],
)
add(
    "scaled_and_inverted",
    [DISPATCH, *GRID],
    f"""SELECT series_id, ts, {', '.join(
        f"(g.{c} - center_{c}) / scale_{c} AS {c}" for c in _scaled[:2]
    )}, curtailment_mw FROM grid g JOIN (SELECT series_id, {', '.join(
        f"quantile_cont({c}, 0.5) AS center_{c}, "
        f"COALESCE(NULLIF(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) AS scale_{c}"
        for c in _scaled[:2]
    )} FROM grid GROUP BY 1) USING (series_id)""",
    [*_scaled[:2], "curtailment_mw"],
)
ORACLES["stream_replays"] = ORACLES["stream_hourly_rollup"]
