"""The forecaster as SQL (DuckDB), for the oracle side only.

Written from the model's definition on the zero-filled grid: every period of a
series is a row, the candidates are evaluated point by point, their errors are
summed from residual rows, and the trend is the engine's own regression. The
Spark side never builds that grid (it works from per-series sums), so the two
share no formula; floats are compared at 6 places.
"""

from __future__ import annotations

SEASON_COLS = [f"season_w{w}" for w in range(7)]
FLOATS = {"score", "sigma", "y_mean", "y_last", "drift", "intercept", "slope", "t_mean", "sxx", "holiday_effect", *SEASON_COLS}


def rounded(cols: str) -> str:
    """The column list with its floats rounded to 6 places."""
    return ", ".join(f"round({c}, 6) AS {c}" if c in FLOATS else c for c in cols.split(", "))


def fit_ctes(name: str, src: str, step: int, season: bool = False) -> list[str]:
    """CTE ``{name}_fit`` over ``src(variant_id, ts, y)``, one row per series."""
    weekday = f"(epoch(ts)::BIGINT // 86400) % 7"
    seasonal = (f"UNION ALL SELECT variant_id, 'trend_season', 9, sum((y - fitted - shift) ^ 2) FILTER (WHERE t > 0) "
                f"FROM {name}_shifted WHERE n >= 21 GROUP BY ALL" if season else "")
    shifts = ", ".join(f"any_value(shift) FILTER (WHERE wd = {w})" + (" " if season else "* NULL ") + f"AS season_w{w}" for w in range(7))
    empty = "0" if season else "NULL"
    return [
        f"""{name}_grid AS (
  SELECT g.variant_id, g.ts, ifnull(s.y, 0)::DOUBLE AS y,
         row_number() OVER (PARTITION BY g.variant_id ORDER BY g.ts) - 1 AS t, count(*) OVER (PARTITION BY g.variant_id) AS n,
         {weekday.replace("ts", "g.ts")} AS wd
  FROM (SELECT variant_id, unnest(generate_series(min(ts), max(ts), INTERVAL {step} DAY))::DATE AS ts FROM {src} GROUP BY variant_id) g
  LEFT JOIN {src} s ON s.variant_id = g.variant_id AND s.ts = g.ts)""",
        f"""{name}_line AS (
  SELECT variant_id, any_value(n) AS n, max(ts) AS last_ts, avg(y) AS y_mean, arg_max(y, t) AS y_last, arg_min(y, t) AS y_first,
         avg(t) AS t_mean, sum(t * t) - sum(t) * avg(t) AS sxx, ifnull(stddev_samp(y), 0) AS spread,
         CASE WHEN any_value(n) > 1 THEN regr_slope(y, t) END AS slope, CASE WHEN any_value(n) > 1 THEN regr_intercept(y, t) END AS intercept
  FROM {name}_grid GROUP BY ALL)""",
        f"""{name}_points AS (
  SELECT g.*, l.y_mean, (l.y_last - l.y_first) / nullif(g.n - 1, 0) AS drift, l.intercept + l.slope * g.t AS fitted,
         lag(y) OVER (PARTITION BY variant_id ORDER BY t) AS before
  FROM {name}_grid g JOIN {name}_line l USING (variant_id))""",
        f"""{name}_shifted AS (
  SELECT *, avg(y - fitted) OVER (PARTITION BY variant_id, wd) AS shift FROM {name}_points)""",
        f"""{name}_errors AS (
  SELECT variant_id, 'mean' AS model, 1 AS k, sum((y - y_mean) ^ 2) FILTER (WHERE t > 0) AS sse FROM {name}_points GROUP BY ALL
  UNION ALL SELECT variant_id, 'last', 1, sum((y - before) ^ 2) FROM {name}_points GROUP BY ALL
  UNION ALL SELECT variant_id, 'drift', 2, sum((y - before - drift) ^ 2) FROM {name}_points GROUP BY ALL
  UNION ALL SELECT variant_id, 'trend', 2, sum((y - fitted) ^ 2) FILTER (WHERE t > 0) FROM {name}_points GROUP BY ALL
  {seasonal})""",
        f"""{name}_choice AS (
  SELECT variant_id, min({{'score': round((n - 1) * ln(greatest(sse, 1e-9) / (n - 1)) + 2 * k, 6), 'k': k, 'model': e.model, 'sse': sse}}) AS best
  FROM {name}_errors e JOIN {name}_line USING (variant_id) WHERE n >= 3 GROUP BY ALL)""",
        f"""{name}_shifts AS (SELECT variant_id, {shifts} FROM {name}_shifted GROUP BY ALL)""",
        f"""{name}_fit AS (
  SELECT variant_id, n, last_ts, ifnull(best.model, 'mean') AS model, best.score AS score,
         CASE WHEN best IS NULL THEN spread ELSE sqrt(greatest(best.sse, 1e-9) / greatest(n - 1 - best.k, 1)) END AS sigma,
         y_mean, y_last, (y_last - y_first) / nullif(n - 1, 0) AS drift, intercept, slope, t_mean, sxx,
         {", ".join(f"ifnull(season_w{w}, {empty})::DOUBLE AS season_w{w}" for w in range(7))}
  FROM {name}_line LEFT JOIN {name}_choice USING (variant_id) JOIN {name}_shifts USING (variant_id))""",
    ]


def forecast_cte(name: str, horizon: int, step: int, z: float) -> str:
    """CTE ``{name}_fc(variant_id, forecast_ts, forecast_value, lower_bound, upper_bound)``."""
    shift = "list_extract([" + ", ".join(SEASON_COLS) + "], 1 + (epoch(day)::BIGINT // 86400) % 7)"
    return f"""{name}_fc AS (
  SELECT variant_id, day AS forecast_ts, middle AS forecast_value, middle - {z!r} * sigma * wide AS lower_bound,
         middle + {z!r} * sigma * wide AS upper_bound
  FROM (SELECT *, (n - 1 + h)::DOUBLE AS t_new, (last_ts + (h * {step})::INTEGER)::DATE AS day,
               CASE model WHEN 'mean' THEN y_mean WHEN 'last' THEN y_last WHEN 'drift' THEN y_last + h * drift
                          WHEN 'trend' THEN intercept + slope * t_new ELSE intercept + slope * t_new + {shift} END AS middle,
               sqrt(CASE WHEN model IN ('last', 'drift') THEN h WHEN model = 'mean' THEN 1 + 1 / n
                         ELSE 1 + 1 / n + (t_new - t_mean) ^ 2 / sxx END) AS wide
        FROM (SELECT *, unnest(range(1, {horizon + 1})) AS h FROM {name}_fit)))"""


def qty(expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE greatest(CAST(round(round({expr}, 6)) AS BIGINT), 0) END"


# Same fixed rules as shelfcast.operators.holidays.US_HOLIDAY_RULES, written as SQL.
def _hol_sql(years: str) -> str:
    from shelfcast.operators.holidays import JUNETEENTH_FIRST_YEAR, US_HOLIDAY_RULES
    parts = []
    for name, month, rule in US_HOLIDAY_RULES:
        first = f"make_date(CAST(year AS BIGINT), {month}, 1)"
        if isinstance(rule, int):
            d = f"make_date(CAST(year AS BIGINT), {month}, {rule})"
        elif rule[0] > 0:
            n, wd = rule
            d = f"CAST({first} + CAST((({wd} - isodow({first})) % 7 + 7) % 7 + {7 * (n - 1)} AS INTEGER) AS DATE)"
        else:
            wd = rule[1]
            last = f"last_day({first})"
            d = f"CAST({last} - CAST(((isodow({last}) - {wd}) % 7 + 7) % 7 AS INTEGER) AS DATE)"
        cond = f" WHERE year >= {JUNETEENTH_FIRST_YEAR}" if name == "Juneteenth" else ""
        parts.append(f"SELECT year, '{name}' AS holiday, {d} AS holiday_date FROM {years}{cond}")
    return "\n  UNION ALL ".join(parts)


def holiday_ctes(name: str, src: str) -> list[str]:
    """``{name}_he(variant_id, holiday, holiday_effect)`` and ``{name}_fch`` (holiday-shifted forecasts)."""
    moved = ", ".join(f"{c} + ifnull(holiday_effect, 0) AS {c}" for c in ("forecast_value", "lower_bound", "upper_bound"))
    return [
        f"""{name}_years AS (
  SELECT unnest(range(min(year(ts)), max(year(ts)) + 2)) AS year FROM {name}_grid)""",
        f"""{name}_cal AS (
  {_hol_sql(f"{name}_years")})""",
        f"""{name}_he AS (
  SELECT variant_id, holiday, avg(y - ifnull(fitted, y_mean) - ifnull(shift, 0)) AS holiday_effect
  FROM {name}_shifted JOIN {name}_cal ON holiday_date = ts GROUP BY ALL)""",
        f"""{name}_fch AS (
  SELECT variant_id, forecast_ts, {moved}
  FROM {name}_fc LEFT JOIN {name}_cal ON holiday_date = forecast_ts LEFT JOIN {name}_he USING (variant_id, holiday))""",
    ]
