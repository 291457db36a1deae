"""Autoregressive fits and forecasts as SQL (DuckDB), for the oracle side only.

Written point by point over ``{name}_grid`` (the zero-filled grid of
``oracle_forecast.fit_ctes``): differences, autocovariances as sums over the
points, and recursive queries for the orders and for the steps ahead. The Spark
side has no grid and works from lag sums and edge values.
"""

from __future__ import annotations

LAGS = 5


def arima_ctes(name: str) -> list[str]:
    """CTE ``{name}_ar(variant_id, n, last_ts, d, p, score, mu, sigma2, phi, xs, level)``."""
    return [
        f"""{name}_arx AS (
  SELECT variant_id, d, list(x ORDER BY t) AS xs, avg(x) AS mu, any_value(n) AS n, max(ts) AS last_ts, arg_max(y, t) AS level
  FROM (SELECT *, 0 AS d, y AS x FROM {name}_grid
        UNION ALL (SELECT *, 1, y - lag(y) OVER (PARTITION BY variant_id ORDER BY t) FROM {name}_grid QUALIFY t > 0))
  GROUP BY variant_id, d)""",
        f"""{name}_arc AS (
  SELECT *, [list_sum([(xs[i] - mu) * (xs[i - k] - mu) FOR i IN range(k + 1, len(xs) + 1)]) / len(xs) FOR k IN range(0, {LAGS + 1})] AS c
  FROM {name}_arx)""",
        f"""{name}_lev AS (
  WITH RECURSIVE orders AS (
    SELECT variant_id, d, c, 0 AS p, CAST([] AS DOUBLE[]) AS phi, c[1] AS v FROM {name}_arc
    UNION ALL
    SELECT variant_id, d, c, p + 1, list_append([phi[j] - a * phi[p + 1 - j] FOR j IN range(1, p + 1)], a), v * (1 - a * a)
    FROM (SELECT *, CASE WHEN v > 1e-9 THEN (c[p + 2] - ifnull(list_sum([phi[j] * c[p + 2 - j] FOR j IN range(1, p + 1)]), 0)) / v
                         ELSE 0 END AS a
          FROM orders WHERE p < {LAGS}))
  SELECT * FROM orders)""",
        f"""{name}_arbest AS (
  SELECT variant_id, min({{'score': round((n - 1) * ln(greatest(v, 1e-9)) + 2 * (p + 2) + 2 * (p + 2) * (p + 3) / (n - p - 4)::DOUBLE, 6),
                          'd': d, 'p': p, 'v': v, 'phi': phi}}) AS best
  FROM {name}_lev JOIN {name}_arc USING (variant_id, d) WHERE n - 1 > p + 3 GROUP BY variant_id)""",
        f"""{name}_ar AS (
  SELECT x.variant_id, x.n, x.last_ts, x.d, ifnull(best.p, 0) AS p, best.score AS score, x.mu,
         CASE WHEN best IS NOT NULL THEN greatest(best.v, 0) ELSE ifnull(list_aggregate(xs, 'var_samp'), 0) END AS sigma2,
         ifnull(best.phi, []) AS phi, xs, level
  FROM {name}_arx x LEFT JOIN {name}_arbest b USING (variant_id) WHERE x.d = ifnull(best.d, 0))""",
    ]


FIT = ("variant_id, n, last_ts, d, p, round(score, 6) AS score, round(mu, 6) AS mu, round(sigma2, 6) AS sigma2, "
       + ", ".join(f"round(ifnull(phi[{j}], 0), 6) AS phi{j}" for j in range(1, LAGS + 1)))


def arima_forecast_cte(name: str, horizon: int, step: int, z: float) -> str:
    """CTE ``{name}_arfc(variant_id, forecast_ts, forecast_value, lower_bound, upper_bound)``."""
    return f"""{name}_arfc AS (
  WITH RECURSIVE steps AS (
    SELECT *, 0 AS h, CAST(0 AS DOUBLE) AS middle, CAST([] AS DOUBLE[]) AS psis, CAST([1] AS DOUBLE[]) AS next_psi FROM {name}_ar
    UNION ALL
    SELECT * EXCLUDE (h, middle, psis, next_psi, xs, level, new, psi) REPLACE (n AS n), list_append(xs, new) AS xs,
           CASE d WHEN 0 THEN new ELSE level + new END AS level, h + 1, CASE d WHEN 0 THEN new ELSE level + new END,
           list_append(psis, psi), [ifnull(list_sum([phi[j] * list_append(psis, psi)[h + 2 - j] FOR j IN range(1, least(p, h + 1) + 1)]), 0)]
    FROM (SELECT *, next_psi[1] AS psi, mu + ifnull(list_sum([phi[j] * (xs[len(xs) + 1 - j] - mu) FOR j IN range(1, p + 1)]), 0) AS new
          FROM steps WHERE h < {horizon}))
  SELECT variant_id, (last_ts + (h * {step})::INTEGER)::DATE AS forecast_ts, middle AS forecast_value,
         middle - {z!r} * wide AS lower_bound, middle + {z!r} * wide AS upper_bound
  FROM (SELECT *, sqrt(sigma2 * list_sum([CASE d WHEN 0 THEN psis[i] ELSE list_sum(psis[1:i]) END ^ 2 FOR i IN range(1, h + 1)])) AS wide
        FROM steps WHERE h > 0))"""
