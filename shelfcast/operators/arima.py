"""Autoregressive candidates with and without differencing (``auto_arima``, SURVEY §2.10).

One row per series is enough again. With ``R_k = Σ y_t·y_{t-k}`` over the
zero-filled grid (exact integer sums; empty periods add nothing), the first and
the last values of the grid, and N, the autocovariances of the series and of
its first differences are closed forms up to lag ``MAX_LAGS``:

    Σ x_t·x_{t-k}                        for x = y:  R_k
    2R_k - R_{k-1} - R_{k+1} + edges     for x = Δy  (the edges are products of first and last values)

The Levinson–Durbin recursion then gives the AR coefficients and the
innovation variance of every order p = 0..MAX_LAGS, for d = 0 and d = 1.
Candidates are scored by AICc on the N-1 one-step errors that both have in
common, ``score = round(m·ln(max(v,1e-9)) + 2k + 2k(k+1)/(m-k-1), 6)`` with
m = N-1 and k = p+2 (mean or drift, coefficients, variance); the least score
wins, ties go to smaller d, then p. A candidate needs m > k+1; a series too
short for any has the mean model with its sample variance.

Everything is built-in expressions: one hash exchange on the series key, a
window of the last rows, one aggregate. The grid is never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LAGS = 5
EPS = 1e-9
_LAGS = range(MAX_LAGS + 2)                       # lag products and edge values needed: 0 .. MAX_LAGS + 1

FIT_COLUMNS = ("n", "last_ts", "d", "p", "score", "mu", "sigma2", *[f"phi{j}" for j in range(1, MAX_LAGS + 1)])


def lag_sums(series: DataFrame, key: str, ts: str, value: str, step_days: int) -> DataFrame:
    """Per series: n, last_ts, sy, lag products r0.., first values head0.., last values tail0.. (most recent first)."""
    part = f"PARTITION BY {key}"
    s = series.selectExpr(key, f"{ts} AS ts", f"CAST({value} AS BIGINT) AS y", f"unix_date({ts}) AS day")
    # the j-th row before is at least j periods back, so lag k is among the k rows before
    s = s.selectExpr("*", f"min(day) OVER ({part}) AS d0", f"max(day) OVER ({part}) AS d1",
                     *[f"lag({c}, {j}) OVER ({part} ORDER BY ts) AS {c}_{j}" for j in _LAGS if j for c in ("day", "y")])
    products = ["sum(y * y) AS r0"] + [
        "sum(" + " + ".join(f"CASE WHEN day_{j} = day - {k * step_days} THEN y * y_{j} ELSE 0L END" for j in range(1, k + 1))
        + f") AS r{k}" for k in _LAGS if k]
    edges = [f"sum(CASE WHEN day = {side} THEN y ELSE 0L END) AS {name}{j}"
             for j in _LAGS for name, side in (("head", f"d0 + {j * step_days}"), ("tail", f"d1 - {j * step_days}"))]
    return s.groupBy(key).agg(*[F.expr(e) for e in (
        f"CAST(floor((max(d1) - min(d0)) / {step_days}) + 1 AS BIGINT) AS n", "max(ts) AS last_ts", "sum(y) AS sy", *products, *edges)])


def fit_arima(series: DataFrame, key: str, ts: str, value: str, step_days: int) -> DataFrame:
    """One AR(p) with d differences per series: ``key`` + FIT_COLUMNS + the last values ``tail0..`` that `forecast_arima` starts from."""
    s = lag_sums(series, key, ts, value, step_days)
    plus = lambda name, k: " + ".join(f"{name}{j}" for j in range(k)) or "0L"
    moments = []
    for k in range(MAX_LAGS + 1):
        moments += [f"CAST(r{k} AS DOUBLE) AS s0_{k}", f"CAST(2 * sy - ({plus('head', k)}) - ({plus('tail', k)}) AS DOUBLE) AS b0_{k}",
                    (f"CAST(2 * r0 - 2 * r1 - head0 * head0 - tail0 * tail0 AS DOUBLE) AS s1_{k}" if k == 0 else
                     f"CAST(2 * r{k} - r{k + 1} - r{k - 1} - head0 * (head{k} - head{k - 1}) + tail0 * (tail{k - 1} - tail{k}) AS DOUBLE) AS s1_{k}"),
                    f"CAST(2 * (tail0 - head0) - (head{k} - head0) - (tail0 - tail{k}) AS DOUBLE) AS b1_{k}"]
    s = s.selectExpr("*", "CAST(n AS DOUBLE) AS n0", "CAST(n - 1 AS DOUBLE) AS n1", "sy / CAST(n AS DOUBLE) AS mu0",
                     "CASE WHEN n > 1 THEN (tail0 - head0) / CAST(n - 1 AS DOUBLE) END AS mu1", *moments)
    s = s.selectExpr("*", *[f"CASE WHEN n{d} > {k} THEN (s{d}_{k} - mu{d} * b{d}_{k} + (n{d} - {k}) * mu{d} * mu{d}) / n{d} END AS c{d}_{k}"
                            for d in (0, 1) for k in range(MAX_LAGS + 1)])
    s = s.selectExpr("*", "c0_0 AS v0_0", "c1_0 AS v1_0")
    for m in range(1, MAX_LAGS + 1):                                       # Levinson–Durbin, one projection an order
        last = {d: f"CASE WHEN v{d}_{m - 1} > {EPS}D THEN (c{d}_{m}"
                   + "".join(f" - f{d}_{m - 1}_{j} * c{d}_{m - j}" for j in range(1, m)) + f") / v{d}_{m - 1} ELSE 0D END" for d in (0, 1)}
        s = s.selectExpr("*", *[f"{last[d]} AS f{d}_{m}_{m}" for d in (0, 1)])
        s = s.selectExpr("*", *[f"f{d}_{m - 1}_{j} - f{d}_{m}_{m} * f{d}_{m - 1}_{m - j} AS f{d}_{m}_{j}" for d in (0, 1) for j in range(1, m)],
                         *[f"v{d}_{m - 1} * (1 - f{d}_{m}_{m} * f{d}_{m}_{m}) AS v{d}_{m}" for d in (0, 1)])

    def candidate(d: int, p: int) -> str:
        k = p + 2
        score = f"round(n1 * ln(greatest(v{d}_{p}, {EPS}D)) + {2.0 * k}D + {2.0 * k * (k + 1)}D / (n1 - {k + 1}), 6)"
        phi = ", ".join(f"f{d}_{p}_{j}" if j <= p else "0D" for j in range(1, MAX_LAGS + 1))
        return (f"CASE WHEN n1 > {k + 1} THEN named_struct('score', {score}, 'd', {d}, 'p', {p}, 'mu', mu{d}, "
                f"'v', v{d}_{p}, 'phi', array({phi})) END")

    s = s.selectExpr("*", f"array_min(array({', '.join(candidate(d, p) for d in (0, 1) for p in range(MAX_LAGS + 1))})) AS best")
    return s.selectExpr(key, "n", "last_ts", "coalesce(best.d, 0) AS d", "coalesce(best.p, 0) AS p", "best.score AS score",
                        "coalesce(best.mu, mu0) AS mu",
                        "CASE WHEN best IS NOT NULL THEN greatest(best.v, 0D) WHEN n > 1 THEN c0_0 * n0 / n1 ELSE 0D END AS sigma2",
                        *[f"coalesce(best.phi[{j - 1}], 0D) AS phi{j}" for j in range(1, MAX_LAGS + 1)],
                        *[f"CAST(tail{j} AS DOUBLE) AS tail{j}" for j in range(MAX_LAGS + 1)])


def forecast_arima(model: DataFrame, key: str, horizon: int, step_days: int, z: float) -> DataFrame:
    """``ML.FORECAST`` of `fit_arima`'s models: the columns of `forecast.forecast`.

    The recursion runs in one ``aggregate`` over the steps per series: the last
    values and the psi weights, most recent first, move on by one dot product.
    """
    lags = range(1, MAX_LAGS + 1)
    dot = lambda a: " + ".join(f"phi{j} * {a}[{j - 1}]" for j in lags)
    start_x = ", ".join(f"CASE WHEN d = 0 THEN tail{j - 1} ELSE tail{j - 1} - tail{j} END - mu" for j in lags)
    moved = lambda a, new: f"array({new}, " + ", ".join(f"{a}[{j - 2}]" for j in lags if j > 1) + ")"
    level = f"(CASE WHEN d = 0 THEN 0D ELSE s.level END + mu + ({dot('s.x')}))"
    weight = "CASE WHEN d = 0 THEN s.psi[0] ELSE s.total + s.psi[0] END"
    steps = model.hint("rebalance", key).selectExpr(key, "last_ts", f"""
        aggregate(sequence(1, {int(horizon)}),
                  named_struct('x', array({start_x}), 'psi', array(1D{', 0D' * (MAX_LAGS - 1)}), 'total', 0D, 'level', tail0,
                               'var', 0D, 'out', CAST(array() AS array<struct<f: double, se: double>>)),
                  (s, h) -> named_struct('x', {moved('s.x', dot('s.x'))}, 'psi', {moved('s.psi', dot('s.psi'))},
                               'total', s.total + s.psi[0], 'level', {level}, 'var', s.var + ({weight}) * ({weight}),
                               'out', concat(s.out, array(named_struct('f', {level}, 'se', sqrt(sigma2 * (s.var + ({weight}) * ({weight})))))))
        ).out AS steps""")
    # outer: the filter that Spark derives from a plain explode would copy the recursion into every projection below
    points = steps.selectExpr(key, "last_ts", "posexplode_outer(steps) AS (i, at)")
    zl = f"{float(z)!r}D"
    return points.selectExpr(key, f"date_add(last_ts, (i + 1) * {step_days}) AS forecast_ts", "at.f AS forecast_value",
                             f"at.f - {zl} * at.se AS prediction_interval_lower_bound",
                             f"at.f + {zl} * at.se AS prediction_interval_upper_bound")
