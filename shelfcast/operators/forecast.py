"""Grouped time-series forecasting, tier 1: closed form, JVM only.

One row per series is enough to fit every candidate model, because each
candidate's parameters and one-step-ahead error are functions of a handful of
*exact integer sums* over the series:

    N    number of periods from first to last observation (gaps count as 0)
    Sy   Σ y          Syy  Σ y²          Sty  Σ t·y
    yf   first value  yl   last value    Slag Σ y_t·y_{t-1}

with ``t = 0..N-1`` the period index. Gap periods contribute nothing to Sy,
Syy, Sty, Slag, and Σt, Σt² over the grid are closed forms of N, so the
zero-filled grid is never materialised: a sparse long-tail series costs as
many rows as it has sales. The only shuffle is one hash exchange on the series
key (the ``lag`` window); the aggregate reuses that partitioning.

Candidates (k = parameter count), scored on points t = 1..N-1 with
``score = round(m·ln(max(SSE,1e-9)/m) + 2k, 6)``, m = N-1; argmin, ties →
fewer parameters, then name:

    mean  ŷ = Sy/N                      k=1   σ_h = σ·√(1+1/N)
    last  ŷ = yl                        k=1   σ_h = σ·√h
    drift ŷ = yl + h·(yl-yf)/(N-1)       k=2   σ_h = σ·√h
    trend ŷ = a + b·(N-1+h)  (OLS)      k=2   σ_h = σ·√(1+1/N+(t-t̄)²/Sxx)
    trend_season  trend + weekday offset (daily only, N ≥ 21)   k=9   σ_h as trend

Weekday offsets are the mean trend residual per weekday ``w = unix_date mod 7``
(w = 0 is a Thursday), exposed as ``season_w0..season_w6``.

σ = √(SSE/max(m-k,1)). Series with N < 3 use the mean model with the sample
standard deviation (0 for a single point). Reference exactness is about the
*contract* (one model per id, horizon rows, interval at the requested level),
not the closed platform's digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit, round_to_long, ts_lit
from shelfcast.operators.holidays import add_holiday_effects, with_holiday_effects
from shelfcast.params import DEFAULT_PARAMS, Params

SSE_FLOOR = 1e-9
MODEL_PARAMS = {"mean": 1, "last": 1, "drift": 2, "trend": 2}
SEASON_PARAMS = 9            # trend (2) + seven weekday offsets
SEASON_MIN_PERIODS = 21      # at least three full weeks before weekday offsets are scored

FIT_COLUMNS = ("n", "last_ts", "model", "score", "sigma", "y_mean", "y_last", "drift", "intercept", "slope",
               "t_mean", "sxx") + tuple(f"season_w{w}" for w in range(7))


def series_sums(series: DataFrame, key: str, ts: str, value: str, step_days: int,
                season: bool = False) -> DataFrame:
    """Per-series exact sums (the sufficient statistics of every candidate).

    With ``season`` also Σy, Σd·y, Σy² per weekday ``w = unix_date mod 7``.
    """
    y = F.col(value).cast("bigint")
    day = F.unix_date(F.col(ts))
    w = Window.partitionBy(key).orderBy(ts)
    prev_day, prev_y = F.lag(day).over(w), F.lag(y).over(w)
    s = series.select(key, ts, y.alias("y"), day.alias("d"),
                      F.when(prev_day == day - step_days, y * prev_y).otherwise(F.lit(0).cast("bigint")).alias("lagprod"))
    g = s.groupBy(key).agg(
        F.min("d").alias("d0"), F.max("d").alias("d1"), F.max(ts).alias("last_ts"),
        F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.sum(F.col("d") * F.col("y")).alias("sdy"),
        F.min_by("y", "d").alias("yf"), F.max_by("y", "d").alias("yl"), F.sum("lagprod").alias("slag"),
        *_weekday_sums(season))
    seasonal = [f"{p}_w{w}" for w in range(7) for p in ("sy", "sdy", "syy")] if season else []
    return g.select(
        key, "last_ts", (F.floor((F.col("d1") - F.col("d0")) / step_days) + 1).cast("bigint").alias("n"),
        "sy", "syy", ((F.col("sdy") - F.col("d0") * F.col("sy")) / step_days).cast("bigint").alias("sty"),
        "yf", "yl", "slag", "d0", *seasonal)


def _weekday_sums(season: bool) -> list[Column]:
    # written as SQL expressions: one JVM call per column instead of one per operator
    if not season:
        return []
    out = []
    for w in range(7):
        hit = f"pmod(d, 7) = {w}"
        out += [F.expr(f"sum(CASE WHEN {hit} THEN y ELSE CAST(0 AS BIGINT) END)").alias(f"sy_w{w}"),
                F.expr(f"sum(CASE WHEN {hit} THEN d * y ELSE CAST(0 AS BIGINT) END)").alias(f"sdy_w{w}"),
                F.expr(f"sum(CASE WHEN {hit} THEN y * y ELSE CAST(0 AS BIGINT) END)").alias(f"syy_w{w}")]
    return out


def fit_forecaster(series: DataFrame, key: str, ts: str, value: str, step_days: int,
                   season: bool = False) -> DataFrame:
    """Fit one model per series; returns ``key`` + FIT_COLUMNS.

    The formulas are staged over successive projections that refer to named
    columns, so no expression tree repeats another one inside it. ``season``
    (daily series) adds the trend + weekday-offset candidate.
    """
    s = series_sums(series, key, ts, value, step_days, season)
    seasonal = [f"{p}_w{w}" for w in range(7) for p in ("sy", "sdy", "syy")] if season else []
    # SQL expressions: one JVM call per column (the Column API would make one per operator)
    s1 = s.selectExpr(key, "n", "last_ts", *[f"CAST({x} AS DOUBLE) AS {x}" for x in ("sy", "syy", "sty", "yf", "yl", "slag")],
                      "CAST(n AS DOUBLE) AS nd", "d0", *seasonal)
    s2 = s1.selectExpr("*", "nd * (nd - 1) / 2 AS st", "(nd - 1) * nd * (2 * nd - 1) / 6 AS stt", "sy / nd AS ybar",
                       "nd - 1 AS m")
    s3 = s2.selectExpr("*", "stt - st * st / nd AS sxx",
                       "CASE WHEN nd >= 2 THEN (nd * sty - st * sy) / (nd * stt - st * st) END AS slope",
                       "CASE WHEN nd >= 2 THEN (yl - yf) / m END AS drift")
    s4 = s3.selectExpr("*", "ybar - slope * st / nd AS intercept")
    s5 = s4.selectExpr(
        "*", "(syy - yf * yf) - 2 * ybar * (sy - yf) + m * ybar * ybar AS sse_mean",
        "(syy - yf * yf) + (syy - yl * yl) - 2 * slag AS sse_last",
        "(syy - 2 * intercept * sy - 2 * slope * sty + nd * intercept * intercept + 2 * intercept * slope * st"
        " + slope * slope * stt) - (yf - intercept) * (yf - intercept) AS sse_trend")
    s6 = s5.selectExpr("*", "sse_last - m * drift * drift AS sse_drift")

    def cand(name: str, k: int) -> str:
        return (f"named_struct('score', {_score_sql(f'sse_{name}', k)}, 'k', {k}, 'model', '{name}', "
                f"'sse', sse_{name})")

    cands = [cand(name, k) for name, k in MODEL_PARAMS.items()]
    if season:
        s6 = _season_terms(s6, step_days)
        cands.append(f"CASE WHEN nd >= {SEASON_MIN_PERIODS} THEN {cand('trend_season', SEASON_PARAMS)} END")
    else:
        s6 = s6.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS season_w{w}" for w in range(7)])
    # series shorter than 3 periods always use the mean model (no candidate scoring)
    s7 = s6.selectExpr("*", f"CASE WHEN nd >= 3 THEN array_min(array({', '.join(cands)})) END AS best")
    small_sigma = "CASE WHEN nd >= 2 THEN sqrt(greatest((syy - sy * sy / nd) / m, CAST(0 AS DOUBLE))) ELSE CAST(0 AS DOUBLE) END"
    big_sigma = f"sqrt(greatest(best.sse, CAST({SSE_FLOOR!r} AS DOUBLE)) / greatest(m - best.k, CAST(1 AS DOUBLE)))"
    return s7.selectExpr(
        key, "n", "last_ts", "coalesce(best.model, 'mean') AS model", "best.score AS score",
        f"CASE WHEN best IS NULL THEN {small_sigma} ELSE {big_sigma} END AS sigma",
        "ybar AS y_mean", "yl AS y_last", "drift", "intercept", "slope", "st / nd AS t_mean", "sxx",
        *[f"season_w{w}" for w in range(7)])


def _score_sql(sse: str, k: int) -> str:
    return f"round(m * ln(greatest({sse}, CAST({SSE_FLOOR!r} AS DOUBLE)) / m) + CAST({2.0 * k!r} AS DOUBLE), 6)"


def _season_terms(df: DataFrame, step_days: int) -> DataFrame:
    """Weekday offsets of the trend residuals and the seasonal model's SSE (points t >= 1).

    Per weekday w the grid count, Σt and Σt² are closed forms of (N, first day);
    Σy, Σt·y, Σy² come from the data. R_w / Q_w are the sum and squared sum of
    trend residuals on weekday w; the offset is R_w / n_w. Written as SQL
    expressions (one JVM call per column; ~100 columns).
    """
    W = range(7)
    r = {w: f"pmod({w} - d0, 7)" for w in W}
    df = df.selectExpr("*", *[f"{r[w]} AS r_w{w}" for w in W], *[
        f"CAST(CASE WHEN {r[w]} <= nd - 1 THEN floor((nd - 1 - {r[w]}) / 7) + 1 ELSE 0 END AS DOUBLE) AS n_w{w}"
        for w in W], *[f"CAST((sdy_w{w} - d0 * sy_w{w}) / {step_days} AS DOUBLE) AS sty_w{w}" for w in W])
    df = df.selectExpr("*", *[f"n_w{w} * r_w{w} + 7 * n_w{w} * (n_w{w} - 1) / 2 AS st_w{w}" for w in W], *[
        f"n_w{w} * r_w{w} * r_w{w} + 14 * r_w{w} * n_w{w} * (n_w{w} - 1) / 2"
        f" + 49 * (n_w{w} - 1) * n_w{w} * (2 * n_w{w} - 1) / 6 AS stt_w{w}" for w in W])
    df = df.selectExpr("*", *[
        f"CAST(sy_w{w} AS DOUBLE) - n_w{w} * intercept - slope * st_w{w} AS rs_w{w}" for w in W], *[
        f"CAST(syy_w{w} AS DOUBLE) + n_w{w} * intercept * intercept + slope * slope * stt_w{w}"
        f" - 2 * intercept * CAST(sy_w{w} AS DOUBLE) - 2 * slope * sty_w{w} + 2 * intercept * slope * st_w{w} AS qs_w{w}"
        for w in W])
    df = df.selectExpr("*", *[f"CASE WHEN n_w{w} > 0 THEN rs_w{w} / n_w{w} ELSE CAST(0 AS DOUBLE) END AS season_w{w}"
                              for w in W])
    total = " + ".join(f"(CASE WHEN n_w{w} > 0 THEN qs_w{w} - rs_w{w} * season_w{w} ELSE CAST(0 AS DOUBLE) END)"
                       for w in W)
    first_off = "element_at(array(" + ", ".join(f"season_w{w}" for w in W) + "), CAST(pmod(d0, 7) + 1 AS INT))"
    return df.selectExpr("*", f"({total}) - ((yf - intercept) - {first_off}) * ((yf - intercept) - {first_off})"
                              " AS sse_trend_season")


def forecast(model: DataFrame, key: str, horizon: int, step_days: int, z: float, carry: tuple[str, ...] = ()) -> DataFrame:
    """``ML.FORECAST``: ``horizon`` rows per series after its last observed period.

    Returns key, forecast_ts (date), forecast_value, prediction_interval_lower/upper_bound
    and the model columns named in ``carry``.
    """
    # The output is ``horizon`` times the model table (one row per series): rebalance
    # before the expansion, with partition sizes left to adaptive execution.
    steps = model.hint("rebalance", key).select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    hd, nd = "CAST(h AS DOUBLE)", "CAST(n AS DOUBLE)"
    tstar = f"({nd} - 1 + {hd})"
    fday = f"date_add(last_ts, h * {step_days})"
    offset = ("element_at(array(" + ", ".join(f"season_w{w}" for w in range(7))
              + f"), CAST(pmod(unix_date({fday}), 7) + 1 AS INT))")
    yhat = (f"CASE WHEN model = 'mean' THEN y_mean WHEN model = 'last' THEN y_last "
            f"WHEN model = 'drift' THEN y_last + {hd} * drift "
            f"WHEN model = 'trend_season' THEN intercept + slope * {tstar} + {offset} "
            f"ELSE intercept + slope * {tstar} END")
    se = (f"CASE WHEN model = 'mean' THEN sigma * sqrt(1 + 1 / {nd}) "
          f"WHEN model IN ('last', 'drift') THEN sigma * sqrt({hd}) "
          f"ELSE sigma * sqrt(1 + 1 / {nd} + ({tstar} - t_mean) * ({tstar} - t_mean) / sxx) END")
    pts = steps.selectExpr(key, f"{fday} AS forecast_ts", f"{yhat} AS forecast_value", f"{se} AS se", *carry)
    zl = f"CAST({float(z)!r} AS DOUBLE)"
    return pts.selectExpr(key, "forecast_ts", "forecast_value",
                          f"forecast_value - {zl} * se AS prediction_interval_lower_bound",
                          f"forecast_value + {zl} * se AS prediction_interval_upper_bound", *carry)


def to_quantity(c: Column | str) -> Column:
    """``GREATEST(CAST(x AS INT64), 0)`` with half-away-from-zero rounding, NULL for NULL; the rounding stands in it once."""
    return F.greatest(round_to_long(c), F.when((F.col(c) if isinstance(c, str) else c).isNotNull(), F.lit(0)))


# ---------------------------------------------------------------- daily demand model

def demand_model_input(sales_daily: DataFrame, p: Params = DEFAULT_PARAMS, variant_map: DataFrame | None = None,
                       variants: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """C30 training rows: positive daily sales in the last year for forecastable variants.

    Restock form: ``variant_map`` (active, non-internal vendors).
    Stand-alone form: ``variants`` + ``products`` with internal vendors excluded.
    Either way the dimension is reduced to distinct variant ids and semi-joined:
    a series has one row per date, never a copy per duplicate map entry.
    """
    if variant_map is not None:
        keys = variant_map.select("variant_id")
    else:
        keys = (variants.alias("v").join(products.alias("p"), F.col("v.product_id") == F.col("p.product_id"))
                .filter(F.col("v.variant_id").isNotNull() & ~F.col("p.vendor").isin(list(p.internal_vendors)))
                .select(F.col("v.variant_id").alias("variant_id")))
    sd = sales_daily.filter(F.col("sale_date").between(date_lit(p.days_ago(p.sales_lookback_days)), date_lit(p.as_of))
                            & (F.col("qty_sold") > 0))
    return sd.join(keys, "variant_id", "left_semi").select("sale_date", "variant_id", "qty_sold")


def fit_demand_model(train: DataFrame, season: bool = True) -> DataFrame:
    """Daily model; weekday seasonality on (the weekly backtest model has none)."""
    return fit_forecaster(train, "variant_id", "sale_date", "qty_sold", 1, season=season)


def demand_forecasts(model: DataFrame, p: Params = DEFAULT_PARAMS, variants: DataFrame | None = None,
                     holiday_effects: DataFrame | None = None, calendar: DataFrame | None = None) -> DataFrame:
    """60-day forecasts with a 95% interval, positive forecasts only.

    With ``holiday_effects`` (US calendar) forecasts on a holiday are shifted by
    that holiday's effect. The positivity filter is on the raw forecast value,
    before rounding. With ``variants`` the sku label is attached (stand-alone form).
    """
    horizon = (p.forecast_horizon_days, 1, p.z_value)
    if holiday_effects is None:
        return forecast_quantities(forecast(model, "variant_id", *horizon), p, variants)
    # the effects meet the model, one row a series, and not its ``horizon`` forecasts
    shifted = with_holiday_effects(model, holiday_effects, "variant_id", calendar, p.forecast_horizon_days)
    f = forecast(shifted, "variant_id", *horizon, carry=("holiday_shifts",))
    return forecast_quantities(add_holiday_effects(f, "variant_id"), p, variants)


def forecast_quantities(f: DataFrame, p: Params = DEFAULT_PARAMS, variants: DataFrame | None = None) -> DataFrame:
    """Forecast rows -> ``demand_forecasts`` columns (positive raw forecasts, rounded, clamped)."""
    f = f.filter(F.col("forecast_value") > 0)
    out = f.select(
        "variant_id", F.col("forecast_ts").alias("forecast_date"),
        to_quantity("forecast_value").alias("predicted_qty"),
        to_quantity("prediction_interval_lower_bound").alias("confidence_lower"),
        to_quantity("prediction_interval_upper_bound").alias("confidence_upper"),
        ts_lit(p.run_ts).alias("created_at"))
    if variants is None:
        return out
    return out.join(variants.select("variant_id", "sku"), "variant_id", "left").select(
        "variant_id", "sku", "forecast_date", "predicted_qty", "confidence_lower", "confidence_upper", "created_at")


# ---------------------------------------------------------------- regularize / infer frequency (§2.10)

def regularize(series: DataFrame, key: str, ts: str, value: str, step_days: int, policy: str = "zero") -> DataFrame:
    """Put each series on its own regular grid from first to last observation.

    ``policy``: 'zero' fills missing periods with 0 (no sales), 'linear'
    interpolates between the neighbouring observations, 'none' leaves NULL.
    The grid per series is bounded by its span (the training window), and the
    interpolation windows are per series.
    """
    bounds = series.groupBy(key).agg(F.min(ts).alias("_t0"), F.max(ts).alias("_t1"))
    grid = bounds.select(key, F.explode(F.sequence("_t0", "_t1", F.make_interval(days=F.lit(step_days)))).alias(ts))
    j = grid.join(series.select(key, ts, F.col(value).alias("_y")), [key, ts], "left")
    if policy == "zero":
        y = F.coalesce(F.col("_y").cast("double"), F.lit(0.0))
    elif policy == "none":
        y = F.col("_y").cast("double")
    elif policy == "linear":
        day = F.unix_date(F.col(ts))
        known_day = F.when(F.col("_y").isNotNull(), day)
        back = Window.partitionBy(key).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
        ahead = Window.partitionBy(key).orderBy(ts).rowsBetween(0, Window.unboundedFollowing)
        j = j.select("*", F.last("_y", ignorenulls=True).over(back).alias("_py"),
                     F.last(known_day, ignorenulls=True).over(back).alias("_pd"),
                     F.first("_y", ignorenulls=True).over(ahead).alias("_ny"),
                     F.first(known_day, ignorenulls=True).over(ahead).alias("_nd"))
        frac = (day - F.col("_pd")).cast("double") / (F.col("_nd") - F.col("_pd")).cast("double")
        y = F.when(F.col("_y").isNotNull(), F.col("_y").cast("double")).otherwise(
            F.col("_py").cast("double") + (F.col("_ny") - F.col("_py")).cast("double") * frac)
    else:
        raise ValueError(f"unknown gap policy {policy!r}")
    return j.select(key, ts, y.alias(value))


def infer_frequency(series: DataFrame, key: str, ts: str) -> DataFrame:
    """``AUTO_FREQUENCY``: the modal gap in days between observations per series (ties -> smaller).

    Single-observation series get NULL.
    """
    w = Window.partitionBy(key).orderBy(ts)
    gaps = series.select(key, F.datediff(F.col(ts), F.lag(ts).over(w)).alias("gap"))
    counts = gaps.groupBy(key, "gap").agg(F.count(F.lit(1)).alias("n"))
    # per-series argmax over a handful of distinct gaps: min of (-count, gap)
    best = counts.filter(F.col("gap").isNotNull()).groupBy(key).agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("gap").alias("gap"))).alias("b"))
    keys = series.select(key).distinct()
    return keys.join(best, key, "left").select(key, F.col("b.gap").alias("freq_days"))
