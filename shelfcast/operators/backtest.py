"""Weekly backtest against a previous-week baseline.

Holdout = weeks in ``[cutoff_week_start, last_complete_week_start]`` (five
weeks, inclusive, SURVEY Q1); the model is trained on positive weeks in
``[last_complete - 52w, cutoff)`` and forecasts four weeks from each series'
own last training week (Q2). If there are no training rows at all, every
output is empty with its schema (the script's guard branch, Q7): each output
is filtered by a one-row scalar guard, no driver-side branching.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit, safe_div, ts_lit
from shelfcast.operators.forecast import fit_forecaster, forecast, to_quantity
from shelfcast.params import DEFAULT_PARAMS, Params

KEY = "variant_id"


def training_rows(weekly: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    wk = F.col("week_start")
    return weekly.filter((wk >= date_lit(p.train_start_week)) & (wk < date_lit(p.cutoff_week_start))
                         & (F.col("qty_sold") > 0)).select(KEY, "week_start", "qty_sold")


def has_training(weekly: DataFrame, p: Params = DEFAULT_PARAMS) -> Column:
    """Scalar guard, true when at least one positive training row exists."""
    return training_rows(weekly, p).select(F.count(F.lit(1)) > 0).scalar()


def fit_weekly_model(weekly: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """One model per variant on the training window (no holidays, weekly step)."""
    return fit_forecaster(training_rows(weekly, p), KEY, "week_start", "qty_sold", 7)


def backtest_forecast(model: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """``holdout_weeks`` predictions per variant, rounded and clamped at 0 (no positivity filter)."""
    f = forecast(model, KEY, p.holdout_weeks, 7, p.z_value)
    return f.select(KEY, F.col("forecast_ts").alias("week_start"), to_quantity("forecast_value").alias("predicted_qty"))


def holdout_with_baseline(weekly: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Holdout actuals with the naive baseline = the same variant's sales exactly one week earlier.

    ``lag`` plus an exact 7-day check equals the reference's self-join on
    ``week - 7`` because (variant, week) is unique in the weekly rollup; a
    missing previous week gives 0 (gaps are not bridged).
    """
    wk = F.col("week_start")
    w = weekly.filter((wk >= date_lit(p.cutoff_week_start - dt.timedelta(weeks=1)))
                      & (wk <= date_lit(p.holdout_end_week)))
    win = Window.partitionBy(KEY).orderBy("week_start")
    prev_ok = F.lag("week_start").over(win) == F.date_sub(wk, 7)
    base = F.when(prev_ok, F.lag("qty_sold").over(win)).otherwise(F.lit(0).cast("bigint"))
    return (w.select(KEY, "week_start", F.col("qty_sold").alias("actual_qty"), base.alias("baseline_qty"))
            .filter(wk >= date_lit(p.cutoff_week_start)))


def backtest_joined(hold: DataFrame, fc: DataFrame) -> DataFrame:
    """Actual x forecast, full outer on (variant, week); missing sides count as 0, ``has_actual`` tells them apart."""
    j = hold.withColumn("has_actual", F.lit(True)).join(fc, [KEY, "week_start"], "full_outer")
    zero = F.lit(0).cast("bigint")
    return j.select(KEY, "week_start", F.coalesce("actual_qty", zero).alias("actual_qty"),
                    F.coalesce("predicted_qty", zero).alias("predicted_qty"),
                    F.coalesce("baseline_qty", zero).alias("baseline_qty"),
                    F.coalesce("has_actual", F.lit(False)).alias("has_actual"))


def _ordered_mean(c: Column) -> Column:
    """Mean of the non-NULL values, summed in ascending order.

    Float sums depend on the order rows arrive in; sorting the (bounded,
    ≤ holdout+horizon) per-variant list first makes the result reproducible.
    """
    vals = F.array_sort(F.collect_list(c))
    return F.when(F.size(vals) > 0,
                  F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x) / F.size(vals))


def backtest_scores(joined: DataFrame, guard: Column) -> DataFrame:
    """Model and baseline errors per variant from one aggregate.

    The model is scored over all actual x forecast rows, the baseline over the
    weeks that have sales (Q4); both denominators are kept.
    """
    actual = F.col("actual_qty")
    err, base_err = F.abs(actual - F.col("predicted_qty")), F.abs(actual - F.col("baseline_qty"))
    seen = lambda c: F.sum(F.when(F.col("has_actual"), c))
    ratio = lambda e, n: safe_div(F.col(e), F.nullif(F.col(n), F.lit(0)))
    return joined.filter(guard).groupBy(KEY).agg(
        F.sum(actual).alias("sum_actual"), F.sum(err).alias("sum_abs_error"),
        _ordered_mean(F.when(actual != 0, err / actual)).alias("mape"),
        seen(base_err).alias("_base_error"), seen(actual).alias("sum_actual_holdout"),
    ).select("*", ratio("sum_abs_error", "sum_actual").alias("wape"),
             ratio("_base_error", "sum_actual_holdout").alias("baseline_wape"))


def backtest_metrics(scores: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Per-variant WAPE and MAPE."""
    return scores.select(KEY, "sum_actual", "sum_abs_error", "wape", "mape", ts_lit(p.run_ts).alias("created_at"))


def backtest_baseline(scores: DataFrame) -> DataFrame:
    """Previous-week baseline WAPE of the variants with holdout sales."""
    return scores.filter(F.col("sum_actual_holdout").isNotNull()).select(KEY, "baseline_wape", "sum_actual_holdout")


def backtest_proof(joined: DataFrame, guard: Column, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Weekly actual / predicted / baseline rows for the dashboard proof chart."""
    return joined.filter(guard).select(
        KEY, "week_start", "actual_qty", "predicted_qty", "baseline_qty",
        F.abs(F.col("actual_qty") - F.col("predicted_qty")).alias("abs_error_pred"),
        F.abs(F.col("actual_qty") - F.col("baseline_qty")).alias("abs_error_base"),
        ts_lit(p.run_ts).alias("created_at"))


def model_quality_flags(scores: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Ordered CASE labels (first match wins, SURVEY Q3)."""
    wape, bw = F.col("wape"), F.col("baseline_wape")
    label = (F.when(F.coalesce("sum_actual_holdout", F.lit(0)) < p.min_holdout_units, F.lit("NO_DATA"))
             .when(wape.isNull(), F.lit("NO_DATA"))
             .when(wape <= p.good_wape, F.lit("GOOD"))
             .when(bw.isNotNull() & (wape >= bw), F.lit("WORSE_THAN_BASELINE"))
             .when(wape > p.bad_wape, F.lit("BAD"))
             .when(wape > p.weak_wape, F.lit("WEAK"))
             .otherwise(F.lit("GOOD")))
    return scores.select(KEY, "wape", "baseline_wape", "sum_actual", label.alias("model_quality"),
                         ts_lit(p.run_ts).alias("created_at"))


def run_backtest(weekly: DataFrame, p: Params = DEFAULT_PARAMS) -> dict[str, DataFrame]:
    """All five validation outputs from one weekly rollup."""
    guard = has_training(weekly, p)
    fc = backtest_forecast(fit_weekly_model(weekly, p), p)
    joined = backtest_joined(holdout_with_baseline(weekly, p), fc)
    scores = backtest_scores(joined, guard)
    return {
        "backtest_forecast_4w": fc,
        "backtest_metrics_variant_4w": backtest_metrics(scores, p),
        "backtest_baseline_4w": backtest_baseline(scores),
        "backtest_proof_4w": backtest_proof(joined, guard, p),
        "model_quality_flags": model_quality_flags(scores, p),
    }
