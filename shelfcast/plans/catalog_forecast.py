"""Registered queries of the autoregressive fit and of fits with a frequency per series (§2.10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import arima, frequency
from shelfcast.operators.forecast import to_quantity
from shelfcast.plans.catalog import P, fx, register
from shelfcast.plans.catalog_models import DAILY, Z, round_floats, run
from shelfcast.plans.oracle_arima import FIT, arima_ctes, arima_forecast_cte
from shelfcast.plans.oracle_fixture import with_fixture
from shelfcast.plans.oracle_forecast import fit_ctes, forecast_cte, qty, rounded


# ------------------------------------------------------------------ auto_arima
AR = DAILY + arima_ctes("dm")
AR_QTY = f"{qty('forecast_value')} AS predicted_qty, {qty('lower_bound')} AS confidence_lower, {qty('upper_bound')} AS confidence_upper"


def _quantities(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "forecast_ts", to_quantity("forecast_value").alias("predicted_qty"),
                     to_quantity("prediction_interval_lower_bound").alias("confidence_lower"),
                     to_quantity("prediction_interval_upper_bound").alias("confidence_upper"))


@register("f05_fit_arima", with_fixture(AR, f"SELECT {FIT} FROM dm_ar"))
def q_fit_arima(spark, sf_dir, grain="bt"):
    model = arima.fit_arima(run(fx(spark, sf_dir, grain)).demand_train, "variant_id", "sale_date", "qty_sold", 1)
    return round_floats(model.select("variant_id", *arima.FIT_COLUMNS))


@register("f06_forecast_arima", with_fixture([*AR, arima_forecast_cte("dm", P.forecast_horizon_days, 1, Z)],
                                             f"SELECT variant_id, forecast_ts, {AR_QTY} FROM dm_arfc"))
def q_forecast_arima(spark, sf_dir, grain="bt"):
    model = arima.fit_arima(run(fx(spark, sf_dir, grain)).demand_train, "variant_id", "sale_date", "qty_sold", 1)
    return _quantities(arima.forecast_arima(model, "variant_id", P.forecast_horizon_days, 1, Z), "variant_id")


# ------------------------------------------------------------------ AUTO_FREQUENCY
# Daily, weekly and monthly series in one table: the daily sales, their weeks and their months.
MIXED = [*DAILY, """mixed AS (
  SELECT 'daily ' || variant_id AS variant_id, ts, y FROM dtrain
  UNION ALL SELECT 'weekly ' || variant_id, date_trunc('week', ts)::DATE, sum(y)::BIGINT FROM dtrain GROUP BY ALL
  UNION ALL SELECT 'monthly ' || variant_id, date_trunc('month', ts)::DATE, sum(y)::BIGINT FROM dtrain GROUP BY ALL)""",
         """freq AS (
  SELECT variant_id, origin, if(gap BETWEEN 28 AND 31 OR gap BETWEEN 89 AND 92 OR gap IN (365, 366), 'month', 'day') AS unit,
         (CASE WHEN gap BETWEEN 28 AND 31 THEN 1 WHEN gap BETWEEN 89 AND 92 THEN 3 WHEN gap IN (365, 366) THEN 12 ELSE ifnull(gap, 1) END)::INTEGER AS step
  FROM (SELECT variant_id, min(ts) AS origin FROM mixed GROUP BY ALL)
  LEFT JOIN (SELECT variant_id, gap
             FROM (SELECT variant_id, gap, count(*) AS times
                   FROM (SELECT variant_id, ts - lag(ts) OVER (PARTITION BY variant_id ORDER BY ts) AS gap FROM mixed)
                   WHERE gap IS NOT NULL GROUP BY ALL)
             QUALIFY row_number() OVER (PARTITION BY variant_id ORDER BY times DESC, gap) = 1)
    USING (variant_id))""",
         """numbered AS (
  SELECT variant_id, DATE '1970-01-01' + t AS ts, sum(y)::BIGINT AS y
  FROM (SELECT variant_id, y, CASE unit WHEN 'month' THEN datediff('month', origin, ts) // step ELSE (ts - origin) // step END::INTEGER AS t
        FROM mixed JOIN freq USING (variant_id)) GROUP BY ALL)""", *fit_ctes("mx", "numbered", 1)]
DATED = "CASE unit WHEN 'month' THEN (origin + to_months((({t}) * step)::INTEGER))::DATE ELSE origin + (({t}) * step)::INTEGER END"
MIX_COLS = "n, model, score, sigma, y_mean, y_last, drift, intercept, slope, t_mean, sxx"


def _mixed(spark, sf_dir, grain) -> DataFrame:
    train = run(fx(spark, sf_dir, grain)).demand_train
    named = lambda label, ts: train.select(F.concat(F.lit(label + " "), "variant_id").alias("variant_id"), F.expr(f"{ts} AS ts"),
                                           F.col("qty_sold").alias("y"))
    rollup = lambda label, unit: (named(label, f"CAST(date_trunc('{unit}', sale_date) AS DATE)")
                                  .groupBy("variant_id", "ts").agg(F.sum("y").alias("y")))
    return named("daily", "sale_date").unionByName(rollup("weekly", "week")).unionByName(rollup("monthly", "month"))


@register("f07_fit_auto_frequency", with_fixture(MIXED, f"""
SELECT variant_id, origin, unit, step, {DATED.format(t='n - 1')} AS last_ts, {rounded(MIX_COLS)} FROM mx_fit JOIN freq USING (variant_id)"""))
def q_fit_auto_frequency(spark, sf_dir, grain="bt"):
    model = frequency.fit_auto(_mixed(spark, sf_dir, grain), "variant_id", "ts", "y")
    return round_floats(model.select("variant_id", "origin", "unit", "step", "last_ts", *MIX_COLS.split(", ")))


@register("f08_forecast_auto_frequency", with_fixture([*MIXED, forecast_cte("mx", 12, 1, Z)], f"""
SELECT variant_id, {DATED.format(t="forecast_ts - DATE '1970-01-01'")} AS forecast_ts, {AR_QTY} FROM mx_fc JOIN freq USING (variant_id)"""))
def q_forecast_auto_frequency(spark, sf_dir, grain="bt"):
    model = frequency.fit_auto(_mixed(spark, sf_dir, grain), "variant_id", "ts", "y")
    return _quantities(frequency.forecast_auto(model, "variant_id", 12, Z), "variant_id")
