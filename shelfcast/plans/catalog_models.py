"""Registered forecasting, backtest, stock-out and restock queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import backtest, demand, forecast, holidays, inventory, restock, views
from shelfcast.plans.catalog import (ACTIVE_CTE, AS_OF, CI_CTE, CONFIG, INTERNAL, P, RANK_CTE, RUN_TS, SALES_DAILY_CTE,
                                     SALES_DAILY_V_CTE, SALES_WEEKLY_CTE, VVM_CTE, fx, register)
from shelfcast.plans.oracle_fixture import d, with_fixture
from shelfcast.plans.oracle_forecast import fit_ctes, forecast_cte, holiday_ctes, qty, rounded
from shelfcast.plans.weekly import WeeklyRun, from_fixture
from shelfcast.sources.testdata import Fixture

Z = P.z_value
TRAIN_START, CUTOFF, LAST_WEEK = d(P.train_start_week), d(P.cutoff_week_start), d(P.last_complete_week_start)
FIT_COLS = ("variant_id, n, last_ts, model, score, sigma, y_mean, y_last, drift, intercept, slope, t_mean, sxx, "
            + ", ".join(f"season_w{w}" for w in range(7)))


# ------------------------------------------------------------------ Spark side: one WeeklyRun per query
SHARED_RUNS: dict | None = None     # bench: one WeeklyRun per (session, data, grain), steps reused in order


_OPEN: list[WeeklyRun] = []


def close_runs() -> None:
    """Delete the materialized steps of every run that a query has started."""
    while _OPEN:
        _OPEN.pop().cleanup()


def run(f: Fixture) -> WeeklyRun:
    if SHARED_RUNS is None:
        _OPEN.append(from_fixture(f, P))
        return _OPEN[-1]
    k = (id(f.spark), f.sf_dir, f.grain)
    if k not in SHARED_RUNS:
        SHARED_RUNS[k] = from_fixture(f, P)
    return SHARED_RUNS[k]


def round_floats(df: DataFrame) -> DataFrame:
    """Doubles to 6 places: the oracle sums over the filled grid, in another order."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ------------------------------------------------------------------ oracle CTE chains
WEEKLY_BASE = [*CONFIG, ACTIVE_CTE, VVM_CTE, SALES_DAILY_V_CTE, SALES_WEEKLY_CTE]
TRAIN_CTE = f"""train AS (
  SELECT variant_id, week_start AS ts, qty_sold AS y FROM sales_weekly
  WHERE week_start >= {TRAIN_START} AND week_start < {CUTOFF} AND qty_sold > 0)"""
BACKTEST = WEEKLY_BASE + [TRAIN_CTE] + fit_ctes("wk", "train", 7) + [
    forecast_cte("wk", P.holdout_weeks, 7, Z),
    f"""bt_fc AS (SELECT variant_id, forecast_ts AS week_start, {qty('forecast_value')} AS predicted_qty FROM wk_fc)""",
    # One cell per (variant, week) with a sale or a forecast; last week's sale is carried into the next cell.
    f"""cells AS (
  SELECT variant_id, week, sum(sold) FILTER (WHERE kind = 'sale') IS NOT NULL AS has_sale,
         coalesce(sum(sold) FILTER (WHERE kind = 'sale'), 0)::BIGINT AS actual_qty,
         coalesce(sum(sold) FILTER (WHERE kind = 'model'), 0)::BIGINT AS predicted_qty,
         coalesce(sum(sold) FILTER (WHERE kind = 'week before'), 0)::BIGINT AS carried_qty
  FROM (SELECT variant_id, week_start AS week, qty_sold AS sold, 'sale' AS kind FROM sales_weekly
        UNION ALL SELECT variant_id, week_start + 7, qty_sold, 'week before' FROM sales_weekly
        UNION ALL SELECT variant_id, week_start, predicted_qty, 'model' FROM bt_fc)
  WHERE EXISTS (FROM train) AND (kind = 'model' OR week BETWEEN {CUTOFF} AND {LAST_WEEK})
  GROUP BY ALL HAVING count(*) FILTER (WHERE kind <> 'week before') > 0)""",
    f"""proof AS (
  SELECT variant_id, week AS week_start, actual_qty, predicted_qty, if(has_sale, carried_qty, 0) AS baseline_qty,
         abs(actual_qty - predicted_qty) AS abs_error_pred, abs(actual_qty - if(has_sale, carried_qty, 0)) AS abs_error_base,
         {RUN_TS} AS created_at
  FROM cells)""",
    """scores AS (
  SELECT variant_id, sum(actual_qty)::BIGINT AS sum_actual, sum(abs_error_pred)::BIGINT AS sum_abs_error,
         sum_abs_error / nullif(sum_actual, 0)::DOUBLE AS wape,
         list(abs_error_pred / actual_qty ORDER BY abs_error_pred / actual_qty) FILTER (WHERE actual_qty <> 0) AS shares,
         list_reduce(shares, lambda a, b: a + b) / len(shares) AS mape,
         sum(actual_qty) FILTER (WHERE has_sale)::BIGINT AS sum_actual_holdout,
         sum(abs_error_base) FILTER (WHERE has_sale) / nullif(sum_actual_holdout, 0)::DOUBLE AS baseline_wape
  FROM proof JOIN cells USING (variant_id, actual_qty, predicted_qty) WHERE week = week_start GROUP BY variant_id)""",
    f"""metrics AS (SELECT variant_id, sum_actual, sum_abs_error, wape, mape, {RUN_TS} AS created_at FROM scores)""",
    """baseline AS (SELECT variant_id, baseline_wape, sum_actual_holdout FROM scores WHERE sum_actual_holdout IS NOT NULL)""",
    # Labels as a ranked list of (label, holds); the first that holds is taken.
    f"""flags AS (
  SELECT variant_id, wape, baseline_wape, sum_actual,
         list_filter([{{'label': 'NO_DATA', 'holds': ifnull(sum_actual_holdout, 0) < {P.min_holdout_units} OR wape IS NULL}},
                      {{'label': 'GOOD', 'holds': wape <= {P.good_wape}}},
                      {{'label': 'WORSE_THAN_BASELINE', 'holds': wape >= baseline_wape}},
                      {{'label': 'BAD', 'holds': wape > {P.bad_wape}}}, {{'label': 'WEAK', 'holds': wape > {P.weak_wape}}},
                      {{'label': 'GOOD', 'holds': TRUE}}], lambda rule: ifnull(rule.holds, FALSE))[1].label AS model_quality,
         {RUN_TS} AS created_at
  FROM scores)""",
]

DTRAIN_CTE = """dtrain AS (
  SELECT variant_id, sale_date AS ts, qty_sold AS y FROM sales_daily_v SEMI JOIN vvm USING (variant_id) WHERE qty_sold > 0)"""
FORECAST_CTES = fit_ctes("dm", "dtrain", 1, season=True) + [
    forecast_cte("dm", P.forecast_horizon_days, 1, Z)] + holiday_ctes("dm", "dtrain") + [
    f"""demand_forecasts AS (
  SELECT variant_id, forecast_ts AS forecast_date, {qty('forecast_value')} AS predicted_qty,
         {qty('lower_bound')} AS confidence_lower, {qty('upper_bound')} AS confidence_upper, {RUN_TS} AS created_at
  FROM dm_fch WHERE forecast_value > 0)"""]
STOCK_CTE = f"""stock AS (
  SELECT variant_id, any_value(snapshot_date) AS snapshot_date, sum(available_qty)::BIGINT AS raw_stock,
         if(sum(available_qty) < 0, 0, sum(available_qty))::BIGINT AS on_hand
  FROM inventory
  WHERE variant_id > '' AND snapshot_date = (SELECT max(snapshot_date) FROM inventory WHERE {AS_OF} - snapshot_date BETWEEN 0 AND 30)
  GROUP BY variant_id)"""
DAILY = BACKTEST + [DTRAIN_CTE, *FORECAST_CTES, STOCK_CTE]


# ------------------------------------------------------------------ C23-C29 backtest
@register("c23_training_guard", with_fixture(WEEKLY_BASE + [TRAIN_CTE], """
SELECT count(*) AS train_rows, count(*) > 0 AS has_training FROM train"""))
def q_training_guard(spark, sf_dir, grain="bt"):
    t = backtest.training_rows(run(fx(spark, sf_dir, grain)).sales_weekly, P)
    return t.agg(F.count(F.lit(1)).alias("train_rows")).select("train_rows", (F.col("train_rows") > 0).alias("has_training"))


@register("c24_fit_weekly_model", with_fixture(BACKTEST, f"SELECT {rounded(FIT_COLS)} FROM wk_fit"))
def q_fit_weekly_model(spark, sf_dir, grain="bt"):
    return round_floats(run(fx(spark, sf_dir, grain)).weekly_model)


@register("c25_backtest_forecast", with_fixture(BACKTEST, "SELECT * FROM bt_fc"))
def q_backtest_forecast(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).backtest_forecast


@register("c26_backtest_metrics", with_fixture(BACKTEST, "SELECT * FROM metrics"))
def q_backtest_metrics(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).metrics


@register("c27_backtest_baseline", with_fixture(BACKTEST, "SELECT * FROM baseline"))
def q_backtest_baseline(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).baseline


@register("c28_backtest_proof", with_fixture(BACKTEST, "SELECT * FROM proof"))
def q_backtest_proof(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).proof


@register("c29_model_quality_flags", with_fixture(BACKTEST, "SELECT * FROM flags"))
def q_model_quality_flags(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).flags


# ------------------------------------------------------------------ C30-C32 daily model, stock-outs
@register("c30_fit_demand_model", with_fixture(DAILY, f"SELECT {rounded(FIT_COLS)} FROM dm_fit"))
def q_fit_demand_model(spark, sf_dir, grain="bt"):
    return round_floats(run(fx(spark, sf_dir, grain)).demand_model)


@register("c31_demand_forecasts", with_fixture(DAILY, "SELECT * FROM demand_forecasts"))
def q_demand_forecasts(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).demand_forecasts


@register("c32_stockout_predictions", with_fixture(DAILY, f"""
SELECT variant_id, on_hand AS current_stock, min(forecast_date) AS stockout_date,
       (min(forecast_date) - {AS_OF})::INTEGER AS days_remaining, {RUN_TS} AS created_at
FROM stock s JOIN demand_forecasts f USING (variant_id)
WHERE on_hand > 0 AND on_hand <= (SELECT sum(u.predicted_qty) FROM demand_forecasts u
                                  WHERE u.variant_id = f.variant_id AND u.forecast_date <= f.forecast_date)
GROUP BY ALL"""))
def q_stockout_predictions(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).stockouts


# ------------------------------------------------------------------ C33 restock, C37 view
# One line per (vendor, variant): its units inside the vendor's horizon, its usual units, its stock, its need.
RESTOCK = DAILY + [RANK_CTE, f"""lines AS (
  SELECT l.vendor_name, l.variant_id, l.sku, 'Product ' || l.variant_id AS product_title, k.title AS variant_title,
         v.lead_time_days, v.moq, v.pack_size, v.lead_time_days + {P.review_days} + {P.safety_days} AS horizon_days,
         ifnull((SELECT model_quality FROM flags f WHERE f.variant_id = l.variant_id), 'NO_DATA') AS model_quality
  FROM vvm l JOIN vendors_m v USING (vendor_name) JOIN variants_k k USING (variant_id)
  WHERE if((SELECT revenue_rank FROM vendor_rank r WHERE r.vendor_name = l.vendor_name) <= {P.fast_cadence_top_n}, 7, 14) = {{cadence}}
    AND l.vendor_name IN (SELECT vendor_name FROM vendor_rank))""", f"""needs AS (
  SELECT l.*, ifnull(s.raw_stock, 0) AS raw_stock, ifnull(s.on_hand, 0) AS current_stock,
         ifnull((SELECT sum(predicted_qty) FROM demand_forecasts f WHERE f.variant_id = l.variant_id
                 AND f.forecast_date - {AS_OF} BETWEEN 0 AND l.horizon_days), 0)::BIGINT AS expected_demand_forecast,
         round(round(l.horizon_days * ifnull((SELECT sum(qty_sold) FROM sales_daily_v d WHERE d.variant_id = l.variant_id
                 AND {AS_OF} - d.sale_date <= {P.fallback_days}), 0)::DOUBLE / {P.fallback_days}, 6))::BIGINT AS expected_demand_fallback
  FROM lines l LEFT JOIN stock s USING (variant_id))""", f"""restocks AS (
  SELECT vendor_name, variant_id, sku, product_title, variant_title, current_stock, raw_stock,
         raw_stock < 0 AS negative_stock_flag, lead_time_days, moq, pack_size, horizon_days, model_quality,
         if(model_quality = 'GOOD', expected_demand_forecast, expected_demand_fallback) AS expected_demand,
         if(model_quality = 'GOOD', 'FORECAST', 'FALLBACK_56D') AS demand_source,
         if(expected_demand > current_stock,
            greatest(moq, pack_size * ceil((expected_demand - current_stock) / pack_size)::BIGINT), 0) AS reorder_qty,
         expected_demand_forecast, expected_demand_fallback, (SELECT max(snapshot_date) FROM stock) AS snapshot_date,
         {RUN_TS} AS created_at
  FROM needs)"""]


def restock_sql(cadence: int, select: str):
    return with_fixture([c.replace("{cadence}", str(cadence)) for c in RESTOCK], select)


RESTOCK_SELECT = """SELECT * FROM restocks WHERE reorder_qty > 0
ORDER BY negative_stock_flag DESC, reorder_qty DESC, vendor_name, variant_id"""


@register("c33_vendor_restocks_weekly", restock_sql(7, RESTOCK_SELECT))
def q_vendor_restocks_weekly(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).restocks(7)


@register("c33b_vendor_restocks_biweekly", restock_sql(14, RESTOCK_SELECT))
def q_vendor_restocks_biweekly(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).restocks(14)


@register("c37_v_vendor_restocks_weekly_active", restock_sql(7, """
SELECT * FROM restocks SEMI JOIN open_vendors USING (vendor_name) WHERE reorder_qty > 0"""))
def q_v_vendor_restocks_weekly_active(spark, sf_dir, grain="bt"):
    return run(fx(spark, sf_dir, grain)).restocks_active_view(7)


# ------------------------------------------------------------------ C40-C42 model KPIs
@register("c40_model_kpis", with_fixture(BACKTEST, """
SELECT count(*) AS products_evaluated,
       round(100.0 * sum(CASE WHEN model_quality = 'GOOD' THEN 1 ELSE 0 END) / count(*), 2) AS pct_good,
       median(wape) AS median_wape,
       round(100.0 * sum(CASE WHEN model_quality = 'WORSE_THAN_BASELINE' THEN 1 ELSE 0 END) / count(*), 2) AS pct_worse_than_baseline
FROM flags WHERE model_quality <> 'NO_DATA'"""))
def q_model_kpis(spark, sf_dir, grain="bt"):
    return views.model_kpis(run(fx(spark, sf_dir, grain)).flags)


@register("c41a_quality_distribution", with_fixture(BACKTEST, """
SELECT model_quality, n_variants, round(100.0 * n_variants / sum(n_variants) OVER (), 2) AS pct
FROM (SELECT model_quality, count(*) AS n_variants FROM flags WHERE model_quality <> 'NO_DATA' GROUP BY model_quality)"""))
def q_quality_distribution(spark, sf_dir, grain="bt"):
    return views.quality_distribution(run(fx(spark, sf_dir, grain)).flags)


@register("c41b_wape_scatter", with_fixture(BACKTEST, """
SELECT variant_id, wape, baseline_wape, model_quality FROM flags WHERE model_quality <> 'NO_DATA'"""))
def q_wape_scatter(spark, sf_dir, grain="bt"):
    return views.wape_scatter(run(fx(spark, sf_dir, grain)).flags)


@register("c42_proof_series", with_fixture(BACKTEST, """
SELECT week_start, CAST(sum(actual_qty) AS BIGINT) AS actual_qty, CAST(sum(predicted_qty) AS BIGINT) AS predicted_qty,
       CAST(sum(baseline_qty) AS BIGINT) AS baseline_qty
FROM proof GROUP BY week_start"""))
def q_proof_series(spark, sf_dir, grain="bt"):
    return views.proof_series(run(fx(spark, sf_dir, grain)).proof)


# ------------------------------------------------------------------ §2.10 regularize / infer_frequency
@register("f01_regularize_weekly_zero", with_fixture(BACKTEST, """
SELECT g.variant_id, g.week_start, CAST(COALESCE(t.y, 0) AS DOUBLE) AS qty_sold
FROM (SELECT variant_id, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 7 DAY)) AS DATE) AS week_start
      FROM train GROUP BY variant_id) g
LEFT JOIN train t ON t.variant_id = g.variant_id AND t.ts = g.week_start"""))
def q_regularize_weekly_zero(spark, sf_dir, grain="bt"):
    r = run(fx(spark, sf_dir, grain))
    return forecast.regularize(backtest.training_rows(r.sales_weekly, P), "variant_id", "week_start", "qty_sold", 7)


@register("f02_regularize_daily_linear", with_fixture(DAILY, """
SELECT variant_id, ts AS sale_date,
       CASE WHEN y IS NOT NULL THEN CAST(y AS DOUBLE)
            ELSE CAST(py AS DOUBLE) + CAST(ny - py AS DOUBLE) * (CAST(d - pd AS DOUBLE) / CAST(nd - pd AS DOUBLE)) END AS qty_sold
FROM (SELECT g.variant_id, g.ts, t.y, CAST(g.ts - DATE '1970-01-01' AS BIGINT) AS d,
             last_value(t.y IGNORE NULLS) OVER (PARTITION BY g.variant_id ORDER BY g.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS py,
             last_value(CASE WHEN t.y IS NOT NULL THEN CAST(g.ts - DATE '1970-01-01' AS BIGINT) END IGNORE NULLS)
               OVER (PARTITION BY g.variant_id ORDER BY g.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
             first_value(t.y IGNORE NULLS) OVER (PARTITION BY g.variant_id ORDER BY g.ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ny,
             first_value(CASE WHEN t.y IS NOT NULL THEN CAST(g.ts - DATE '1970-01-01' AS BIGINT) END IGNORE NULLS)
               OVER (PARTITION BY g.variant_id ORDER BY g.ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
      FROM (SELECT variant_id, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS DATE) AS ts
            FROM dtrain GROUP BY variant_id) g
      LEFT JOIN dtrain t ON t.variant_id = g.variant_id AND t.ts = g.ts)"""))
def q_regularize_daily_linear(spark, sf_dir, grain="bt"):
    train = run(fx(spark, sf_dir, grain)).demand_train
    return forecast.regularize(train, "variant_id", "sale_date", "qty_sold", 1, policy="linear")


@register("f03_infer_frequency", with_fixture(DAILY, """
SELECT k.variant_id, b.gap AS freq_days
FROM (SELECT DISTINCT variant_id FROM dtrain) k
LEFT JOIN (
  SELECT variant_id, gap FROM (
    SELECT variant_id, gap, row_number() OVER (PARTITION BY variant_id ORDER BY n DESC, gap) AS rn
    FROM (SELECT variant_id, gap, count(*) AS n FROM (
            SELECT variant_id, CAST(date_diff('day', lag(ts) OVER (PARTITION BY variant_id ORDER BY ts), ts) AS INTEGER) AS gap
            FROM dtrain) WHERE gap IS NOT NULL GROUP BY variant_id, gap))
  WHERE rn = 1) b ON b.variant_id = k.variant_id"""))
def q_infer_frequency(spark, sf_dir, grain="bt"):
    train = run(fx(spark, sf_dir, grain)).demand_train
    return forecast.infer_frequency(train, "variant_id", "sale_date")



@register("f04_holiday_effects", with_fixture(DAILY, f"SELECT {rounded('variant_id, holiday, holiday_effect')} FROM dm_he"))
def q_holiday_effects(spark, sf_dir, grain="bt"):
    return round_floats(run(fx(spark, sf_dir, grain)).holiday_effects)


# ------------------------------------------------------------------ stand-alone forms of C30, C31, C32
STANDALONE = [SALES_DAILY_CTE, f"""dtrain AS (
  SELECT variant_id, sale_date AS ts, qty_sold AS y FROM sales_daily
  WHERE qty_sold > 0 AND variant_id IN (SELECT variant_id FROM variants_k WHERE NOT list_contains([{INTERNAL}], vendor)))""",
              *FORECAST_CTES]


def standalone(f: Fixture) -> tuple[DataFrame, DataFrame]:
    """(model, forecasts with sku) over the daily rollup alone: no vendor status, internal vendors left out."""
    daily = demand.sales_daily(f.sales_table(), f.variants, P)
    train = forecast.demand_model_input(daily, P, variants=f.variants, products=f.products)
    model = forecast.fit_demand_model(train)
    calendar = holidays.run_calendar(f.spark, P)
    effects = holidays.holiday_effects(train, model, "variant_id", "sale_date", "qty_sold", calendar)
    return model, forecast.demand_forecasts(model, P, f.variants, effects, calendar)


@register("c30s_fit_demand_model_standalone", with_fixture(STANDALONE, f"SELECT {rounded(FIT_COLS)} FROM dm_fit"))
def q_fit_demand_model_standalone(spark, sf_dir, grain="bt"):
    return round_floats(standalone(fx(spark, sf_dir, grain))[0])


@register("c31s_demand_forecasts_standalone", with_fixture(STANDALONE, """
SELECT f.variant_id, k.sku, f.* EXCLUDE (variant_id) FROM demand_forecasts f JOIN variants_k k USING (variant_id)"""))
def q_demand_forecasts_standalone(spark, sf_dir, grain="bt"):
    return standalone(fx(spark, sf_dir, grain))[1]


@register("c32s_stockouts_standalone", with_fixture([*STANDALONE, CI_CTE], f"""
SELECT variant_id, current_stock, min(forecast_date) AS stockout_date, (min(forecast_date) - {AS_OF})::INTEGER AS days_remaining,
       {RUN_TS} AS created_at
FROM ci JOIN (SELECT variant_id, forecast_date, sum(predicted_qty) OVER (PARTITION BY variant_id ORDER BY forecast_date) AS used
              FROM demand_forecasts) USING (variant_id)
WHERE current_stock > 0 AND used >= current_stock GROUP BY ALL"""))
def q_stockouts_standalone(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return restock.stockout_predictions(standalone(f)[1], inventory.current_inventory(f.inventory, P), P)
