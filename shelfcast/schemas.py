"""Fixed table schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, DT, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()
MONEY = T.DecimalType(38, 9)


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


PRODUCTS = _schema(("product_id", S, False), ("title", S, True), ("vendor", S, True), ("status", S, True),
                   ("created_at", TS, True), ("updated_at", TS, True))
VARIANTS = _schema(("variant_id", S, False), ("product_id", S, True), ("sku", S, True), ("title", S, True),
                   ("price", D, True), ("inventory_item_id", S, True))
LOCATIONS = _schema(("location_id", S, False), ("name", S, True), ("active", B, True))
INVENTORY_SNAPSHOTS = _schema(
    ("snapshot_id", S, False), ("variant_id", S, True), ("sku", S, True), ("location_id", S, True),
    ("available_qty", L, True), ("incoming_qty", L, True), ("committed_qty", L, True),
    ("snapshot_date", DT, False), ("snapshot_timestamp", TS, True))
SALES_HISTORY = _schema(
    ("sale_id", S, False), ("order_id", S, True), ("order_name", S, True), ("variant_id", S, True),
    ("sku", S, True), ("product_title", S, True), ("quantity_sold", L, True), ("sale_date", DT, False),
    ("sale_timestamp", TS, True), ("vendor", S, True), ("line_price", MONEY, True))
VENDORS = _schema(("vendor_id", L, False), ("vendor_name", S, True), ("lead_time_days", L, True),
                  ("moq", L, True), ("pack_size", L, True))
VENDOR_STATUS = _schema(("vendor_name", S, False), ("archived", B, True), ("archived_at", TS, True),
                        ("note", S, True))

# Output tables whose empty form must still carry the right schema (training guard).
BACKTEST_FORECAST = _schema(("variant_id", S, True), ("week_start", DT, True), ("predicted_qty", L, True))
BACKTEST_METRICS = _schema(("variant_id", S, True), ("sum_actual", L, True), ("sum_abs_error", L, True),
                           ("wape", D, True), ("mape", D, True), ("created_at", TS, True))
BACKTEST_BASELINE = _schema(("variant_id", S, True), ("baseline_wape", D, True), ("sum_actual_holdout", L, True))
BACKTEST_PROOF = _schema(("variant_id", S, True), ("week_start", DT, True), ("actual_qty", L, True),
                         ("predicted_qty", L, True), ("baseline_qty", L, True), ("abs_error_pred", L, True),
                         ("abs_error_base", L, True), ("created_at", TS, True))
MODEL_QUALITY_FLAGS = _schema(("variant_id", S, True), ("wape", D, True), ("baseline_wape", D, True),
                              ("sum_actual", L, True), ("model_quality", S, True), ("created_at", TS, True))

SALES_DAILY = _schema(("sale_date", DT, True), ("variant_id", S, True), ("sku", S, True), ("qty_sold", L, True),
                      ("gross_revenue", MONEY, True))
SALES_WEEKLY = _schema(("week_start", DT, True), ("variant_id", S, True), ("sku", S, True), ("qty_sold", L, True))
DEMAND_FORECASTS = _schema(("variant_id", S, True), ("forecast_date", DT, True), ("predicted_qty", L, True),
                           ("confidence_lower", L, True), ("confidence_upper", L, True), ("created_at", TS, True))
STOCKOUTS = _schema(("variant_id", S, True), ("current_stock", L, True), ("stockout_date", DT, True),
                    ("days_remaining", T.IntegerType(), True), ("created_at", TS, True))
VENDOR_RANK = _schema(("vendor_name", S, True), ("vendor_units_sold_6m", L, True), ("vendor_revenue_6m", D, True),
                      ("revenue_rank", T.IntegerType(), True), ("frozen_as_of_date", DT, True))
VENDOR_CADENCE = _schema(("vendor_name", S, True), ("revenue_rank", T.IntegerType(), True), ("vendor_revenue_6m", D, True),
                         ("vendor_units_sold_6m", L, True), ("restock_frequency_days", T.IntegerType(), True),
                         ("frozen_as_of_date", DT, True))
RESTOCKS = _schema(
    ("vendor_name", S, True), ("variant_id", S, True), ("sku", S, True), ("product_title", S, True), ("variant_title", S, True),
    ("current_stock", L, True), ("raw_stock", L, True), ("negative_stock_flag", B, True), ("lead_time_days", L, True),
    ("moq", L, True), ("pack_size", L, True), ("horizon_days", L, True), ("model_quality", S, True), ("expected_demand", L, True),
    ("demand_source", S, True), ("reorder_qty", L, True), ("expected_demand_forecast", L, True),
    ("expected_demand_fallback", L, True), ("snapshot_date", DT, True), ("created_at", TS, True))

# Table definitions: name -> (schema, partition column or None, cluster column or None, not-null keys)
TABLES = {
    "products": (PRODUCTS, None, None, ("product_id",)),
    "variants": (VARIANTS, None, None, ("variant_id",)),
    "locations": (LOCATIONS, None, None, ("location_id",)),
    "inventory_snapshots_raw": (INVENTORY_SNAPSHOTS, "snapshot_date", "sku", ("snapshot_id", "snapshot_date")),
    "inventory_snapshots_stg": (INVENTORY_SNAPSHOTS, None, None, ("snapshot_id", "snapshot_date")),
    "sales_history_raw": (SALES_HISTORY, "sale_date", "sku", ("sale_id", "sale_date")),
    "sales_history_stg": (SALES_HISTORY, None, None, ("sale_id", "sale_date")),
    "vendors": (VENDORS, None, None, ("vendor_id",)),
    "vendor_status": (VENDOR_STATUS, None, None, ("vendor_name",)),
    "backtest_forecast_4w": (BACKTEST_FORECAST, None, None, ()),
    "backtest_metrics_variant_4w": (BACKTEST_METRICS, None, None, ()),
    "backtest_baseline_4w": (BACKTEST_BASELINE, None, None, ()),
    "backtest_proof_4w": (BACKTEST_PROOF, None, None, ()),
    "model_quality_flags": (MODEL_QUALITY_FLAGS, None, None, ()),
    "sales_daily": (SALES_DAILY, "sale_date", "variant_id", ()),
    "sales_weekly": (SALES_WEEKLY, "week_start", "variant_id", ()),
    "demand_forecasts": (DEMAND_FORECASTS, None, None, ()),
    "stockout_predictions": (STOCKOUTS, None, None, ()),
    "vendor_sales_rank_one_time": (VENDOR_RANK, None, None, ()),
    "vendor_restock_cadence_one_time": (VENDOR_CADENCE, None, None, ()),
    "vendor_restocks_weekly": (RESTOCKS, None, None, ()),
    "vendor_restocks_biweekly": (RESTOCKS, None, None, ()),
}
