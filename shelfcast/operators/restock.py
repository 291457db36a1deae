"""Stock-out dates and vendor re-order lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit, null_greatest, round_to_long, safe_div, ts_lit
from shelfcast.operators.inventory import newest_snapshot
from shelfcast.operators.vendors import active_vendors, vendor_defaults
from shelfcast.params import DEFAULT_PARAMS, Params


def stockout_predictions(forecasts: DataFrame, current: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """First forecast date where cumulative demand reaches current stock.

    The running sum is a per-variant window over at most ``horizon`` rows.
    Forecast dates before ``as_of`` are kept by default (SURVEY Q9), so
    ``days_remaining`` may be negative; ``Params.stockout_from_as_of`` drops them.
    """
    ci = current.filter(F.col("current_stock") > 0).select("variant_id", "current_stock")
    f = forecasts.select("variant_id", "forecast_date", "predicted_qty")
    if p.stockout_from_as_of:
        f = f.filter(F.col("forecast_date") >= date_lit(p.as_of))
    run = Window.partitionBy("variant_id").orderBy("forecast_date").rowsBetween(Window.unboundedPreceding, 0)
    cum = f.join(ci, "variant_id").select("variant_id", "forecast_date", "current_stock",
                                          F.sum("predicted_qty").over(run).alias("cum_demand"))
    return (cum.filter(F.col("cum_demand") >= F.col("current_stock"))
            .groupBy("variant_id", "current_stock").agg(F.min("forecast_date").alias("stockout_date"))
            .select("variant_id", "current_stock", "stockout_date",
                    F.datediff("stockout_date", date_lit(p.as_of)).alias("days_remaining"),
                    ts_lit(p.run_ts).alias("created_at")))


def raw_inventory(snapshots: DataFrame, p: Params = DEFAULT_PARAMS, latest: dt.date | None = None) -> DataFrame:
    """Summed stock per variant on the latest snapshot of the last 30 days (blank variants dropped)."""
    day = newest_snapshot(snapshots, p, p.snapshot_lookback_days, latest)
    v = F.col("variant_id")
    return (snapshots.filter((F.col("snapshot_date") == day) & v.isNotNull() & (v != ""))
            .groupBy("variant_id").agg(F.sum("available_qty").alias("raw_stock")))


def fallback_demand(sales: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Average daily units over ``as_of - 56`` .. ``as_of`` (57 dates, divisor 56; SURVEY Q8)."""
    v = F.col("variant_id")
    return (sales.filter(F.col("sale_date").between(date_lit(p.days_ago(p.fallback_days)), date_lit(p.as_of))
                         & v.isNotNull() & (v != ""))
            .groupBy("variant_id")
            .agg(safe_div(F.sum("quantity_sold"), F.lit(p.fallback_days)).alias("avg_daily_units")))


def fallback_from_daily(sales_daily: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """The same 56-day average from the (already built) daily rollup instead of the raw history.

    Equal to ``fallback_demand`` on the validation-form rollup (blank variants
    dropped, one row per date and variant), without another fact scan.
    """
    return (sales_daily.filter(F.col("sale_date").between(date_lit(p.days_ago(p.fallback_days)), date_lit(p.as_of)))
            .groupBy("variant_id")
            .agg(safe_div(F.sum("qty_sold"), F.lit(p.fallback_days)).alias("avg_daily_units")))


def vendor_restocks(variant_map: DataFrame, status: DataFrame, cadence: DataFrame, vendors: DataFrame,
                    snapshots: DataFrame, forecasts: DataFrame, fallback: DataFrame, flags: DataFrame,
                    p: Params = DEFAULT_PARAMS, cadence_days: int | None = None,
                    latest: dt.date | None = None, stock: DataFrame | None = None) -> DataFrame:
    """Re-order list for vendors on a ``cadence_days`` cycle (7 = weekly list, 14 = bi-weekly).

    ``variant_map`` carries both titles; ``fallback`` is `fallback_demand` or
    `fallback_from_daily`; ``stock`` is `inventory.restock_stock` if the caller
    has it already. horizon = lead time + review (7) + safety (3) days;
    forecast demand sums the inclusive window ``[as_of, as_of + horizon]`` per
    (vendor, variant), so a variant that two vendors supply gets each vendor's
    own horizon. GOOD-quality items use the forecast, everything else the
    56-day average. Quantity = 0 when stock covers demand, else
    ``max(moq, ceil(need / pack) * pack)``.
    """
    cadence_days = p.cadence_days if cadence_days is None else cadence_days
    as_of = date_lit(p.as_of)

    vendor_cfg = (vendor_defaults(vendors, p).select("vendor_name", "lead_time_days", "moq", "pack_size")
                  .join(active_vendors(status, p), "vendor_name")
                  .join(cadence.filter(F.col("restock_frequency_days") == cadence_days).select("vendor_name"),
                        "vendor_name"))
    horizon = (F.col("lead_time_days") + p.review_days + p.safety_days)
    items = (variant_map.select("variant_id", "sku", "vendor_name", "product_title", "variant_title")
             .join(vendor_cfg, "vendor_name").withColumn("horizon_days", horizon))

    window = items.select("vendor_name", "variant_id", F.date_add(as_of, F.col("horizon_days").cast("int")).alias("horizon_end"))
    fd = (forecasts.select("variant_id", "forecast_date", "predicted_qty").filter(F.col("forecast_date") >= as_of)
          .join(window, "variant_id").filter(F.col("forecast_date") <= F.col("horizon_end"))
          .groupBy("vendor_name", "variant_id").agg(F.sum("predicted_qty").alias("expected_demand_forecast")))

    ri = raw_inventory(snapshots, p, latest) if stock is None else stock.select("variant_id", "raw_stock")
    mq = flags.select("variant_id", "model_quality")

    j = (items.join(ri, "variant_id", "left").join(fallback, "variant_id", "left").join(mq, "variant_id", "left")
         .join(fd, ["vendor_name", "variant_id"], "left"))

    raw = F.coalesce("raw_stock", F.lit(0).cast("bigint"))
    stock = F.coalesce(null_greatest("raw_stock"), F.lit(0).cast("bigint"))
    quality = F.coalesce("model_quality", F.lit("NO_DATA"))
    fcst = F.coalesce("expected_demand_forecast", F.lit(0).cast("bigint"))
    usual = round_to_long(F.coalesce("avg_daily_units", F.lit(0.0)) * F.col("horizon_days"))
    calc = j.select(
        "vendor_name", "variant_id", "sku", "product_title", "variant_title",
        stock.alias("current_stock"), raw.alias("raw_stock"), (raw < 0).alias("negative_stock_flag"),
        "lead_time_days", "moq", "pack_size", "horizon_days", quality.alias("model_quality"),
        F.when(quality == "GOOD", fcst).otherwise(usual).alias("expected_demand"),
        F.when(quality == "GOOD", F.lit("FORECAST")).otherwise(F.lit("FALLBACK_56D")).alias("demand_source"),
        fcst.alias("expected_demand_forecast"), usual.alias("expected_demand_fallback"))
    need = F.col("expected_demand") - F.col("current_stock")
    packs = F.ceil(need / F.col("pack_size")) * F.col("pack_size")
    reorder = F.when(need <= 0, F.lit(0).cast("bigint")).otherwise(F.greatest(F.col("moq"), packs.cast("bigint")))
    day = newest_snapshot(snapshots, p, p.snapshot_lookback_days, latest)
    out = calc.select(
        "vendor_name", "variant_id", "sku", "product_title", "variant_title", "current_stock", "raw_stock",
        "negative_stock_flag", "lead_time_days", "moq", "pack_size", "horizon_days", "model_quality",
        "expected_demand", "demand_source", reorder.alias("reorder_qty"), "expected_demand_forecast",
        "expected_demand_fallback", day.alias("snapshot_date"), ts_lit(p.run_ts).alias("created_at"))
    return (out.filter(F.col("reorder_qty") > 0)
            .orderBy(F.col("negative_stock_flag").desc(), F.col("reorder_qty").desc(), "vendor_name", "variant_id"))
