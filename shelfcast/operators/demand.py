"""Daily and weekly demand rollups.

Facts are aggregated *before* they meet a dimension: the join then sees at
most one row per (date, variant), so a hot variant cannot skew it, and the
dimension side is reduced to one row per key (with its multiplicity, so a
duplicated dimension key still fans out exactly as a plain join would).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.semantics import any_label, date_lit, week_start
from shelfcast.params import DEFAULT_PARAMS, Params

PRICE = "decimal(18,9)"
QTY = "decimal(19,0)"   # holds any bigint; decimal(19,0) x decimal(18,9) = decimal(38,9) exactly


def sales_daily(sales: DataFrame, variants: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Units and revenue proxy (units x current price) per (sale_date, variant_id)."""
    daily = (sales.filter(F.col("sale_date").between(date_lit(p.days_ago(p.sales_lookback_days)), date_lit(p.as_of))
                          & F.col("variant_id").isNotNull())
             .groupBy("sale_date", "variant_id")
             .agg(any_label("sku").alias("sku"), F.sum("quantity_sold").alias("qty")))
    price = (variants.groupBy("variant_id")
             .agg(F.count(F.lit(1)).alias("mult"),
                  F.sum(F.coalesce(F.col("price").try_cast(PRICE), F.lit(0).cast(PRICE))).cast(PRICE)
                  .alias("price_sum")))
    j = daily.join(price, "variant_id", "left")
    return j.select(
        "sale_date", "variant_id", "sku",
        (F.col("qty") * F.coalesce("mult", F.lit(1))).alias("qty_sold"),
        (F.col("qty").cast(QTY) * F.coalesce("price_sum", F.lit(0).cast(PRICE))).cast("decimal(38,9)")
        .alias("gross_revenue"))


def sales_daily_validation(sales: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """The validation script's daily rollup (blank variants dropped, no revenue)."""
    return (sales.filter(F.col("sale_date").between(date_lit(p.days_ago(p.sales_lookback_days)), date_lit(p.as_of))
                         & F.col("variant_id").isNotNull() & (F.col("variant_id") != ""))
            .groupBy("sale_date", "variant_id")
            .agg(F.min("sku").alias("sku"), F.sum("quantity_sold").alias("qty_sold")))


def sales_weekly(daily: DataFrame, variant_map: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Monday-week totals for mapped variants only."""
    mapped = variant_map.groupBy("variant_id").agg(F.count(F.lit(1)).alias("mult"))
    d = daily.filter(F.col("sale_date").between(date_lit(p.days_ago(p.sales_lookback_days)), date_lit(p.as_of)))
    return (d.join(mapped, "variant_id")
            .groupBy(week_start("sale_date").alias("week_start"), "variant_id")
            .agg(F.min("sku").alias("sku"), F.sum(F.col("qty_sold") * F.col("mult")).alias("qty_sold")))
