"""Vendor configuration.

Every relation here is keyed by vendor, i.e. already aggregated. Global ranks
and row numbers are bucketed (``functions.ranking``), so no task orders all vendors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.ranking import with_dense_rank_desc, with_row_number
from shelfcast.functions.semantics import date_lit, ts_lit
from shelfcast.params import DEFAULT_PARAMS, Params


def _present(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def vendor_sales(sales: DataFrame, variants: DataFrame, products: DataFrame,
                 p: Params = DEFAULT_PARAMS, key: str = "sku") -> DataFrame:
    """Units and revenue per vendor over the last ``vendor_rank_months``.

    ``key='sku'`` reproduces the reference join on the non-unique sku label
    (a shared sku credits its sales to every vendor using it, SURVEY Q5);
    ``key='variant_id'`` joins on the canonical key instead.
    """
    dec = "decimal(18,9)"
    # (sku, vendor) pairs with their row count and exact price sum: the same totals
    # as joining every variant row, but a sku shared by millions of variants is
    # one row per vendor on the join instead of millions.
    svp = (variants.alias("v").join(products.alias("p"), F.col("v.product_id") == F.col("p.product_id"))
           .filter(_present(f"v.{key}") & _present("p.vendor"))
           .groupBy(F.col(f"v.{key}").alias(key), F.col("p.vendor").alias("vendor_name"))
           .agg(F.count(F.lit(1)).alias("rows"),
                F.sum(F.coalesce(F.col("v.price").try_cast("double").cast(dec), F.lit(0).cast(dec))).cast(dec)
                .alias("price_sum")))
    sold = (sales.filter(F.col("sale_date").between(date_lit(p.months_ago(p.vendor_rank_months)), date_lit(p.as_of))
                         & _present(key))
            .groupBy(key).agg(F.sum("quantity_sold").alias("units_sold_6m")))
    return (sold.join(svp, key).groupBy("vendor_name")
            .agg(F.sum(F.col("units_sold_6m") * F.col("rows")).alias("vendor_units_sold_6m"),
                 # summed exactly in decimal, reported as double: no summation-order noise
                 F.sum(F.col("units_sold_6m").cast("decimal(19,0)") * F.col("price_sum"))
                 .cast("double").alias("vendor_revenue_6m")))


def rank_vendors(by_vendor: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """`vendor_sales` with its dense revenue rank. The input is read three times: keep it first if it is costly."""
    return with_dense_rank_desc(by_vendor, "vendor_revenue_6m", "revenue_rank").select(
        "vendor_name", "vendor_units_sold_6m", "vendor_revenue_6m", "revenue_rank",
        date_lit(p.as_of).alias("frozen_as_of_date"))


def vendor_sales_rank(sales: DataFrame, variants: DataFrame, products: DataFrame,
                      p: Params = DEFAULT_PARAMS, key: str = "sku") -> DataFrame:
    """`vendor_sales`, dense-ranked by revenue."""
    return rank_vendors(vendor_sales(sales, variants, products, p, key), p)


def vendor_cadence(rank: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """C14: top-N vendors by revenue restock weekly, the rest bi-weekly (ties may exceed N)."""
    days = F.when(F.col("revenue_rank") <= p.fast_cadence_top_n, F.lit(p.fast_cadence_days)) \
        .otherwise(F.lit(p.slow_cadence_days))
    return rank.select("vendor_name", "revenue_rank", "vendor_revenue_6m", "vendor_units_sold_6m",
                       days.alias("restock_frequency_days"), "frozen_as_of_date")


def maintain_vendors(products: DataFrame, existing: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Default-fill existing vendors, append new product vendors with ids after max(vendor_id)."""
    all_vendors = products.filter(_present("vendor")).select(F.col("vendor").alias("vendor_name")).distinct()
    new = all_vendors.join(existing.select("vendor_name"), "vendor_name", "left_anti")
    max_id = F.coalesce(existing.select(F.max("vendor_id")).scalar(), F.lit(0).cast("bigint"))
    new_ids = with_row_number(new, "vendor_name", "_i").select(
        (max_id + F.col("_i")).cast("bigint").alias("vendor_id"),
        "vendor_name",
        F.lit(p.default_lead_time_days).cast("bigint").alias("lead_time_days"),
        F.lit(p.default_moq).cast("bigint").alias("moq"),
        F.lit(p.default_pack_size).cast("bigint").alias("pack_size"))
    return vendor_defaults(existing, p).select("vendor_id", "vendor_name", "lead_time_days", "moq", "pack_size") \
        .unionByName(new_ids)


def vendor_names(products: DataFrame, existing: DataFrame) -> DataFrame:
    """The names `maintain_vendors` ends up with, without numbering the new ones."""
    listed = products.filter(_present("vendor")).select(F.col("vendor").alias("vendor_name"))
    return existing.select("vendor_name").unionByName(listed).distinct()


def vendor_defaults(vendors: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    return vendors.select(
        *[c for c in vendors.columns if c not in ("lead_time_days", "moq", "pack_size")],
        F.coalesce("lead_time_days", F.lit(p.default_lead_time_days).cast("bigint")).alias("lead_time_days"),
        F.coalesce("moq", F.lit(p.default_moq).cast("bigint")).alias("moq"),
        F.coalesce("pack_size", F.lit(p.default_pack_size).cast("bigint")).alias("pack_size"))


def maintain_vendor_status(status: DataFrame, vendors: DataFrame) -> DataFrame:
    """Insert-only merge — every vendor gets a status row (not archived)."""
    new = (vendors.select("vendor_name").distinct()
           .join(status.select("vendor_name"), "vendor_name", "left_anti")
           .select("vendor_name", F.lit(False).alias("archived"),
                   F.lit(None).cast("timestamp").alias("archived_at"), F.lit(None).cast("string").alias("note")))
    return status.select("vendor_name", "archived", "archived_at", "note").unionByName(new)


def archive_vendor(status: DataFrame, vendor_name: str, at: dt.datetime,
                   note: str = "Stop reordering from this vendor") -> DataFrame:
    hit = F.col("vendor_name") == vendor_name
    return status.select(
        "vendor_name",
        F.when(hit, F.lit(True)).otherwise(F.col("archived")).alias("archived"),
        F.when(hit, ts_lit(at)).otherwise(F.col("archived_at")).alias("archived_at"),
        F.when(hit, F.lit(note)).otherwise(F.col("note")).alias("note"))


def unarchive_vendor(status: DataFrame, vendor_name: str) -> DataFrame:
    """Clears the flag and timestamp; the note is kept (as in the reference how-to)."""
    hit = F.col("vendor_name") == vendor_name
    return status.select(
        "vendor_name",
        F.when(hit, F.lit(False)).otherwise(F.col("archived")).alias("archived"),
        F.when(hit, F.lit(None).cast("timestamp")).otherwise(F.col("archived_at")).alias("archived_at"),
        "note")


def active_vendors(status: DataFrame, p: Params = DEFAULT_PARAMS, exclude_internal: bool = True) -> DataFrame:
    """Vendors not archived (internal vendors excluded for forecasting/restock only, Q6)."""
    cond = F.coalesce("archived", F.lit(False)) == F.lit(False)
    if exclude_internal:
        cond = cond & ~F.col("vendor_name").isin(list(p.internal_vendors))
    return status.filter(cond).select("vendor_name")


def variant_vendor_map(variants: DataFrame, products: DataFrame, active: DataFrame, titles: bool = False) -> DataFrame:
    """C20: canonical variant -> vendor map restricted to active vendors (``titles``: with both titles)."""
    more = [F.col("p.title").alias("product_title"), F.col("v.title").alias("variant_title")] if titles else []
    return (variants.alias("v").join(products.alias("p"), F.col("v.product_id") == F.col("p.product_id"))
            .join(active.alias("av"), F.col("av.vendor_name") == F.col("p.vendor"))
            .filter(_present("v.variant_id") & _present("p.vendor"))
            .select(F.col("v.variant_id").alias("variant_id"), F.col("v.sku").alias("sku"),
                    F.col("p.vendor").alias("vendor_name"), *more))
