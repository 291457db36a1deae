"""Current stock and data-readiness checks (C11, C17, C18a-d, C19).

The latest snapshot date is a scalar subquery, so on a date-partitioned
snapshot table it shows up as ``PartitionFilters: [snapshot_date = scalar-subquery]``
and only the newest partition is scanned (the join form in the warehouse view
would not prune).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.semantics import any_label, date_lit, null_greatest, ts_lit
from shelfcast.params import DEFAULT_PARAMS, Params
from shelfcast.sources.store import batch_range, latest_partition


def latest_date(df: DataFrame, column: str, since: dt.date | None = None, until: dt.date | None = None) -> Column:
    """``MAX(column)`` within ``[since, until]`` (either may be open) as a scalar-subquery Column.

    On a stored fact, take the date from ``store.latest_partition`` instead and
    pass it as ``latest``: a directory listing, where this reads every file.
    """
    c = F.col(column)
    src = df.filter(c.isNotNull())
    if since is not None:
        src = src.filter(c >= date_lit(since))
    if until is not None:
        src = src.filter(c <= date_lit(until))
    return src.select(F.max(c)).scalar()


def newest_snapshot(df: DataFrame, p: Params, days: int | None, latest: dt.date | None) -> Column:
    """The newest snapshot date: the literal of a known partition, or the subquery up to ``as_of``."""
    if latest is not None:
        if latest > p.as_of or (days is not None and latest < p.days_ago(days)):
            return F.lit(None).cast("date")
        return date_lit(latest)
    return latest_date(df, "snapshot_date", None if days is None else p.days_ago(days), p.as_of)


def current_inventory(snapshots: DataFrame, p: Params = DEFAULT_PARAMS, days: int | None = None,
                      drop_blank_variants: bool = False, latest: dt.date | None = None) -> DataFrame:
    """Stock per variant on the newest snapshot date, summed over locations.

    ``days=None`` looks at every date up to ``as_of`` (the catalog view); the
    restock job looks back 30 days with ``drop_blank_variants=True`` (SURVEY
    Q10/Q11). ``latest`` is the date if it is known from partition metadata.
    ``current_stock`` is ``GREATEST(raw_stock, 0)`` with NULL kept NULL.
    """
    inv = snapshots.filter(F.col("snapshot_date") == newest_snapshot(snapshots, p, days, latest))
    if drop_blank_variants:
        inv = inv.filter(F.col("variant_id").isNotNull() & (F.col("variant_id") != ""))
    agg = inv.groupBy("snapshot_date", "variant_id").agg(
        any_label("sku").alias("sku"), F.sum("available_qty").alias("raw_stock"))
    return agg.select(
        "snapshot_date", "variant_id", "sku", "raw_stock",
        null_greatest("raw_stock").alias("current_stock"),
        (F.col("raw_stock") < 0).alias("negative_stock_flag"))


def restock_stock(current: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """The restock job's stock from `current_inventory` over all dates: newest snapshot within the lookback, no blank variants."""
    v = F.col("variant_id")
    return current.filter((F.col("snapshot_date") >= date_lit(p.days_ago(p.snapshot_lookback_days))) & v.isNotNull() & (v != ""))


def latest_snapshot_count(snapshots: DataFrame, p: Params = DEFAULT_PARAMS, latest: dt.date | None = None) -> DataFrame:
    """C17: newest snapshot date within the lookback, and its row count."""
    day = newest_snapshot(snapshots, p, p.readiness_lookback_days, latest)
    return (snapshots.filter(F.col("snapshot_date") == day)
            .agg(F.count(F.lit(1)).alias("rows_on_latest_snapshot"))
            .select(day.alias("latest_snapshot_date"), "rows_on_latest_snapshot"))


def duplicate_sales(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """``COUNT(*) - COUNT(DISTINCT sale_id)`` of the history inside the staged date range."""
    lo, hi = batch_range(staged, "sale_date")
    return (raw.filter(F.col("sale_date").between(lo, hi))
            .agg((F.count(F.lit(1)) - F.count_distinct("sale_id")).alias("dup_sales")))


def latest_partitions(snapshots: DataFrame, sales: DataFrame) -> DataFrame:
    """Newest inventory and sales dates (one row)."""
    return (snapshots.agg(F.max("snapshot_date").alias("latest_snapshot_date"))
            .select("latest_snapshot_date", sales.select(F.max("sale_date")).scalar().alias("latest_sale_date")))


def latest_stored_partitions(spark: SparkSession, snapshots_path: str, sales_path: str) -> DataFrame:
    """C18b on stored facts: the same row from the directory listings, without reading a file."""
    days = (latest_partition(spark, snapshots_path, "snapshot_date"), latest_partition(spark, sales_path, "sale_date"))
    return spark.createDataFrame([days], "latest_snapshot_date date, latest_sale_date date")


def sales_daily_freshness(sales_daily: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Newest ``sale_date`` of the daily rollup within the last week."""
    return (sales_daily.filter(F.col("sale_date").between(date_lit(p.days_ago(p.freshness_lookback_days)),
                                                          date_lit(p.as_of)))
            .agg(F.max("sale_date").alias("sales_daily_latest")))


def inventory_totals(current: DataFrame) -> DataFrame:
    """C18d: variant count and total stock of ``current_inventory``."""
    return current.agg(F.count(F.lit(1)).alias("variant_count"), F.sum("current_stock").alias("total_stock"))


def negative_stock(snapshots: DataFrame, variants: DataFrame, products: DataFrame,
                   p: Params = DEFAULT_PARAMS, latest: dt.date | None = None) -> DataFrame:
    """Variants whose summed stock on the latest snapshot (≤30 days old) is negative."""
    day = newest_snapshot(snapshots, p, p.snapshot_lookback_days, latest)
    vendor = F.col("p.vendor")
    vv = (variants.alias("v").join(products.alias("p"), F.col("v.product_id") == F.col("p.product_id"))
          .filter(F.col("v.variant_id").isNotNull() & vendor.isNotNull() & (vendor != "")
                  & ~vendor.isin(list(p.internal_vendors)))
          .groupBy(F.col("v.variant_id").alias("variant_id"), vendor.alias("vendor_name"),
                   F.col("p.title").alias("product_title"), F.col("v.title").alias("variant_title"))
          .agg(any_label("v.sku").alias("vv_sku")))
    neg = (snapshots.filter((F.col("snapshot_date") == day) & F.col("variant_id").isNotNull())
           .groupBy("variant_id")
           .agg(any_label("sku").alias("n_sku"), F.sum("available_qty").alias("raw_stock"))
           .filter(F.col("raw_stock") < 0))
    return (neg.join(vv, "variant_id")
            .select(day.alias("snapshot_date"), "vendor_name", "variant_id",
                    F.coalesce("vv_sku", "n_sku").alias("sku"), "product_title", "variant_title",
                    "raw_stock", ts_lit(p.run_ts).alias("created_at"))
            .orderBy("vendor_name", "raw_stock"))
