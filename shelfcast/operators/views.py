"""Dashboard-facing views (C34-C39) and model KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.ranking import exact_median
from shelfcast.operators.vendors import active_vendors
from shelfcast.params import DEFAULT_PARAMS, Params


def v_active_vendors(status: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Not-archived vendors (internal vendor *not* excluded)."""
    return active_vendors(status, p, exclude_internal=False)


def v_variant_vendor_map(variants: DataFrame, products: DataFrame) -> DataFrame:
    """Variant attributes with vendor (archived vendors *not* excluded)."""
    return (variants.alias("v").join(products.alias("p"), F.col("v.product_id") == F.col("p.product_id"))
            .filter(F.col("v.variant_id").isNotNull() & F.col("p.vendor").isNotNull() & (F.col("p.vendor") != ""))
            .select(F.col("v.variant_id").alias("variant_id"), F.nullif(F.col("v.sku"), F.lit("")).alias("sku"),
                    F.col("p.vendor").alias("vendor_name"), F.col("p.title").alias("product_title"),
                    F.col("v.title").alias("variant_title")))


def v_current_inventory_active(current: DataFrame, vvm: DataFrame, status: DataFrame,
                               p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Current stock with vendor attributes, active vendors only.

    ``LEFT JOIN ... WHERE right.col IN (...)`` is an inner join; written as one.
    """
    active = v_active_vendors(status, p)
    m = vvm.join(active, "vendor_name", "left_semi")
    return current.alias("ci").join(m.alias("m"), F.col("m.variant_id") == F.col("ci.variant_id")).select(
        "ci.snapshot_date", "ci.variant_id", "m.sku", "m.vendor_name", "m.product_title", "m.variant_title",
        "ci.raw_stock", "ci.current_stock", "ci.negative_stock_flag")


def v_vendor_restocks_weekly_active(restocks: DataFrame, status: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Restock lines of active, non-internal vendors."""
    active = v_active_vendors(status, p)
    return (restocks.join(active, "vendor_name", "inner")
            .filter(~F.col("vendor_name").isin(list(p.internal_vendors)))
            .select(*restocks.columns))


def v_vendor_summary(ci_active: DataFrame) -> DataFrame:
    """Per-vendor counts and stock totals."""
    return ci_active.groupBy("vendor_name").agg(
        F.count_distinct("variant_id").alias("active_variant_count"),
        F.sum("current_stock").alias("total_current_stock"),
        F.sum(F.when(F.col("negative_stock_flag"), 1).otherwise(0)).alias("negative_variants"))


def v_inventory_exceptions(current: DataFrame, vvm: DataFrame) -> DataFrame:
    """Negative stock or missing vendor mapping ('OK' is unreachable, kept as written)."""
    j = current.alias("ci").join(vvm.alias("m"), F.col("m.variant_id") == F.col("ci.variant_id"), "left")
    etype = (F.when(F.col("m.vendor_name").isNull(), F.lit("MISSING_VENDOR_MAPPING"))
             .when(F.col("ci.negative_stock_flag"), F.lit("NEGATIVE_STOCK")).otherwise(F.lit("OK")))
    return (j.filter((F.col("ci.negative_stock_flag") == F.lit(True)) | F.col("m.vendor_name").isNull())
            .select("ci.snapshot_date", "ci.variant_id", "m.sku", "ci.raw_stock", "ci.current_stock",
                    "ci.negative_stock_flag", "m.vendor_name", etype.alias("exception_type")))


# ---------------------------------------------------------------- model KPIs

def scorable(flags: DataFrame) -> DataFrame:
    return flags.filter(F.col("model_quality") != "NO_DATA")


def model_kpis(flags: DataFrame) -> DataFrame:
    """Products evaluated, % GOOD, median WAPE, % worse than baseline (scorable items)."""
    s = scorable(flags)
    n = F.count(F.lit(1))
    share = lambda label: F.round(100.0 * F.count_if(F.col("model_quality") == label) / n, 2)
    counts = s.agg(n.alias("products_evaluated"), F.when(n > 0, share("GOOD")).alias("pct_good"),
                   F.when(n > 0, share("WORSE_THAN_BASELINE")).alias("pct_worse_than_baseline"))
    return counts.select("products_evaluated", "pct_good", exact_median(s, "wape", "median_wape").scalar().alias("median_wape"),
                         "pct_worse_than_baseline")


def quality_distribution(flags: DataFrame) -> DataFrame:
    """Label counts and shares over scorable items."""
    g = scorable(flags).groupBy("model_quality").agg(F.count(F.lit(1)).alias("n_variants"))
    total = F.sum("n_variants").over(Window.partitionBy())
    return g.select("model_quality", "n_variants", F.round(100.0 * F.col("n_variants") / total, 2).alias("pct"))


def wape_scatter(flags: DataFrame) -> DataFrame:
    """Model vs baseline WAPE per scorable item."""
    return scorable(flags).select("variant_id", "wape", "baseline_wape", "model_quality")


def proof_series(proof: DataFrame) -> DataFrame:
    """Actual / predicted / baseline summed by week."""
    return proof.groupBy("week_start").agg(
        F.sum("actual_qty").alias("actual_qty"), F.sum("predicted_qty").alias("predicted_qty"),
        F.sum("baseline_qty").alias("baseline_qty"))


# ---------------------------------------------------------------- the views by name

# Over the catalog tables of one database ({db}); in order, as later ones read earlier ones.
VIEW_SQL = {
    "v_active_vendors": "SELECT vendor_name FROM {db}.vendor_status WHERE NOT coalesce(archived, false)",
    "v_variant_vendor_map": """
        SELECT variant_id, nullif(v.sku, '') AS sku, p.vendor AS vendor_name, p.title AS product_title, v.title AS variant_title
        FROM {db}.variants v JOIN {db}.products p USING (product_id)
        WHERE variant_id IS NOT NULL AND p.vendor > ''""",
    "current_inventory": """
        SELECT snapshot_date, variant_id, min(nullif(sku, '')) AS sku, sum(available_qty) AS raw_stock,
               CASE WHEN sum(available_qty) IS NOT NULL THEN greatest(sum(available_qty), 0) END AS current_stock,
               sum(available_qty) < 0 AS negative_stock_flag
        FROM {db}.inventory_snapshots_raw
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM {db}.inventory_snapshots_raw)
        GROUP BY snapshot_date, variant_id""",
    "v_current_inventory_active": """
        SELECT snapshot_date, variant_id, m.sku, m.vendor_name, m.product_title, m.variant_title, raw_stock, current_stock, negative_stock_flag
        FROM {db}.current_inventory JOIN ({db}.v_variant_vendor_map m LEFT SEMI JOIN {db}.v_active_vendors a ON a.vendor_name = m.vendor_name)
             USING (variant_id)""",
    "v_vendor_summary": """
        SELECT vendor_name, count(DISTINCT variant_id) AS active_variant_count, sum(current_stock) AS total_current_stock,
               count_if(negative_stock_flag) AS negative_variants
        FROM {db}.v_current_inventory_active GROUP BY vendor_name""",
    "v_inventory_exceptions": """
        SELECT snapshot_date, variant_id, m.sku, raw_stock, current_stock, negative_stock_flag, m.vendor_name,
               CASE WHEN m.vendor_name IS NULL THEN 'MISSING_VENDOR_MAPPING' WHEN negative_stock_flag THEN 'NEGATIVE_STOCK' ELSE 'OK' END AS exception_type
        FROM {db}.current_inventory LEFT JOIN {db}.v_variant_vendor_map m USING (variant_id)
        WHERE negative_stock_flag OR m.vendor_name IS NULL""",
}


def create_views(spark: SparkSession, database: str) -> list[str]:
    """Create (or replace) the dashboard views in ``database``, beside its products, variants, vendor_status and snapshots."""
    for name, sql in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql.format(db=database)}")
    return list(VIEW_SQL)
