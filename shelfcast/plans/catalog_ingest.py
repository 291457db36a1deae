"""Registered ingest and store queries: JSON flattening (C01-C04), refresh (C05), upsert (C07/C08), retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit
from shelfcast.plans.catalog import AS_OF, P, fx, register
from shelfcast.plans.oracle_fixture import with_fixture
from shelfcast.sources import landing, store
from shelfcast.sources import testdata_pages as pages
from shelfcast.sources.testdata import Fixture

SINCE = dt.datetime.combine(P.days_ago(P.sales_lookback_days), dt.time())
SALES_ORDER = ["order_id", "order_name", "variant_id", "sku", "product_title", "quantity_sold", "sale_date",
               "sale_timestamp", "vendor"]
SALES_COLS = "sale_id, order_id, order_name, variant_id, sku, product_title, quantity_sold, sale_date, sale_timestamp, vendor, line_price"
INV_COLS = ("snapshot_id, variant_id, sku, location_id, available_qty, incoming_qty, committed_qty, snapshot_date, "
            "snapshot_timestamp")


def _parsed(f: Fixture, builder, schema) -> DataFrame:
    return landing.parse_pages(builder(f), "json", schema)


# ------------------------------------------------------------------ C01-C04 flatten landed pages
@register("c01a_flatten_products", with_fixture([], "SELECT * FROM products"))
def q_flatten_products(spark, sf_dir, grain="bt"):
    return landing.flatten_products(_parsed(fx(spark, sf_dir, grain), pages.product_pages, landing.PRODUCTS_PAGE))[0]


@register("c01b_flatten_variants", with_fixture([], "SELECT * FROM variants"))
def q_flatten_variants(spark, sf_dir, grain="bt"):
    return landing.flatten_products(_parsed(fx(spark, sf_dir, grain), pages.product_pages, landing.PRODUCTS_PAGE))[1]


@register("c02_flatten_locations", with_fixture([], "SELECT * FROM locations"))
def q_flatten_locations(spark, sf_dir, grain="bt"):
    return landing.flatten_locations(_parsed(fx(spark, sf_dir, grain), pages.location_pages, landing.LOCATIONS_PAGE))


@register("c03_flatten_inventory", with_fixture([], """
SELECT * FROM inventory WHERE location_id IN (SELECT location_id FROM locations WHERE active)"""))
def q_flatten_inventory(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    _, variants = landing.flatten_products(_parsed(f, pages.product_pages, landing.PRODUCTS_PAGE), with_position=True)
    locs = landing.flatten_locations(_parsed(f, pages.location_pages, landing.LOCATIONS_PAGE))
    return landing.flatten_inventory(_parsed(f, pages.inventory_pages, landing.INVENTORY_PAGE), variants, locs)


@register("c04_flatten_sales", with_fixture([], f"""
SELECT sale_id, order_id, order_name, variant_id, sku, product_title, quantity_sold, sale_date,
       CAST(sale_date AS TIMESTAMP) + INTERVAL 25 HOUR AS sale_timestamp, vendor, line_price
FROM sales_fx s JOIN order_flags o ON s.order_id = CAST(o.o_orderkey AS VARCHAR)
WHERE NOT o.test AND NOT o.cancelled
  AND CAST(sale_date AS TIMESTAMP) + INTERVAL 25 HOUR >= TIMESTAMP '{SINCE:%Y-%m-%d %H:%M:%S}'"""))
def q_flatten_sales(spark, sf_dir, grain="bt"):
    return landing.flatten_sales(_parsed(fx(spark, sf_dir, grain), pages.order_pages, landing.ORDERS_PAGE), SINCE)


# ------------------------------------------------------------------ C05 dimension refresh
@register("c05_refresh_dimension", with_fixture([], "SELECT * FROM variants"))
def q_refresh_dimension(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    empty = f.variants.filter(F.lit(False))          # an empty load
    stale = f.variants.withColumn("title", F.lit("stale"))
    # an empty load keeps the stored rows; a non-empty load replaces them
    kept = store.refresh_dimension(f.variants, empty)
    return store.refresh_dimension(stale, kept)


# ------------------------------------------------------------------ C07 / C08 upsert
def _dedupe_sql(src: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM {src}) WHERE rn = 1")


def sales_batches(f: Fixture) -> tuple[DataFrame, DataFrame]:
    """Upsert fixture: stored = sales before as_of-7, staged = last 14 days with corrected quantities."""
    s = f.sales
    tgt = store.dedupe(s.filter(F.col("sale_date") < date_lit(P.days_ago(7))).drop("l_linenumber"),
                       "sale_id", SALES_ORDER)
    src = s.filter(F.col("sale_date") >= date_lit(P.days_ago(14))).withColumn(
        "quantity_sold", F.when(F.col("l_linenumber") == 1, F.col("quantity_sold") + 1).otherwise(F.col("quantity_sold")))
    return tgt, store.dedupe(src.drop("l_linenumber"), "sale_id", SALES_ORDER)


SALES_UPSERT_SQL = with_fixture([
    f"tgt AS ({_dedupe_sql(f'(SELECT {SALES_COLS} FROM sales_fx WHERE sale_date < {AS_OF} - INTERVAL 7 DAY)', 'sale_id', ', '.join(SALES_ORDER))})",
    f"""src AS ({_dedupe_sql(f'''(SELECT sale_id, order_id, order_name, variant_id, sku, product_title,
        CASE WHEN l_linenumber = 1 THEN quantity_sold + 1 ELSE quantity_sold END AS quantity_sold,
        sale_date, sale_timestamp, vendor, line_price FROM sales_fx WHERE sale_date >= {AS_OF} - INTERVAL 14 DAY)''',
                             'sale_id', ', '.join(SALES_ORDER))})""",
    "rng AS (SELECT min(sale_date) AS lo, max(sale_date) AS hi FROM src)",
], f"""
SELECT * FROM tgt WHERE NOT (sale_date BETWEEN (SELECT lo FROM rng) AND (SELECT hi FROM rng))
UNION ALL
SELECT COALESCE(s.sale_id, t.sale_id) AS sale_id,
       CASE WHEN s.sale_id IS NOT NULL THEN s.order_id ELSE t.order_id END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.order_name ELSE t.order_name END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.variant_id ELSE t.variant_id END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.sku ELSE t.sku END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.product_title ELSE t.product_title END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.quantity_sold ELSE t.quantity_sold END,
       CASE WHEN t.sale_id IS NOT NULL THEN t.sale_date ELSE s.sale_date END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.sale_timestamp ELSE t.sale_timestamp END,
       CASE WHEN s.sale_id IS NOT NULL THEN s.vendor ELSE t.vendor END,
       CASE WHEN t.sale_id IS NOT NULL THEN t.line_price ELSE s.line_price END
FROM (SELECT * FROM tgt WHERE sale_date BETWEEN (SELECT lo FROM rng) AND (SELECT hi FROM rng)) t
FULL OUTER JOIN src s ON t.sale_id = s.sale_id""")


@register("c08_upsert_sales", SALES_UPSERT_SQL)
def q_upsert_sales(spark, sf_dir, grain="bt"):
    tgt, src = sales_batches(fx(spark, sf_dir, grain))
    return store.upsert_sales(tgt, src)


def inventory_batches(f: Fixture) -> tuple[DataFrame, DataFrame]:
    """Stored = snapshots up to as_of-8; staged = as_of-8 corrected (+1 available) and as_of-1 new."""
    inv, d8 = f.inventory, date_lit(P.days_ago(8))
    tgt = inv.filter(F.col("snapshot_date") <= d8)
    src = inv.filter(F.col("snapshot_date") >= d8).withColumn(
        "available_qty", F.when(F.col("snapshot_date") == d8, F.col("available_qty") + 1).otherwise(F.col("available_qty")))
    return tgt, src


@register("c07_upsert_inventory", with_fixture([
    f"tgt AS (SELECT * FROM inventory WHERE snapshot_date <= {AS_OF} - INTERVAL 8 DAY)",
    f"""src AS (SELECT snapshot_id, variant_id, sku, location_id,
       CASE WHEN snapshot_date = {AS_OF} - INTERVAL 8 DAY THEN available_qty + 1 ELSE available_qty END AS available_qty,
       incoming_qty, committed_qty, snapshot_date, snapshot_timestamp
  FROM inventory WHERE snapshot_date >= {AS_OF} - INTERVAL 8 DAY)""",
    "rng AS (SELECT min(snapshot_date) AS lo, max(snapshot_date) AS hi FROM src)",
], f"""
SELECT * FROM tgt WHERE NOT (snapshot_date BETWEEN (SELECT lo FROM rng) AND (SELECT hi FROM rng))
UNION ALL
SELECT COALESCE(s.snapshot_id, t.snapshot_id) AS snapshot_id,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.variant_id ELSE t.variant_id END,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.sku ELSE t.sku END,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.location_id ELSE t.location_id END,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.available_qty ELSE t.available_qty END,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.incoming_qty ELSE t.incoming_qty END,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.committed_qty ELSE t.committed_qty END,
       CASE WHEN t.snapshot_id IS NOT NULL THEN t.snapshot_date ELSE s.snapshot_date END,
       CASE WHEN s.snapshot_id IS NOT NULL THEN s.snapshot_timestamp ELSE t.snapshot_timestamp END
FROM (SELECT * FROM tgt WHERE snapshot_date BETWEEN (SELECT lo FROM rng) AND (SELECT hi FROM rng)) t
FULL OUTER JOIN src s ON t.snapshot_id = s.snapshot_id"""))
def q_upsert_inventory(spark, sf_dir, grain="bt"):
    tgt, src = inventory_batches(fx(spark, sf_dir, grain))
    return store.upsert_inventory(tgt, src)


# ------------------------------------------------------------------ C12 retention
@register("c12_retained_sales", with_fixture([], f"""
SELECT * FROM sales WHERE sale_date >= {AS_OF} - INTERVAL 365 DAY"""))
def q_retained_sales(spark, sf_dir, grain="bt"):
    return store.retained(fx(spark, sf_dir, grain).sales_table(), "sale_date", P.as_of, P.retention_days)
