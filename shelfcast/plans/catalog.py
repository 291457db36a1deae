"""Registered queries: one Spark callable and one independent SQL oracle per operator.

Spark side: library functions over the fixture tables (``shelfcast.sources.testdata``).
Oracle side: hand-written DuckDB SQL over the driver's raw tables, starting
from the same FIXTURES.md mapping (``oracle_fixture``). Column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit
from shelfcast.operators import demand, inventory, vendors, views
from shelfcast.plans.oracle_fixture import d, ts, with_fixture
from shelfcast.session import apply_runtime_conf
from shelfcast.sources.testdata import FIXTURE_PARAMS as P
from shelfcast.sources.testdata import Fixture, StoredFixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


STORE_DIRS: dict[tuple[str, str], str] = {}


def fx(spark: SparkSession, sf_dir: str, grain: str = "bt") -> Fixture:
    """Fixture over the raw tables, or over a landed store when one was registered (bench)."""
    apply_runtime_conf(spark)   # UTC session time zone, ANSI, AQE
    store_dir = STORE_DIRS.get((sf_dir.rstrip("/"), grain))
    if store_dir:
        return StoredFixture(spark, sf_dir, store_dir, grain, P)
    return Fixture(spark, sf_dir, grain, P)


INTERNAL = ", ".join(f"'{v}'" for v in P.internal_vendors)
AS_OF, RUN_TS = d(P.as_of), ts(P.run_ts)

# ------------------------------------------------------------------ shared oracle CTEs
CI_CTE = f"""ci AS (
  SELECT snapshot_date, variant_id, sku, raw_stock,
         CASE WHEN raw_stock IS NULL THEN NULL WHEN raw_stock > 0 THEN raw_stock ELSE 0 END AS current_stock,
         raw_stock < 0 AS negative_stock_flag
  FROM (SELECT snapshot_date, variant_id, min(NULLIF(sku, '')) AS sku, CAST(sum(available_qty) AS BIGINT) AS raw_stock
        FROM inventory
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM inventory WHERE snapshot_date IS NOT NULL)
        GROUP BY snapshot_date, variant_id))"""

SALES_DAILY_CTE = f"""sales_daily AS (
  SELECT s.sale_date, s.variant_id, min(NULLIF(s.sku, '')) AS sku, CAST(sum(s.quantity_sold) AS BIGINT) AS qty_sold,
         CAST(sum(CAST(s.quantity_sold AS DECIMAL(19,0)) * COALESCE(TRY_CAST(v.price AS DECIMAL(18,9)), 0)) AS DECIMAL(38,9)) AS gross_revenue
  FROM sales s LEFT JOIN variants v ON v.variant_id = s.variant_id
  WHERE s.sale_date >= {AS_OF} - INTERVAL 365 DAY AND s.variant_id IS NOT NULL
  GROUP BY s.sale_date, s.variant_id)"""

# Vendor tables from the union of stored and listed names; a new vendor's id is the
# largest stored id plus its place among the names without one.
VENDORS_CTE = """vendors_m AS (
  SELECT CASE WHEN e.vendor_id IS NOT NULL THEN e.vendor_id
              ELSE coalesce(max(e.vendor_id) OVER (), 0)
                   + count(*) FILTER (WHERE e.vendor_id IS NULL) OVER (ORDER BY names.vendor_name) END::BIGINT AS vendor_id,
         names.vendor_name, ifnull(e.lead_time_days, 5)::BIGINT AS lead_time_days, ifnull(e.moq, 6)::BIGINT AS moq,
         ifnull(e.pack_size, 6)::BIGINT AS pack_size
  FROM (SELECT vendor_name FROM vendors_existing UNION SELECT vendor FROM variants_k WHERE vendor > '') names(vendor_name)
  LEFT JOIN vendors_existing e USING (vendor_name))"""

STATUS_CTE = """vendor_status_m AS (
  SELECT * FROM vendor_status_existing
  UNION ALL BY NAME
  SELECT vendor_name, FALSE AS archived FROM vendors_m ANTI JOIN vendor_status_existing USING (vendor_name))"""

# Vendors to forecast and re-order, and the lines of the variants they list.
ACTIVE_CTE = f"""open_vendors AS (
  SELECT vendor_name FROM vendor_status_m WHERE archived IS DISTINCT FROM TRUE
  EXCEPT SELECT unnest([{INTERNAL}]))"""

VVM_CTE = """vvm AS (
  SELECT variant_id, sku, vendor AS vendor_name FROM variants_k
  WHERE variant_id > '' AND vendor IN (FROM open_vendors))"""

SALES_DAILY_V_CTE = f"""sales_daily_v AS (
  SELECT sale_date, variant_id, min(sku) AS sku, CAST(sum(quantity_sold) AS BIGINT) AS qty_sold
  FROM sales
  WHERE sale_date BETWEEN {AS_OF} - INTERVAL 365 DAY AND {AS_OF} AND variant_id > ''
  GROUP BY ALL)"""

# A sale counts for the Monday on or before it; a day holds a variant once per line of the map.
SALES_WEEKLY_CTE = """sales_weekly AS (
  SELECT sale_date - (isodow(sale_date) - 1)::INTEGER AS week_start, variant_id, min(s.sku) AS sku,
         sum(qty_sold)::BIGINT AS qty_sold
  FROM sales_daily_v s JOIN vvm USING (variant_id) GROUP BY ALL)"""

VVM_VIEW_CTE = """vvm_view AS (
  SELECT variant_id, nullif(sku, '') AS sku, vendor AS vendor_name, 'Product ' || variant_id AS product_title,
         title AS variant_title
  FROM variants_k WHERE vendor > '')"""

CI_ACTIVE_CTE = """ci_active AS (
  SELECT snapshot_date, variant_id, m.sku, vendor_name, product_title, variant_title, raw_stock, current_stock, negative_stock_flag
  FROM vvm_view m JOIN ci USING (variant_id)
  SEMI JOIN (SELECT vendor_name FROM vendor_status_m WHERE archived IS DISTINCT FROM TRUE) USING (vendor_name))"""

# Revenue from one price total per (sku, vendor); a rank counts the distinct larger revenues.
RANK_CTE = f"""price_lists AS (
  SELECT vendor AS vendor_name, sku, count(*) AS listed, sum(price::DECIMAL(18,9)) AS price_total
  FROM variants_k WHERE sku > '' AND vendor > '' GROUP BY ALL),
half_year AS (
  SELECT sku, sum(quantity_sold) AS units FROM sales
  WHERE sku > '' AND sale_date BETWEEN {AS_OF} - INTERVAL 6 MONTH AND {AS_OF} GROUP BY ALL),
vendor_totals AS (
  SELECT vendor_name, sum(units * listed)::BIGINT AS units_6m,
         sum(units::DECIMAL(19,0) * price_total::DECIMAL(18,9))::DOUBLE AS revenue_6m
  FROM price_lists NATURAL JOIN half_year GROUP BY ALL),
vendor_rank AS (
  SELECT vendor_name, units_6m AS vendor_units_sold_6m, revenue_6m AS vendor_revenue_6m,
         (1 + len(list_filter((SELECT list(DISTINCT revenue_6m) FROM vendor_totals), lambda r: r > revenue_6m)))::INTEGER AS revenue_rank,
         {AS_OF} AS frozen_as_of_date
  FROM vendor_totals)"""
CONFIG = [VENDORS_CTE, STATUS_CTE]


def vendor_status(f: Fixture) -> DataFrame:
    """The maintained status: every stored or listed vendor has a row."""
    return vendors.maintain_vendor_status(f.vendor_status_existing, vendors.vendor_names(f.products, f.vendors_existing))


def vendor_map(f: Fixture) -> DataFrame:
    return vendors.variant_vendor_map(f.variants, f.products, vendors.active_vendors(vendor_status(f), P))


# ------------------------------------------------------------------ C10, C21, C22 demand
@register("c10_sales_daily", with_fixture([SALES_DAILY_CTE], "SELECT * FROM sales_daily"))
def q_sales_daily(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return demand.sales_daily(f.sales_table(), f.variants, P)


@register("c21_sales_daily_validation", with_fixture([SALES_DAILY_V_CTE], "SELECT * FROM sales_daily_v"))
def q_sales_daily_validation(spark, sf_dir, grain="bt"):
    return demand.sales_daily_validation(fx(spark, sf_dir, grain).sales_table(), P)


@register("c20_variant_vendor_map", with_fixture([*CONFIG, ACTIVE_CTE, VVM_CTE], "SELECT * FROM vvm"))
def q_variant_vendor_map(spark, sf_dir, grain="bt"):
    return vendor_map(fx(spark, sf_dir, grain))


@register("c22_sales_weekly",
          with_fixture([*CONFIG, ACTIVE_CTE, VVM_CTE, SALES_DAILY_V_CTE, SALES_WEEKLY_CTE], "SELECT * FROM sales_weekly"))
def q_sales_weekly(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return demand.sales_weekly(demand.sales_daily_validation(f.sales_table(), P), vendor_map(f), P)


# ------------------------------------------------------------------ C11, C17-C19 inventory
@register("c11_current_inventory", with_fixture([CI_CTE], "SELECT * FROM ci"))
def q_current_inventory(spark, sf_dir, grain="bt"):
    return inventory.current_inventory(fx(spark, sf_dir, grain).inventory, P)


@register("c17_latest_snapshot_count", with_fixture([], f"""
SELECT (SELECT max(snapshot_date) FROM inventory WHERE snapshot_date >= {AS_OF} - INTERVAL 365 DAY) AS latest_snapshot_date,
       count(*) AS rows_on_latest_snapshot
FROM inventory
WHERE snapshot_date = (SELECT max(snapshot_date) FROM inventory WHERE snapshot_date >= {AS_OF} - INTERVAL 365 DAY)"""))
def q_latest_snapshot_count(spark, sf_dir, grain="bt"):
    return inventory.latest_snapshot_count(fx(spark, sf_dir, grain).inventory, P)


STAGED_SALES = f"(SELECT * FROM sales WHERE sale_date >= {AS_OF} - INTERVAL 14 DAY)"


@register("c18a_duplicate_sales", with_fixture([], f"""
SELECT count(*) - count(DISTINCT sale_id) AS dup_sales FROM sales
WHERE sale_date BETWEEN (SELECT min(sale_date) FROM {STAGED_SALES}) AND (SELECT max(sale_date) FROM {STAGED_SALES})"""))
def q_duplicate_sales(spark, sf_dir, grain="bt"):
    s = fx(spark, sf_dir, grain).sales_table()
    staged = s.filter(F.col("sale_date") >= date_lit(P.days_ago(14)))
    return inventory.duplicate_sales(s, staged)


@register("c18b_latest_partitions", with_fixture([], """
SELECT (SELECT max(snapshot_date) FROM inventory) AS latest_snapshot_date,
       (SELECT max(sale_date) FROM sales) AS latest_sale_date"""))
def q_latest_partitions(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return inventory.latest_partitions(f.inventory, f.sales_table())


@register("c18c_sales_daily_freshness", with_fixture([SALES_DAILY_CTE], f"""
SELECT max(sale_date) AS sales_daily_latest FROM sales_daily WHERE sale_date >= {AS_OF} - INTERVAL 7 DAY"""))
def q_sales_daily_freshness(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return inventory.sales_daily_freshness(demand.sales_daily(f.sales_table(), f.variants, P), P)


@register("c18d_inventory_totals", with_fixture([CI_CTE], """
SELECT count(*) AS variant_count, CAST(sum(current_stock) AS BIGINT) AS total_stock FROM ci"""))
def q_inventory_totals(spark, sf_dir, grain="bt"):
    return inventory.inventory_totals(inventory.current_inventory(fx(spark, sf_dir, grain).inventory, P))


@register("c19_negative_stock", with_fixture([], f"""
SELECT i.snapshot_date, k.vendor AS vendor_name, k.variant_id, coalesce(nullif(k.sku, ''), min(nullif(i.sku, ''))) AS sku,
       'Product ' || k.variant_id AS product_title, k.title AS variant_title, sum(i.available_qty)::BIGINT AS raw_stock,
       {RUN_TS} AS created_at
FROM inventory i JOIN variants_k k USING (variant_id)
WHERE k.vendor > '' AND NOT list_contains([{INTERNAL}], k.vendor)
  AND i.snapshot_date = (SELECT max(snapshot_date) FROM inventory WHERE {AS_OF} - snapshot_date BETWEEN 0 AND 30)
GROUP BY i.snapshot_date, k.vendor, k.variant_id, k.sku, k.title
HAVING sum(i.available_qty) < 0"""))
def q_negative_stock(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return inventory.negative_stock(f.inventory, f.variants, f.products, P)


# ------------------------------------------------------------------ C13-C16 vendors
@register("c13_vendor_sales_rank", with_fixture([RANK_CTE], "SELECT * FROM vendor_rank"))
def q_vendor_sales_rank(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return vendors.vendor_sales_rank(f.sales_table(), f.variants, f.products, P)


@register("c14_vendor_cadence", with_fixture([RANK_CTE], """
SELECT vendor_name, revenue_rank, vendor_revenue_6m, vendor_units_sold_6m,
       CASE WHEN revenue_rank <= 8 THEN 7 ELSE 14 END AS restock_frequency_days, frozen_as_of_date
FROM vendor_rank"""))
def q_vendor_cadence(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return vendors.vendor_cadence(vendors.vendor_sales_rank(f.sales_table(), f.variants, f.products, P), P)


@register("c15_maintain_vendors", with_fixture([VENDORS_CTE], "SELECT * FROM vendors_m"))
def q_maintain_vendors(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return vendors.maintain_vendors(f.products, f.vendors_existing, P)


@register("c16_maintain_vendor_status", with_fixture(CONFIG, "SELECT * FROM vendor_status_m"))
def q_maintain_vendor_status(spark, sf_dir, grain="bt"):
    return vendor_status(fx(spark, sf_dir, grain))


@register("c16b_archive_vendor", with_fixture(CONFIG, f"""
SELECT vendor_name, vendor_name = 'Brand#3' OR archived AS archived,
       if(vendor_name = 'Brand#3', {RUN_TS}, archived_at) AS archived_at,
       if(vendor_name = 'Brand#3', 'Stop reordering from this vendor', note) AS note
FROM vendor_status_m"""))
def q_archive_vendor(spark, sf_dir, grain="bt"):
    return vendors.archive_vendor(vendor_status(fx(spark, sf_dir, grain)), "Brand#3", P.run_ts)


@register("c16c_unarchive_vendor", with_fixture(CONFIG, """
SELECT vendor_name, vendor_name <> 'Brand#11' AND archived AS archived,
       if(vendor_name = 'Brand#11', NULL, archived_at) AS archived_at, note
FROM vendor_status_m"""))
def q_unarchive_vendor(spark, sf_dir, grain="bt"):
    return vendors.unarchive_vendor(vendor_status(fx(spark, sf_dir, grain)), "Brand#11")


# ------------------------------------------------------------------ C34-C39 views
@register("c34_v_active_vendors", with_fixture(CONFIG, """
SELECT vendor_name FROM vendor_status_m WHERE archived IS DISTINCT FROM TRUE"""))
def q_v_active_vendors(spark, sf_dir, grain="bt"):
    return views.v_active_vendors(vendor_status(fx(spark, sf_dir, grain)), P)


@register("c35_v_variant_vendor_map", with_fixture([VVM_VIEW_CTE], "SELECT * FROM vvm_view"))
def q_v_variant_vendor_map(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return views.v_variant_vendor_map(f.variants, f.products)


def _ci_active(f: Fixture) -> DataFrame:
    ci = inventory.current_inventory(f.inventory, P)
    return views.v_current_inventory_active(ci, views.v_variant_vendor_map(f.variants, f.products),
                                            vendor_status(f), P)


@register("c36_v_current_inventory_active", with_fixture([*CONFIG, CI_CTE, VVM_VIEW_CTE, CI_ACTIVE_CTE], "SELECT * FROM ci_active"))
def q_v_current_inventory_active(spark, sf_dir, grain="bt"):
    return _ci_active(fx(spark, sf_dir, grain))


@register("c38_v_vendor_summary", with_fixture([*CONFIG, CI_CTE, VVM_VIEW_CTE, CI_ACTIVE_CTE], """
SELECT vendor_name, count(DISTINCT variant_id) AS active_variant_count,
       CAST(sum(current_stock) AS BIGINT) AS total_current_stock,
       CAST(sum(CASE WHEN negative_stock_flag THEN 1 ELSE 0 END) AS BIGINT) AS negative_variants
FROM ci_active GROUP BY vendor_name"""))
def q_v_vendor_summary(spark, sf_dir, grain="bt"):
    return views.v_vendor_summary(_ci_active(fx(spark, sf_dir, grain)))


@register("c39_v_inventory_exceptions", with_fixture([CI_CTE, VVM_VIEW_CTE], """
SELECT ci.snapshot_date, ci.variant_id, m.sku, ci.raw_stock, ci.current_stock, ci.negative_stock_flag, m.vendor_name,
       CASE WHEN m.vendor_name IS NULL THEN 'MISSING_VENDOR_MAPPING'
            WHEN ci.negative_stock_flag THEN 'NEGATIVE_STOCK' ELSE 'OK' END AS exception_type
FROM ci LEFT JOIN vvm_view m ON m.variant_id = ci.variant_id
WHERE ci.negative_stock_flag = TRUE OR m.vendor_name IS NULL"""))
def q_v_inventory_exceptions(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return views.v_inventory_exceptions(inventory.current_inventory(f.inventory, P),
                                        views.v_variant_vendor_map(f.variants, f.products))
