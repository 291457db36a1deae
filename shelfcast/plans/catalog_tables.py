"""Registered queries over catalog names: committed upserts, moved keys, partition and table metadata, permanent views (§2.2, §2.9)."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit
from shelfcast.operators import incremental, views
from shelfcast.plans.catalog import AS_OF, ORACLE, P, SALES_DAILY_V_CTE, SALES_WEEKLY_CTE, fx, register, vendor_status
from shelfcast.plans.catalog_ingest import SALES_COLS, SALES_ORDER, _dedupe_sql, inventory_batches, sales_batches
from shelfcast.plans.catalog_store import _folder
from shelfcast.plans.oracle_fixture import FixtureSQL, fixture_ctes, with_fixture
from shelfcast.plans.weekly import materialize
from shelfcast.sources import catalog, store
from shelfcast.sources.testdata import Fixture


_DATABASES: list[str] = []


def _database(spark: SparkSession) -> tuple[str, str]:
    """A database of its own for one query, with its folder."""
    folder, name = _folder(spark, "catalog"), f"shelfcast_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    _DATABASES.append(name)
    return name, folder


def drop_databases(spark: SparkSession) -> None:
    while _DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS {_DATABASES.pop()} CASCADE")


def _upserted(f: Fixture, table: str, target: DataFrame, source: DataFrame) -> DataFrame:
    db, folder = _database(f.spark)
    fact, root = f"{db}.{table}", f"{folder}/{table}"
    catalog.create(f.spark, fact, table, root, target)
    catalog.upsert(f.spark, fact, table, root, source)
    return f.spark.table(fact)


@register("t07_upsert_inventory_committed", ORACLE["c07_upsert_inventory"])
def q_upsert_inventory_committed(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return _upserted(f, "inventory_snapshots_raw", *inventory_batches(f))


@register("t08_upsert_sales_committed", ORACLE["c08_upsert_sales"])
def q_upsert_sales_committed(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return _upserted(f, "sales_history_raw", *sales_batches(f))


@register("t12_retention_committed", ORACLE["c12_retained_sales"])
def q_retention_committed(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    db, folder = _database(spark)
    fact, root = f"{db}.sales_history_raw", f"{folder}/sales"
    catalog.create(spark, fact, "sales_history_raw", root, f.sales_table())
    catalog.expire(spark, fact, "sales_history_raw", root, P.as_of, P.retention_days)
    return spark.table(fact)


# ------------------------------------------------------------------ keys stored outside the batch's range
@register("t09_moved_keys", with_fixture([
    f"""staged AS (
  SELECT sale_id, CASE WHEN sale_date < {AS_OF} - 14 THEN {AS_OF} - 2 ELSE sale_date END AS staged_date
  FROM sales_fx WHERE sale_date BETWEEN {AS_OF} - 14 AND {AS_OF} OR (sale_date < {AS_OF} - 14 AND l_linenumber = 2))"""], f"""
SELECT t.sale_id, t.sale_date AS stored_date, s.staged_date
FROM sales_fx t JOIN (SELECT sale_id, max(staged_date) AS staged_date FROM staged GROUP BY sale_id) s USING (sale_id)
WHERE t.sale_date < {AS_OF} - 14 AND t.sale_date NOT BETWEEN (SELECT min(staged_date) FROM staged) AND (SELECT max(staged_date) FROM staged)"""))
def q_moved_keys(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    db, folder = _database(spark)
    fact = f"{db}.sales_history_raw"
    sales = f.sales.filter(F.col("sale_date") < date_lit(P.days_ago(14)))
    catalog.create(spark, fact, "sales_history_raw", f"{folder}/sales", sales.drop("l_linenumber"))
    restated = (sales.filter("l_linenumber = 2").withColumn("sale_date", date_lit(P.days_ago(2)))
                .unionByName(f.sales.filter(F.col("sale_date").between(date_lit(P.days_ago(14)), date_lit(P.as_of)))).drop("l_linenumber"))
    staged = store.stage(restated, f"{folder}/staged", "sales_history_stg")
    return store.moved_keys(spark.table(fact), staged, "sale_id", "sale_date")


# ------------------------------------------------------------------ metadata and views by name
def _facts(f: Fixture, **rows: DataFrame) -> tuple[str, dict[str, str]]:
    db, folder = _database(f.spark)
    for table, df in rows.items():
        catalog.create(f.spark, f"{db}.{table}", table, f"{folder}/{table}", df)
    return db, {table: f"{db}.{table}" for table in rows}


@register("t18_partition_metadata", with_fixture([], """
SELECT DISTINCT 'inventory_snapshots_raw' AS table_name, snapshot_date AS partition_date FROM inventory
UNION ALL SELECT DISTINCT 'sales_history_raw', sale_date FROM sales"""))
def q_partition_metadata(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return catalog.partitions(spark, _facts(f, inventory_snapshots_raw=f.inventory, sales_history_raw=f.sales_table())[1])


def _dashboard(f: Fixture) -> str:
    """A database with the snapshots, the dimensions as tables, and the dashboard views (C34-C36, C38, C39) as permanent views."""
    db, _ = _facts(f, inventory_snapshots_raw=f.inventory)
    folder = f"{_folder(f.spark, 'dimensions')}"
    for name, df in {"products": f.products, "variants": f.variants, "vendor_status": vendor_status(f)}.items():
        df.write.parquet(f"{folder}/{name}")
        catalog.add_table(f.spark, f"{db}.{name}", f"{folder}/{name}")
    views.create_views(f.spark, db)
    return db


VIEW_QUERIES = {"t34_view_active_vendors": ("v_active_vendors", "c34_v_active_vendors"),
                "t35_view_variant_vendor_map": ("v_variant_vendor_map", "c35_v_variant_vendor_map"),
                "t36_view_current_inventory_active": ("v_current_inventory_active", "c36_v_current_inventory_active"),
                "t38_view_vendor_summary": ("v_vendor_summary", "c38_v_vendor_summary"),
                "t39_view_inventory_exceptions": ("v_inventory_exceptions", "c39_v_inventory_exceptions")}


def _view_query(view: str):
    def query(spark, sf_dir, grain="bt"):
        return spark.sql(f"SELECT * FROM {_dashboard(fx(spark, sf_dir, grain))}.{view}")
    return query


for _name, (_view, _oracle) in VIEW_QUERIES.items():
    register(_name, ORACLE[_oracle])(_view_query(_view))


@register("t20_tables", with_fixture([], """
SELECT name AS table_name, name NOT IN ('products', 'variants', 'vendor_status') AS is_view
FROM (SELECT unnest(['products', 'variants', 'vendor_status', 'inventory_snapshots_raw', 'current_inventory',
                     'v_active_vendors', 'v_variant_vendor_map', 'v_current_inventory_active', 'v_vendor_summary',
                     'v_inventory_exceptions']) AS name)
WHERE EXISTS (FROM inventory)"""))
def q_tables(spark, sf_dir, grain="bt"):
    return catalog.tables(spark, _dashboard(fx(spark, sf_dir, grain)))


# ------------------------------------------------------------------ rollups kept up from touched dates
def _kept_up(f: Fixture, weekly: bool) -> DataFrame:
    """Rollups of the history up to three weeks ago, then refreshed after three upserts of a week each."""
    spark, folder = f.spark, _folder(f.spark, "rollups")
    # written once: the first load and each batch would sort the whole history again to have one row a sale
    sales = materialize(store.retained(store.dedupe(f.sales.drop("l_linenumber"), "sale_id", SALES_ORDER), "sale_date", P.days_ago(21),
                                       P.retention_days), "history", folder)
    path, daily, weeks = f"{folder}/sales", f"{folder}/sales_daily", f"{folder}/sales_weekly"
    stored = lambda name, at: spark.read.schema(store.table_schema(name)).parquet(at)
    vmap = views.v_variant_vendor_map(f.variants, f.products)
    for step in (3, 2, 1, 0):
        p = dataclasses.replace(P, as_of=P.days_ago(7 * step))
        if step == 3:
            store.write_fact(sales.filter(F.col("sale_date") <= date_lit(p.as_of)), path, "sales_history_raw")
            dates = None
        else:                                          # the week's sales, and the fortnight before once more
            batch = sales.filter(F.col("sale_date").between(date_lit(p.days_ago(21)), date_lit(p.as_of)))
            dates = store.upsert_partitions(spark, path, "sales_history_raw", batch).dates
        changed = incremental.refresh_daily(spark, stored("sales_history_raw", path), daily, dates, p)
        if weekly:
            incremental.refresh_weekly(spark, stored("sales_daily", daily), vmap, weeks, changed, p)
    return stored("sales_weekly", weeks) if weekly else stored("sales_daily", daily)


DEDUPED = f"sales AS MATERIALIZED ({_dedupe_sql(f'(SELECT {SALES_COLS} FROM sales_fx)', 'sale_id', ', '.join(SALES_ORDER))})"


def _over_deduped(body: list[str], select: str) -> FixtureSQL:
    """Oracle over one row a sale_id: the fixture's ``sales`` replaced."""
    class Deduped(FixtureSQL):
        def render(self, grain: str = "bt") -> str:
            base = [DEDUPED if c.startswith("sales AS (") else c for c in fixture_ctes(grain, self.p)]
            return "WITH " + ",\n".join(base + self.body) + "\n" + self.select
    return Deduped(body, select)


@register("t21_sales_daily_kept_up", _over_deduped([SALES_DAILY_V_CTE], "SELECT sale_date, variant_id, sku, qty_sold FROM sales_daily_v"))
def q_sales_daily_kept_up(spark, sf_dir, grain="bt"):
    return _kept_up(fx(spark, sf_dir, grain), weekly=False).select("sale_date", "variant_id", "sku", "qty_sold")


@register("t22_sales_weekly_kept_up", _over_deduped([SALES_DAILY_V_CTE, "vvm AS (SELECT variant_id FROM variants_k WHERE vendor > '')", SALES_WEEKLY_CTE],
                                                    "SELECT week_start, variant_id, sku, qty_sold FROM sales_weekly"))
def q_sales_weekly_kept_up(spark, sf_dir, grain="bt"):
    return _kept_up(fx(spark, sf_dir, grain), weekly=True).select("week_start", "variant_id", "sku", "qty_sold")
