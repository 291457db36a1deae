"""Registered queries over stored tables and landed files.

Each lands the test tables under the session's shared folder first, so the
rows that are compared went through the writers, the upsert and the readers.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import inventory
from shelfcast.plans.catalog import ORACLE, P, fx, register
from shelfcast.plans.catalog_ingest import SINCE, inventory_batches, sales_batches
from shelfcast.plans.oracle_fixture import FixtureSQL, with_fixture
from shelfcast.session import checkpoint_dir
from shelfcast.sources import document, landing, store
from shelfcast.sources import testdata_pages as pages
from shelfcast.sources.testdata import Fixture

_MADE: list[str] = []


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{checkpoint_dir(spark)}/shelfcast-{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_stores(spark: SparkSession) -> None:
    """Delete what these queries have written; their results end with it."""
    while _MADE:
        store.delete_folder(spark, _MADE.pop())


def _same(name: str) -> FixtureSQL:
    return ORACLE[name]


# ------------------------------------------------------------------ C01-C04 over landed files
def _landed(f: Fixture, kind: str) -> DataFrame:
    build, schema = {"products": (pages.product_pages, landing.PRODUCTS_PAGE),
                     "locations": (pages.location_pages, landing.LOCATIONS_PAGE),
                     "inventory": (pages.inventory_pages, landing.INVENTORY_PAGE),
                     "orders": (pages.order_pages, landing.ORDERS_PAGE)}[kind]
    path = _folder(f.spark, f"landing-{kind}")
    # pages repeat their keys: packed, they are a ninth of their size on disk
    build(f).selectExpr("json AS value").write.option("compression", "lz4").text(path)
    good, rejected = landing.split_rejects(landing.read_pages(f.spark, path, schema), kind)
    if not rejected.isEmpty():
        raise ValueError(f"{kind}: rejected pages")
    return good


@register("s01a_landed_products", _same("c01a_flatten_products"))
def q_landed_products(spark, sf_dir, grain="bt"):
    return landing.flatten_products(_landed(fx(spark, sf_dir, grain), "products"))[0]


@register("s01b_landed_variants", _same("c01b_flatten_variants"))
def q_landed_variants(spark, sf_dir, grain="bt"):
    return landing.flatten_products(_landed(fx(spark, sf_dir, grain), "products"))[1]


@register("s02_landed_locations", _same("c02_flatten_locations"))
def q_landed_locations(spark, sf_dir, grain="bt"):
    return landing.flatten_locations(_landed(fx(spark, sf_dir, grain), "locations"))


@register("s03_landed_inventory", _same("c03_flatten_inventory"))
def q_landed_inventory(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    _, variants = landing.flatten_products(_landed(f, "products"), with_position=True)
    return landing.flatten_inventory(_landed(f, "inventory"), variants, landing.flatten_locations(_landed(f, "locations")))


@register("s04_landed_sales", _same("c04_flatten_sales"))
def q_landed_sales(spark, sf_dir, grain="bt"):
    return landing.flatten_sales(_landed(fx(spark, sf_dir, grain), "orders"), SINCE)


@register("s05_sync_tables", with_fixture([], """
SELECT 'products' AS name, product_id AS key, title AS label FROM products
UNION ALL SELECT 'variants', variant_id, sku FROM variants
UNION ALL SELECT 'locations', location_id, name FROM locations
UNION ALL SELECT 'inventory', snapshot_id, available_qty::VARCHAR FROM inventory
UNION ALL SELECT 'sales', sale_id, quantity_sold::VARCHAR FROM sales"""))
def q_sync_tables(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    path = _folder(spark, "sync")
    store.write_sync_tables({"products": f.products, "variants": f.variants, "locations": f.locations,
                             "inventory": f.inventory, "sales": f.sales_table()}, path)
    return _keys_and_labels(store.read_sync_tables(spark, path))


def _keys_and_labels(back: dict[str, DataFrame]) -> DataFrame:
    columns = {"products": ("product_id", "title"), "variants": ("variant_id", "sku"), "locations": ("location_id", "name"),
               "inventory": ("snapshot_id", "available_qty"), "sales": ("sale_id", "quantity_sold")}
    parts = [back[n].selectExpr(f"'{n}' AS name", f"{k} AS key", f"CAST({v} AS STRING) AS label") for n, (k, v) in columns.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@register("s05b_sync_documents", _same("s05_sync_tables"))
def q_sync_documents(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    path = _folder(spark, "documents")
    document.write_documents({"products": f.products, "variants": f.variants, "locations": f.locations,
                              "inventory": f.inventory, "sales": f.sales_table()}, path, compression="lz4")
    return _keys_and_labels(document.read_documents(spark, path, _folder(spark, "pieces")))


# ------------------------------------------------------------------ C06-C08 staging and upsert on stored facts
def _upserted(f: Fixture, name: str, target: DataFrame, source: DataFrame) -> DataFrame:
    path, staging = _folder(f.spark, name), _folder(f.spark, f"{name}-stg")
    store.write_fact(target, path, name)
    staged = store.stage(source, staging, name.replace("_raw", "_stg"))
    store.upsert_partitions(f.spark, path, name, staged)
    return f.spark.read.schema(store.table_schema(name)).parquet(path)


@register("s07_upsert_inventory_stored", _same("c07_upsert_inventory"))
def q_upsert_inventory_stored(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return _upserted(f, "inventory_snapshots_raw", *inventory_batches(f))


@register("s08_upsert_sales_stored", _same("c08_upsert_sales"))
def q_upsert_sales_stored(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    return _upserted(f, "sales_history_raw", *sales_batches(f))


# ------------------------------------------------------------------ C12 retention, C11 / C17 / C18b / C19 by partition
@register("s12_retention_stored", _same("c12_retained_sales"))
def q_retention_stored(spark, sf_dir, grain="bt"):
    path = _folder(spark, "sales")
    store.write_fact(fx(spark, sf_dir, grain).sales_table(), path, "sales_history_raw")
    store.enforce_retention(spark, path, "sale_date", P.as_of, P.retention_days)
    return spark.read.schema(store.table_schema("sales_history_raw")).parquet(path)


def _snapshots(f: Fixture) -> tuple[DataFrame, str]:
    path = _folder(f.spark, "snapshots")
    store.write_fact(f.inventory, path, "inventory_snapshots_raw")
    return f.spark.read.schema(store.table_schema("inventory_snapshots_raw")).parquet(path), path


@register("s11_current_inventory_stored", _same("c11_current_inventory"))
def q_current_inventory_stored(spark, sf_dir, grain="bt"):
    stored, path = _snapshots(fx(spark, sf_dir, grain))
    return inventory.current_inventory(stored, P, latest=store.latest_partition(spark, path, "snapshot_date", P.as_of))


@register("s17_latest_snapshot_count_stored", _same("c17_latest_snapshot_count"))
def q_latest_snapshot_count_stored(spark, sf_dir, grain="bt"):
    stored, path = _snapshots(fx(spark, sf_dir, grain))
    return inventory.latest_snapshot_count(stored, P, store.latest_partition(spark, path, "snapshot_date", P.as_of))


@register("s18b_latest_partitions_stored", _same("c18b_latest_partitions"))
def q_latest_partitions_stored(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    sales = _folder(spark, "sales")
    store.write_fact(f.sales_table(), sales, "sales_history_raw")
    return inventory.latest_stored_partitions(spark, _snapshots(f)[1], sales)


@register("s19_negative_stock_stored", _same("c19_negative_stock"))
def q_negative_stock_stored(spark, sf_dir, grain="bt"):
    f = fx(spark, sf_dir, grain)
    stored, path = _snapshots(f)
    return inventory.negative_stock(stored, f.variants, f.products, P,
                                    store.latest_partition(spark, path, "snapshot_date", P.as_of))
