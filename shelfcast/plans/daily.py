"""The daily load: landed pages -> dimensions (replace) + facts (staged upsert).

Layout of a landing folder (JSON lines, one API page per line)::

    products/  locations/  inventory/  orders/      each with day=YYYY-MM-DD folders

A load reads the files that landed since the last one, whatever their day:
``<store>/_files_read``, a ledger partitioned by day, keeps path, size and
modification time of each file read, so pages that come late into a day are
read by the next load. The listing meets the ledger in an anti join; the driver
collects one load's files. Facts come
from the new files, dimensions from all files of the newest landed day (an id
listed again there counts as last landed). A folder without ``day=`` folders is
read whole. Dimensions are replaced only when the load is non-empty (C05);
inventory and sales go through staging (C06) and the partition-bounded upsert
(C07/C08), whose range is that of the new files.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources import landing, store

KINDS = {"products": landing.PRODUCTS_PAGE, "locations": landing.LOCATIONS_PAGE,
         "inventory": landing.INVENTORY_PAGE, "orders": landing.ORDERS_PAGE}


DIMENSIONS = ("products", "locations")
LEDGER = "_files_read"
FILES = "kind string, day string, path string, size bigint, modified bigint"


def landed_files(spark: SparkSession, landing_dir: str) -> DataFrame | None:
    """`FILES` of all landed days, listed without reading them; None for a folder without days."""
    folders = [(kind, f"{landing_dir}/{kind}") for kind in KINDS if store.partition_values(spark, f"{landing_dir}/{kind}", "day")]
    found = None
    for kind, folder in folders:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
                 .select(F.lit(kind).alias("kind"), F.regexp_extract("path", r"/day=([^/]+)/", 1).alias("day"), "path",
                         F.col("length").alias("size"), F.unix_millis("modificationTime").alias("modified"))
                 .filter("day <> ''"))
        found = files if found is None else found.unionByName(files)
    return found


def new_files(spark: SparkSession, landed: DataFrame, store_dir: str) -> DataFrame:
    """The landed files that no load has read yet, or not as they are now."""
    ledger = f"{store_dir}/{LEDGER}"
    if not store.table_exists(spark, ledger):
        return landed
    return landed.join(spark.read.schema(FILES).parquet(ledger), landed.columns, "left_anti")


def _newest_day(landed: DataFrame, kind: str) -> list[str]:
    """Paths of a dimension's newest landed day."""
    files = landed.filter(F.col("kind") == kind)
    day = files.agg(F.max("day")).first()[0]
    return [r["path"] for r in files.filter(F.col("day") == day).collect()] if day else []


def _paths(landing_dir: str, kind: str, landed: DataFrame | None, new: list[tuple]) -> tuple[list[str], list[str]]:
    """Paths to read for the first time, and files of the newest day's dimensions to read again."""
    if landed is None:
        return [f"{landing_dir}/{kind}"], []
    fresh = [path for k, _, path, *_ in new if k == kind]
    if kind not in DIMENSIONS:
        return fresh, []
    newest = _newest_day(landed, kind)
    return [p for p in newest if p in set(fresh)], [p for p in newest if p not in set(fresh)]


def _load_id(new: list[tuple]) -> str:
    """The same for a load that is run again over the same files."""
    return hashlib.md5(repr(sorted(new)).encode()).hexdigest() if new else "all"


def daily_load(spark: SparkSession, landing_dir: str, store_dir: str, since: dt.datetime | None = None,
               on_duplicate: str = "error", on_reject: str = "fail") -> dict:
    """Run one daily load; returns what was written (rows/partitions per table, rejected pages per kind).

    ``on_reject``: 'fail' stops before anything is written, naming the counts;
    'quarantine' writes the rejected pages to ``<store>/rejects/load=<id>`` and
    loads the rest. ``on_duplicate`` is `store.upsert_partitions`'s.
    """
    landed = landed_files(spark, landing_dir)
    new = [] if landed is None else sorted(map(tuple, new_files(spark, landed, store_dir).collect()))   # one load's files
    if landed is not None and not new:
        return {"days": []}
    days = None if landed is None else sorted({day for _, day, *_ in new})
    pages: dict[str, DataFrame] = {}
    rejects = None
    for kind, schema in KINDS.items():
        paths, again = _paths(landing_dir, kind, landed, new)
        stamped = landed is not None and kind in DIMENSIONS
        read = landing.read_pages(spark, paths, schema, stamped) if paths else landing.parse_pages(
            spark.createDataFrame([], f"value string, {landing.LANDED} timestamp" if stamped else "value string"),
            "value", schema, corrupt=True)
        pages[kind], bad = landing.split_rejects(read, kind)
        if again:                                       # their rejects were counted by the load that read them first
            seen, _ = landing.split_rejects(landing.read_pages(spark, again, schema, stamped), kind)
            pages[kind] = pages[kind].unionByName(seen)
        rejects = bad if rejects is None else rejects.unionByName(bad)
    counts = {r["kind"]: r["n"] for r in rejects.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts and on_reject == "fail":
        raise ValueError(f"rejected pages: {counts}")
    report: dict = {"days": days, "rejects": counts}
    if counts:                                          # a load that is run again replaces its own rejects
        rejects.write.mode("overwrite").parquet(f"{store_dir}/rejects/load={_load_id(new)}")

    products, variants = landing.flatten_products(pages["products"], with_position=True)
    locations = landing.flatten_locations(pages["locations"])
    if landed is not None:
        products = store.dedupe(products, "product_id", ["listing_pos"], latest=True)
        variants = store.dedupe(variants, "variant_id", ["listing_pos"], latest=True)
        locations = store.dedupe(locations, "location_id", [landing.LANDED], latest=True)
    inventory = landing.flatten_inventory(pages["inventory"], variants, locations)
    sales = landing.flatten_sales(pages["orders"], since)
    for name, df in (("products", products), ("variants", variants.drop("listing_pos")), ("locations", locations)):
        report[name] = store.write_dimension(df, f"{store_dir}/{name}", name)
    for name, df, stg in (("inventory_snapshots_raw", inventory, "inventory_snapshots_stg"),
                          ("sales_history_raw", sales, "sales_history_stg")):
        staged = store.stage(df, f"{store_dir}/{stg}", stg)
        report[name] = store.upsert_partitions(spark, f"{store_dir}/{name}", name, staged, on_duplicate=on_duplicate)
    if new:
        spark.createDataFrame(new, FILES).coalesce(1).write.mode("append").partitionBy("day").parquet(f"{store_dir}/{LEDGER}")
    return report
