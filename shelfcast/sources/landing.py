"""Landed API pages -> flat tables.

The sync job lands every API response page as one JSON line; the landing
metadata the page itself does not carry (page number, and for inventory the
location id and snapshot instant) sits next to ``data``. Pages are read with
explicit schemas (never inferred), pages that do not fit are rejected whole
(`split_rejects`), and the rest is flattened with ``explode`` — narrow,
per-page work, so landing many days of pages scales with the number of files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.semantics import gid_suffix

S, L, B, I = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _edges(node: T.DataType) -> T.ArrayType:
    return T.ArrayType(_st(("node", node)))


PAGE_INFO = _st(("hasNextPage", B), ("endCursor", S))
VARIANT_NODE = _st(("id", S), ("title", S), ("sku", S), ("price", S), ("inventoryItem", _st(("id", S))))
PRODUCT_NODE = _st(("id", S), ("title", S), ("vendor", S), ("status", S), ("createdAt", S), ("updatedAt", S),
                   ("variants", _st(("edges", _edges(VARIANT_NODE)))))
PRODUCTS_PAGE = _st(("page", L), ("data", _st(("products", _st(("edges", _edges(PRODUCT_NODE)), ("pageInfo", PAGE_INFO))))))

LOCATION_NODE = _st(("id", S), ("name", S), ("isActive", B))
LOCATIONS_PAGE = _st(("page", L), ("data", _st(("locations", _st(("edges", _edges(LOCATION_NODE)))))))

QUANTITY = _st(("name", S), ("quantity", L))
LEVEL_NODE = _st(("id", S), ("item", _st(("id", S), ("sku", S))), ("quantities", T.ArrayType(QUANTITY)))
INVENTORY_PAGE = _st(("page", L), ("location_id", S), ("snapshot_ts", S),
                     ("data", _st(("location", _st(("inventoryLevels",
                                                    _st(("edges", _edges(LEVEL_NODE)), ("pageInfo", PAGE_INFO))))))))

LINE_NODE = _st(("id", S), ("title", S), ("sku", S), ("quantity", L),
                ("variant", _st(("id", S), ("product", _st(("vendor", S))))))
ORDER_NODE = _st(("id", S), ("name", S), ("createdAt", S), ("cancelledAt", S), ("test", B),
                 ("lineItems", _st(("edges", _edges(LINE_NODE)))))
ORDERS_PAGE = _st(("page", L), ("data", _st(("orders", _st(("edges", _edges(ORDER_NODE)), ("pageInfo", PAGE_INFO))))))


CORRUPT = "_corrupt"
LANDED = "_landed"               # modification time of a page's file


def read_pages(spark: SparkSession, path: str | list[str], schema: T.StructType, landed: bool = False) -> DataFrame:
    """Landed JSON-lines pages with a fixed schema, and ``_corrupt`` with the text of a line that does not fit it.

    With ``landed`` also ``_landed``, which tells repeated listings of one day apart.
    """
    raw = spark.read.text(path)
    if landed:
        raw = raw.select("value", F.col("_metadata.file_modification_time").alias(LANDED))
    return parse_pages(raw.filter(F.trim("value") != ""), "value", schema, corrupt=True)


def parse_pages(raw: DataFrame, column: str, schema: T.StructType, corrupt: bool = False) -> DataFrame:
    """Pages held as JSON text in a column (e.g. a message payload)."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if corrupt else schema
    options = {"columnNameOfCorruptRecord": CORRUPT} if corrupt else {}
    landed = _landed(raw)
    return raw.select(*landed, F.from_json(F.col(column), full, options).alias("_p")).select(*landed, "_p.*")


def _landed(pages: DataFrame) -> list[str]:
    return [LANDED] if LANDED in pages.columns else []


def _unreadable(c) -> F.Column:
    """A written instant that is no timestamp."""
    return c.isNotNull() & F.try_to_timestamp(c).isNull()


def _bad_page(kind: str) -> F.Column:
    """True for a page that cannot be flattened without losing something it holds."""
    none = F.lit(False)
    bad = {
        "products": lambda: F.exists("data.products.edges", lambda e: _unreadable(e["node"]["createdAt"])
                                     | _unreadable(e["node"]["updatedAt"])),
        "locations": lambda: none,
        "inventory": lambda: F.col("snapshot_ts").isNull() | _unreadable(F.col("snapshot_ts")),
        "orders": lambda: F.exists("data.orders.edges", lambda e: e["node"]["createdAt"].isNull()
                                   | _unreadable(e["node"]["createdAt"])),
    }[kind]()
    return F.col(CORRUPT).isNotNull() | F.coalesce(bad, none)


def split_rejects(pages: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(pages to flatten, rejected pages as (kind, page, reason, text)) of `read_pages`.

    A truncated line, a value of the wrong type and an instant that cannot be
    read reject the whole page. Absent values keep their documented defaults.
    """
    marked = pages.withColumn("_bad", _bad_page(kind))
    good = marked.filter(~F.col("_bad")).drop("_bad", CORRUPT)
    text = F.coalesce(CORRUPT, F.to_json(F.struct(*[c for c in pages.columns if c not in (CORRUPT, LANDED)])))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("not the page schema")).otherwise(F.lit("unreadable instant"))
    return good, marked.filter("_bad").select(F.lit(kind).alias("kind"), "page", reason.alias("reason"), text.alias("text"))


def _instant(c) -> F.Column:
    return F.try_to_timestamp(c)


# ------------------------------------------------------------------ C01 products, variants
def flatten_products(pages: DataFrame, with_position: bool = False) -> tuple[DataFrame, DataFrame]:
    """Products and their variants; ids are GID suffixes, sku '' and price 0.0 by default.

    ``with_position`` keeps ``listing_pos`` (time of landing if known, page,
    product, variant index) so a later last-wins lookup can follow the API
    listing order.
    """
    pos = [*_landed(pages), "page", "pi"]
    prod = (pages.select(*pos[:-1], F.posexplode("data.products.edges").alias("pi", "e"))
            .select(*pos, "e.node.*"))
    products = prod.select(
        *([F.struct(*pos).alias("listing_pos")] if with_position else []),
        gid_suffix("id").alias("product_id"), "title", "vendor", "status",
        _instant(F.col("createdAt")).alias("created_at"), _instant(F.col("updatedAt")).alias("updated_at"))
    var = (prod.select(*pos, gid_suffix("id").alias("product_id"),
                       F.posexplode("variants.edges").alias("vi", "ve"))
           .select(*pos, "vi", "product_id", "ve.node.*"))
    price = F.coalesce(F.nullif(F.col("price"), F.lit("")).try_cast("double"), F.lit(0.0))
    cols = [gid_suffix("id").alias("variant_id"), "product_id", F.coalesce("sku", F.lit("")).alias("sku"), "title",
            price.alias("price"), gid_suffix("inventoryItem.id").alias("inventory_item_id")]
    if with_position:
        cols.append(F.struct(*pos, "vi").alias("listing_pos"))
    return products, var.select(*cols)


# ------------------------------------------------------------------ C02 locations
def flatten_locations(pages: DataFrame) -> DataFrame:
    """Locations with ``active = bool(isActive)``."""
    landed = _landed(pages)
    return (pages.select(*landed, F.explode("data.locations.edges").alias("e")).select(*landed, "e.node.*")
            .select(*landed, gid_suffix("id").alias("location_id"), "name",
                    F.coalesce("isActive", F.lit(False)).alias("active")))


# ------------------------------------------------------------------ C03 inventory
def inventory_item_map(variants: DataFrame) -> DataFrame:
    """inventory_item_id -> variant_id; on a repeated item the last listed variant wins."""
    ok = (F.col("inventory_item_id").isNotNull() & (F.col("inventory_item_id") != "")
          & F.col("variant_id").isNotNull() & (F.col("variant_id") != ""))
    pick = F.max_by("variant_id", "listing_pos") if "listing_pos" in variants.columns else F.max("variant_id")
    return variants.filter(ok).groupBy("inventory_item_id").agg(pick.alias("variant_id"))


def _quantity(name: str) -> F.Column:
    hits = F.filter(F.coalesce("quantities", F.array().cast(T.ArrayType(QUANTITY))), lambda q: q["name"] == name)
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["quantity"], F.lit(0).cast("bigint"))


def flatten_inventory(pages: DataFrame, variants: DataFrame, locations: DataFrame) -> DataFrame:
    """One snapshot row per (mapped item, active location).

    Items without an id or with no known variant are dropped; quantity names
    repeat last-wins; a missing or NULL quantity is 0.
    """
    active = locations.filter(F.col("active")).select("location_id")
    lv = (pages.join(active, "location_id", "left_semi")
          .select("location_id", "snapshot_ts", F.explode("data.location.inventoryLevels.edges").alias("e"))
          .select("location_id", "snapshot_ts", "e.node.*")
          .filter(F.col("item").isNotNull())
          .select("location_id", "snapshot_ts", "quantities",
                  gid_suffix("item.id").alias("inventory_item_id"), F.coalesce("item.sku", F.lit("")).alias("sku")))
    j = lv.join(inventory_item_map(variants), "inventory_item_id")
    ts = _instant(F.col("snapshot_ts"))
    day = F.to_date(ts)
    return j.select(
        F.concat_ws("_", "variant_id", "location_id", day.cast("string")).alias("snapshot_id"),
        "variant_id", "sku", "location_id",
        _quantity("available").alias("available_qty"), _quantity("incoming").alias("incoming_qty"),
        _quantity("committed").alias("committed_qty"), day.alias("snapshot_date"), ts.alias("snapshot_timestamp"))


# ------------------------------------------------------------------ C04 sales
def flatten_sales(pages: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """One sale per line item of real orders created at/after ``since``.

    Test and cancelled orders and lines without a variant are skipped.
    ``sale_date`` is the order's *local* calendar date (the date written in
    ``createdAt``); ``sale_timestamp`` is the UTC instant.
    """
    o = pages.select(F.explode("data.orders.edges").alias("e")).select("e.node.*")
    created = _instant(F.col("createdAt"))
    keep = ~F.coalesce("test", F.lit(False)) & (F.col("cancelledAt").isNull() | (F.col("cancelledAt") == ""))
    if since is not None:
        keep = keep & (created >= F.lit(since.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
    o = o.filter(keep).select(
        gid_suffix("id").alias("order_id"), F.coalesce("name", F.lit("")).alias("order_name"),
        F.to_date(F.substring("createdAt", 1, 10)).alias("sale_date"), created.alias("sale_timestamp"),
        F.explode("lineItems.edges").alias("li"))
    li = o.select("order_id", "order_name", "sale_date", "sale_timestamp", "li.node.*").filter(F.col("variant").isNotNull())
    return li.select(
        F.concat("order_id", F.lit("_"), gid_suffix("id")).alias("sale_id"), "order_id", "order_name",
        gid_suffix("variant.id").alias("variant_id"), F.coalesce("sku", F.lit("")).alias("sku"),
        F.col("title").alias("product_title"), F.coalesce("quantity", F.lit(0).cast("bigint")).alias("quantity_sold"),
        "sale_date", "sale_timestamp", F.coalesce("variant.product.vendor", F.lit("")).alias("vendor"),
        F.lit(None).cast("decimal(38,9)").alias("line_price"))
