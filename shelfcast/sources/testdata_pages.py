"""Build API-shaped JSON pages from the fixture tables (FIXTURES.md §2, JSON fixture).

Pages group nodes by a rule on the data (``key div page_size``), so every
page is a bounded ``collect_list``; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.sources.testdata import ARCHIVED_AT, Fixture

GID = "gid://shop/{}/"
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Orders are stamped 20:00 at UTC-5, so the local sale date differs from the UTC date.
ORDER_LOCAL = "yyyy-MM-dd'T'20:00:00'-05:00'"
PRODUCTS_PER_PAGE, LEVELS_PER_PAGE, ORDERS_PER_PAGE, LINES_PER_NODE = 50, 250, 250, 250


def _gid(kind: str, c) -> F.Column:
    return F.concat(F.lit(GID.format(kind)), c)


def _page_json(nodes: DataFrame, page: F.Column, wrap, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    grouped = nodes.groupBy(page.alias("page"), *extra_keys).agg(
        F.collect_list(F.struct(F.col("node").alias("node"))).alias("edges"))
    info = F.struct(F.lit(False).alias("hasNextPage"), F.lit(None).cast("string").alias("endCursor"))
    return grouped.select(F.to_json(F.struct(F.col("page").cast("bigint").alias("page"),
                                             *[F.col(k) for k in extra_keys],
                                             F.struct(wrap(F.col("edges"), info)).alias("data"))).alias("json"))


def product_pages(f: Fixture) -> DataFrame:
    v = f.variants_k
    p = f.products.withColumnRenamed("vendor", "p_vendor")
    j = v.join(p, v.variant_id == p.product_id)
    variant = F.struct(_gid("ProductVariant", F.col("variant_id")).alias("id"), F.col("v.title").alias("title"),
                       F.col("sku"), F.col("price").cast("string").alias("price"),
                       F.struct(_gid("InventoryItem", F.concat(F.lit("inv"), F.col("k").cast("string"))).alias("id"))
                       .alias("inventoryItem"))
    node = F.struct(_gid("Product", F.col("product_id")).alias("id"), F.col("p.title").alias("title"),
                    F.col("p_vendor").alias("vendor"), F.col("status"),
                    F.date_format("created_at", ISO_Z).alias("createdAt"),
                    F.date_format("updated_at", ISO_Z).alias("updatedAt"),
                    F.struct(F.array(F.struct(variant.alias("node"))).alias("edges")).alias("variants"))
    nodes = v.alias("v").join(p.alias("p"), F.col("v.variant_id") == F.col("p.product_id")).select(
        F.col("k"), node.alias("node"))
    return _page_json(nodes, F.floor(F.col("k") / PRODUCTS_PER_PAGE),
                      lambda e, info: F.struct(e.alias("edges"), info.alias("pageInfo")).alias("products"))


def location_pages(f: Fixture) -> DataFrame:
    r = f.table("region")
    node = F.struct(_gid("Location", F.col("r_regionkey").cast("string")).alias("id"), F.col("r_name").alias("name"),
                    (F.col("r_regionkey") != 4).alias("isActive"))
    nodes = r.select("r_regionkey", node.alias("node"))
    return _page_json(nodes, F.floor(F.col("r_regionkey") / PRODUCTS_PER_PAGE),
                      lambda e, info: F.struct(e.alias("edges")).alias("locations"))


def inventory_pages(f: Fixture) -> DataFrame:
    inv = f.inventory.join(f.variants_k.select("variant_id", "k"), "variant_id")
    q = lambda name, c: F.struct(F.lit(name).alias("name"), F.col(c).alias("quantity"))
    node = F.struct(F.concat(F.lit("gid://shop/InventoryLevel/"), F.col("snapshot_id")).alias("id"),
                    F.struct(_gid("InventoryItem", F.concat(F.lit("inv"), F.col("k").cast("string"))).alias("id"),
                             F.col("sku")).alias("item"),
                    F.array(q("available", "available_qty"), q("incoming", "incoming_qty"),
                            q("committed", "committed_qty")).alias("quantities"))
    nodes = inv.select("k", "location_id", F.date_format("snapshot_timestamp", ISO_Z).alias("snapshot_ts"),
                       node.alias("node"))
    return _page_json(nodes, F.floor(F.col("k") / LEVELS_PER_PAGE),
                      lambda e, info: F.struct(F.struct(e.alias("edges"), info.alias("pageInfo"))
                                               .alias("inventoryLevels")).alias("location"),
                      extra_keys=("location_id", "snapshot_ts"))


def order_pages(f: Fixture) -> DataFrame:
    """One order node per (order key, ship date); flags from FIXTURES.md (cancelled / test)."""
    line = F.struct(_gid("LineItem", F.col("l_linenumber").cast("string")).alias("id"),
                    F.concat(F.lit("Product "), F.col("variant_id")).alias("title"), F.col("sku"), F.col("quantity_sold").alias("quantity"),
                    F.struct(_gid("ProductVariant", F.col("variant_id")).alias("id"),
                             F.struct(F.col("vendor").alias("vendor")).alias("product")).alias("variant"))
    # at most LINES_PER_NODE lines per order node (the API pages nested lines the same
    # way), so no group grows with the size of one order
    chunk = F.floor(F.col("l_linenumber") / LINES_PER_NODE).alias("chunk")
    # one shuffle by page, of narrow rows: both groupings below reuse that partitioning
    # (collect_list gains nothing from a map-side combine)
    parts = int(f.spark.conf.get("spark.sql.shuffle.partitions"))
    page = F.floor(F.col("o_orderkey") / ORDERS_PER_PAGE)
    lines = f.sale_lines.join(f.order_flags, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey").repartition(parts, page)
    # the line is built before it is collected: inside the aggregate it would be interpreted row by row
    orders = (lines.select(page.alias("page"), "o_orderkey", F.col("l_shipdate").cast("date").alias("sale_date"), "cancelled", "test", chunk,
                           F.struct(line.alias("node")).alias("line"))
              .groupBy("page", "o_orderkey", "sale_date", "cancelled", "test", "chunk")
              .agg(F.collect_list("line").alias("lines")))
    created = F.date_format(F.col("sale_date"), ORDER_LOCAL)
    node = F.struct(_gid("Order", F.col("o_orderkey").cast("string")).alias("id"),
                    F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
                    created.alias("createdAt"),
                    F.when(F.col("cancelled"), F.lit(ARCHIVED_AT.strftime("%Y-%m-%dT%H:%M:%SZ"))).alias("cancelledAt"),
                    F.col("test"), F.struct(F.col("lines").alias("edges")).alias("lineItems"))
    nodes = orders.select("o_orderkey", node.alias("node"))
    return _page_json(nodes, page,
                      lambda e, info: F.struct(e.alias("edges"), info.alias("pageInfo")).alias("orders"))
