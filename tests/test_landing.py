import datetime as dt
import json

from pyspark.sql import functions as F

from shelfcast.sources import landing


def pages(spark, docs, schema):
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")
    return landing.parse_pages(raw, "json", schema)


PRODUCTS = [{"page": 1, "data": {"products": {"edges": [
    {"node": {"id": "gid://x/Product/12", "title": "T", "vendor": "V", "status": "ACTIVE",
              "createdAt": "2001-01-01T00:00:00Z", "updatedAt": "2001-01-02T03:04:05Z",
              "variants": {"edges": [
                  {"node": {"id": "gid://x/ProductVariant/100", "title": "a", "sku": None, "price": None,
                            "inventoryItem": {"id": "gid://x/InventoryItem/500"}}},
                  {"node": {"id": "gid://x/ProductVariant/101", "title": "b", "sku": "S1", "price": "2.50",
                            "inventoryItem": None}},
                  {"node": {"id": "gid://x/ProductVariant/102", "title": "c", "sku": "", "price": "",
                            "inventoryItem": {"id": "gid://x/InventoryItem/500"}}}]}}}],
    "pageInfo": {"hasNextPage": False, "endCursor": None}}}}]


def test_flatten_products_defaults(spark):
    products, variants = landing.flatten_products(pages(spark, PRODUCTS, landing.PRODUCTS_PAGE), with_position=True)
    p = products.first()
    assert (p.product_id, p.created_at) == ("12", dt.datetime(2001, 1, 1))
    v = {r.variant_id: r for r in variants.collect()}
    assert (v["100"].sku, v["100"].price, v["100"].inventory_item_id) == ("", 0.0, "500")
    assert (v["101"].sku, v["101"].price, v["101"].inventory_item_id) == ("S1", 2.5, "")
    # item 500 is listed twice: the later variant (102) wins, as a dict build would
    assert [(r.inventory_item_id, r.variant_id) for r in landing.inventory_item_map(variants).collect()] == [("500", "102")]


def test_flatten_locations_and_inventory(spark):
    locs = landing.flatten_locations(pages(spark, [{"page": 1, "data": {"locations": {"edges": [
        {"node": {"id": "gid://x/Location/1", "name": "A", "isActive": True}},
        {"node": {"id": "gid://x/Location/2", "name": "B", "isActive": None}}]}}}], landing.LOCATIONS_PAGE))
    assert sorted((r.location_id, r.active) for r in locs.collect()) == [("1", True), ("2", False)]
    _, variants = landing.flatten_products(pages(spark, PRODUCTS, landing.PRODUCTS_PAGE), with_position=True)
    lvl = lambda item, q: {"node": {"id": "L", "item": item, "quantities": q}}
    inv_docs = [{"page": 1, "location_id": loc, "snapshot_ts": "2001-11-04T23:30:00Z", "data": {"location": {
        "inventoryLevels": {"edges": [
            lvl({"id": "gid://x/InventoryItem/500", "sku": None},
                [{"name": "available", "quantity": 3}, {"name": "available", "quantity": 7}, {"name": "incoming", "quantity": None}]),
            lvl(None, [{"name": "available", "quantity": 1}]),
            lvl({"id": "gid://x/InventoryItem/999", "sku": "U"}, [{"name": "available", "quantity": 1}]),
            lvl({"id": "gid://x/InventoryItem/500", "sku": "Z"}, None)],
            "pageInfo": {"hasNextPage": False, "endCursor": None}}}}} for loc in ("1", "2")]
    inv = landing.flatten_inventory(pages(spark, inv_docs, landing.INVENTORY_PAGE), variants, locs)
    rows = sorted((r.snapshot_id, r.variant_id, r.sku, r.available_qty, r.incoming_qty, r.committed_qty)
                  for r in inv.collect())
    assert rows == [("102_1_2001-11-04", "102", "", 7, 0, 0), ("102_1_2001-11-04", "102", "Z", 0, 0, 0)]


def test_flatten_sales_filters_and_local_date(spark):
    line = lambda i, variant: {"node": {"id": f"gid://x/LineItem/{i}", "title": "t", "sku": None, "quantity": None,
                                        "variant": variant}}
    order = lambda oid, created, **kw: {"node": {"id": f"gid://x/Order/{oid}", "name": f"#{oid}", "createdAt": created,
                                                 "cancelledAt": kw.get("cancelled"), "test": kw.get("test", False),
                                                 "lineItems": {"edges": kw.get("lines", [])}}}
    doc = {"page": 1, "data": {"orders": {"edges": [
        order(1, "2001-11-04T23:30:00-05:00", lines=[line(1, {"id": "gid://x/ProductVariant/9", "product": None}),
                                                     line(2, None),
                                                     line(3, {"id": "gid://x/ProductVariant/8", "product": {"vendor": "V"}})]),
        order(2, "2001-11-04T10:00:00Z", test=True, lines=[line(1, {"id": "v", "product": None})]),
        order(3, "2001-11-04T10:00:00Z", cancelled="2001-11-04T11:00:00Z", lines=[line(1, {"id": "v", "product": None})]),
        order(4, "2001-01-01T10:00:00Z", lines=[line(1, {"id": "v", "product": None})])],
        "pageInfo": {"hasNextPage": False, "endCursor": None}}}}
    sales = landing.flatten_sales(pages(spark, [doc], landing.ORDERS_PAGE), since=dt.datetime(2001, 10, 1))
    rows = sorted((r.sale_id, r.variant_id, r.sku, r.quantity_sold, str(r.sale_date), r.sale_timestamp, r.vendor)
                  for r in sales.collect())
    assert rows == [("1_1", "9", "", 0, "2001-11-04", dt.datetime(2001, 11, 5, 4, 30), ""),
                    ("1_3", "8", "", 0, "2001-11-04", dt.datetime(2001, 11, 5, 4, 30), "V")]
