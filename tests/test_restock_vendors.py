import datetime as dt

from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import restock, vendors
from shelfcast.params import Params

P = Params(as_of=dt.date(2001, 11, 5))
AS_OF = P.as_of
LINES = "variant_id string, sku string, vendor_name string, product_title string, variant_title string"


def test_stockout_first_date_reaching_stock(spark):
    days = [AS_OF + dt.timedelta(days=i) for i in range(5)]
    fc = spark.createDataFrame([("a", d, 2) for d in days] + [("b", d, 1) for d in days] + [("z", days[0], 5)],
                               "variant_id string, forecast_date date, predicted_qty bigint")
    cur = spark.createDataFrame([("a", 4), ("b", 100), ("z", 0)], "variant_id string, current_stock bigint")
    got = {r.variant_id: r for r in restock.stockout_predictions(fc, cur, P).collect()}
    assert set(got) == {"a"}                      # b never runs out; stock 0 is not predicted
    assert (got["a"].stockout_date, got["a"].days_remaining) == (days[1], 1)   # cum 2,4 -> reaches 4 exactly


def test_stockout_date_is_monotone_in_stock(spark):
    days = [AS_OF + dt.timedelta(days=i) for i in range(30)]
    fc = spark.createDataFrame([("a", d, 3) for d in days], "variant_id string, forecast_date date, predicted_qty bigint")
    prev = None
    for stock in (1, 3, 4, 10, 50):
        cur = spark.createDataFrame([("a", stock)], "variant_id string, current_stock bigint")
        r = restock.stockout_predictions(fc, cur, P).first()
        assert prev is None or r.stockout_date >= prev
        prev = r.stockout_date


def restock_inputs(spark, stock, quality, forecast_units, sold_56d, moq=5, pack=4, lead=4):
    vmap = spark.createDataFrame([("v", "SKU", "Acme", "pt", "vt")], LINES)
    status = spark.createDataFrame([("Acme", False, None, None)], schemas.VENDOR_STATUS)
    cadence = spark.createDataFrame([("Acme", 1, 1.0, 1, 7, AS_OF)],
                                    "vendor_name string, revenue_rank int, vendor_revenue_6m double, "
                                    "vendor_units_sold_6m bigint, restock_frequency_days int, frozen_as_of_date date")
    vend = spark.createDataFrame([(1, "Acme", lead, moq, pack)], schemas.VENDORS)
    snap_day = AS_OF - dt.timedelta(days=1)
    snaps = spark.createDataFrame([("s", "v", "SKU", "1", stock, 0, 0, snap_day, None)], schemas.INVENTORY_SNAPSHOTS)
    fc = spark.createDataFrame([("v", AS_OF + dt.timedelta(days=i), forecast_units) for i in range(60)],
                               "variant_id string, forecast_date date, predicted_qty bigint")
    sales = spark.createDataFrame([("x", "o", "#o", "v", "SKU", "t", sold_56d, AS_OF - dt.timedelta(days=3), None, "Acme", None)],
                                  schemas.SALES_HISTORY)
    flags = spark.createDataFrame([("v", quality)], "variant_id string, model_quality string")
    return restock.vendor_restocks(vmap, status, cadence, vend, snaps, fc, restock.fallback_demand(sales, P), flags, P)


def test_a_variant_of_two_vendors_has_each_vendors_own_demand(spark):
    vmap = spark.createDataFrame([("v", "SKU", "Near", "pt", "vt"), ("v", "SKU", "Far", "pt", "vt")], LINES)
    status = spark.createDataFrame([("Near", False, None, None), ("Far", None, None, None)], schemas.VENDOR_STATUS)
    cadence = spark.createDataFrame([("Near", 7), ("Far", 7)], "vendor_name string, restock_frequency_days int")
    vend = spark.createDataFrame([(1, "Near", 0, 1, 1), (2, "Far", 10, 1, 1)], schemas.VENDORS)
    snaps = spark.createDataFrame([], schemas.INVENTORY_SNAPSHOTS)
    fc = spark.createDataFrame([("v", AS_OF + dt.timedelta(days=i), 1) for i in range(-5, 60)],
                               "variant_id string, forecast_date date, predicted_qty bigint")
    flags = spark.createDataFrame([("v", "GOOD")], "variant_id string, model_quality string")
    fallback = spark.createDataFrame([], "variant_id string, avg_daily_units double")
    got = {r.vendor_name: r.expected_demand for r in restock.vendor_restocks(
        vmap, status, cadence, vend, snaps, fc, fallback, flags, P).collect()}
    assert got == {"Near": 11, "Far": 21}         # horizons of 10 and 20 days, both ends counted


def test_restock_quantities(spark):
    # horizon 4 + 7 + 3 = 14 days, forecast window inclusive -> 15 days x 1 unit
    r = restock_inputs(spark, stock=10, quality="GOOD", forecast_units=1, sold_56d=0).first()
    assert (r.horizon_days, r.expected_demand_forecast, r.demand_source) == (14, 15, "FORECAST")
    assert r.reorder_qty == 8                     # need 5 -> ceil(5/4)*4 = 8 > moq 5
    # need below moq -> moq (moq itself is not rounded to a pack multiple)
    r = restock_inputs(spark, stock=14, quality="GOOD", forecast_units=1, sold_56d=0).first()
    assert r.reorder_qty == 5
    # stock covers demand -> no line
    assert restock_inputs(spark, stock=15, quality="GOOD", forecast_units=1, sold_56d=0).count() == 0
    # not GOOD -> 56-day fallback: 112 units / 56 days * 14 = 28; negative stock does not add to need
    r = restock_inputs(spark, stock=-3, quality="WEAK", forecast_units=1, sold_56d=112).first()
    assert (r.expected_demand, r.demand_source, r.current_stock, r.raw_stock, r.negative_stock_flag) == \
        (28, "FALLBACK_56D", 0, -3, True)
    assert r.reorder_qty == 28


def test_reorder_qty_is_zero_or_at_least_moq(spark):
    for stock in (0, 3, 9, 13, 14):
        for r in restock_inputs(spark, stock=stock, quality="GOOD", forecast_units=1, sold_56d=0, moq=7, pack=3).collect():
            assert r.reorder_qty >= r.moq and r.reorder_qty > 0


def test_maintain_vendors_appends_with_ids(spark):
    products = spark.createDataFrame([("p1", "t", "Old", "A", None, None), ("p2", "t", "Zed", "A", None, None),
                                      ("p3", "t", "Acme", "A", None, None), ("p4", "t", "", "A", None, None)],
                                     schemas.PRODUCTS)
    existing = spark.createDataFrame([(7, "Old", None, 3, None)], schemas.VENDORS)
    got = sorted(tuple(r) for r in vendors.maintain_vendors(products, existing, P).collect())
    assert got == [(7, "Old", 5, 3, 6), (8, "Acme", 5, 6, 6), (9, "Zed", 5, 6, 6)]
    empty = vendors.maintain_vendors(products, existing.limit(0), P)
    assert sorted(r.vendor_id for r in empty.collect()) == [1, 2, 3]
    status = vendors.maintain_vendor_status(spark.createDataFrame([("Old", True, None, "n")], schemas.VENDOR_STATUS),
                                            vendors.maintain_vendors(products, existing, P))
    s = {r.vendor_name: (r.archived, r.note) for r in status.collect()}
    assert s == {"Old": (True, "n"), "Acme": (False, None), "Zed": (False, None)}
    un = {r.vendor_name: (r.archived, r.archived_at, r.note) for r in vendors.unarchive_vendor(status, "Old").collect()}
    assert un["Old"] == (False, None, "n")
    ar = {r.vendor_name: r.archived for r in vendors.archive_vendor(status, "Zed", dt.datetime(2001, 1, 1)).collect()}
    assert ar["Zed"] is True


def test_vendor_rank_ties_and_cadence(spark):
    variants = spark.createDataFrame([("v1", "p1", "S1", "t", 2.0, "i"), ("v2", "p2", "S2", "t", 1.0, "i"),
                                      ("v3", "p3", "S1", "t", 2.0, "i")], schemas.VARIANTS)
    products = spark.createDataFrame([("p1", "t", "A", "x", None, None), ("p2", "t", "B", "x", None, None),
                                      ("p3", "t", "C", "x", None, None)], schemas.PRODUCTS)
    sales = spark.createDataFrame([("1", "o", "#", "v1", "S1", "t", 10, AS_OF - dt.timedelta(days=5), None, "A", None),
                                   ("2", "o", "#", "v2", "S2", "t", 20, AS_OF - dt.timedelta(days=5), None, "B", None)],
                                  schemas.SALES_HISTORY)
    rank = vendors.vendor_sales_rank(sales, variants, products, P)
    got = {r.vendor_name: (r.vendor_units_sold_6m, r.vendor_revenue_6m, r.revenue_rank) for r in rank.collect()}
    # sku S1 is shared by vendors A and C: both are credited (reference join on sku)
    assert got == {"A": (10, 20.0, 1), "C": (10, 20.0, 1), "B": (20, 20.0, 1)}
    cad = vendors.vendor_cadence(rank, Params(fast_cadence_top_n=0))
    assert {r.restock_frequency_days for r in cad.collect()} == {14}
