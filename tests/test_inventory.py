import datetime as dt

from shelfcast import schemas
from shelfcast.operators import inventory
from shelfcast.sources import store

from shelfcast.params import Params

from conftest import D, TS

P = Params(as_of=dt.date(2001, 11, 5), internal_vendors=("Brand#1",))


def snaps(spark, rows):
    full = [(f"{v}_{loc}_{d}", v, sku, loc, a, 0, 0, D(d), TS(d + " 00:00:00")) for v, sku, loc, a, d in rows]
    return spark.createDataFrame(full, schemas.INVENTORY_SNAPSHOTS)


def test_current_inventory_edges(spark):
    df = snaps(spark, [
        ("neg", "", "1", -5, "2001-11-04"), ("neg", "S1", "2", 2, "2001-11-04"),
        ("zero", "S2", "1", 0, "2001-11-04"),
        ("nul", "S3", "1", None, "2001-11-04"), ("nul", "S3", "2", None, "2001-11-04"),
        ("old", "S4", "1", 100, "2001-10-01"),
        (None, "S5", "1", 7, "2001-11-04"), ("", "S6", "1", 8, "2001-11-04"),
    ])
    got = {r.variant_id: r for r in inventory.current_inventory(df, P).collect()}
    assert set(got) == {"neg", "zero", "nul", None, ""}          # NULL and '' kept (Q11)
    assert (got["neg"].raw_stock, got["neg"].current_stock, got["neg"].negative_stock_flag, got["neg"].sku) == (-3, 0, True, "S1")
    assert (got["zero"].current_stock, got["zero"].negative_stock_flag) == (0, False)
    assert got["nul"].raw_stock is None and got["nul"].current_stock is None
    restock_form = inventory.current_inventory(df, P, 30, drop_blank_variants=True)
    assert {r.variant_id for r in restock_form.collect()} == {"neg", "zero", "nul"}


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    df = snaps(spark, [("a", "S", "1", 1, "2001-11-01"), ("a", "S", "1", 2, "2001-11-04"), ("b", "S", "1", 3, "2001-11-04")])
    path = str(tmp_path / "inv")
    store.write_fact(df, path, "inventory_snapshots_raw")
    stored = spark.read.parquet(path)
    q = inventory.current_inventory(stored, P)
    plan = q._jdf.queryExecution().executedPlan().toString()
    pruned = [ln for ln in plan.splitlines() if "PartitionFilters" in ln and "= Subquery" in ln]
    assert pruned, plan      # the newest-date filter reaches the scan as a partition filter
    assert sorted((r.variant_id, r.raw_stock) for r in q.collect()) == [("a", 2), ("b", 3)]
    latest = store.latest_partition(spark, path, "snapshot_date", P.as_of)
    known = inventory.current_inventory(stored, P, latest=latest)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "(snapshot_date" in plan and "= 2001-11-04" in plan and "Subquery" not in plan     # a literal: no read for the date
    assert sorted((r.variant_id, r.raw_stock) for r in known.collect()) == [("a", 2), ("b", 3)]
    row = inventory.latest_stored_partitions(spark, path, str(tmp_path / "none")).first()
    assert (row.latest_snapshot_date, row.latest_sale_date) == (dt.date(2001, 11, 4), None)


def test_rows_after_as_of_change_nothing(spark):
    rows = [("a", "S", "1", -1, "2001-11-01"), ("b", "S", "1", 3, "2001-11-04")]
    later = [("a", "S", "1", 9, "2031-01-01")]
    for days, latest in ((None, None), (30, None), (None, D("2001-11-04"))):
        one, two = (sorted(map(tuple, inventory.current_inventory(snaps(spark, r), P, days, latest=latest).collect()))
                    for r in (rows, rows + later))
        assert one == two and one
    assert inventory.current_inventory(snaps(spark, rows), P, latest=D("2031-01-01")).count() == 0
    count = inventory.latest_snapshot_count(snaps(spark, rows + later), P).first()
    assert tuple(count) == (dt.date(2001, 11, 4), 1)


def test_negative_stock_excludes_internal_vendor(spark):
    p = P
    df = snaps(spark, [("v1", "", "1", -4, "2001-11-04"), ("v2", "X", "1", -1, "2001-11-04"), ("v3", "Y", "1", 5, "2001-11-04")])
    variants = spark.createDataFrame([("v1", "p1", "SKU1", "t1", 1.0, "i1"), ("v2", "p2", "SKU2", "t2", 1.0, "i2"),
                                      ("v3", "p3", "SKU3", "t3", 1.0, "i3")], schemas.VARIANTS)
    products = spark.createDataFrame([("p1", "P1", "Acme", "ACTIVE", None, None), ("p2", "P2", "Brand#1", "ACTIVE", None, None),
                                      ("p3", "P3", "Acme", "ACTIVE", None, None)], schemas.PRODUCTS)
    rows = inventory.negative_stock(df, variants, products, p).collect()
    assert [(r.variant_id, r.raw_stock, r.sku, r.vendor_name) for r in rows] == [("v1", -4, "SKU1", "Acme")]
