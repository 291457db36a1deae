import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shelfcast.sources.testdata import FIXTURE_PARAMS as P
from shelfcast.plans.daily import daily_load
from shelfcast.sources import testdata_pages as pages
from shelfcast.sources.testdata import Fixture
from shelfcast.streaming.ingest import ingest_sales

SF = "/root/testdata/sf0.001"
SINCE = dt.datetime(2001, 10, 1)    # incremental window, as the daily sync uses


def _land(df, path):
    df.select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def test_daily_load_round_trip(spark, tmp_path):
    f = Fixture(spark, SF, "bt", P)
    land = str(tmp_path / "landing")
    _land(pages.product_pages(f), f"{land}/products")
    _land(pages.location_pages(f), f"{land}/locations")
    _land(pages.inventory_pages(f), f"{land}/inventory")
    _land(pages.order_pages(f), f"{land}/orders")
    out = str(tmp_path / "store")
    rep = daily_load(spark, land, out, since=SINCE, on_duplicate="latest")
    assert rep["products"] and rep["variants"] and rep["inventory_snapshots_raw"].partitions == 3
    assert rep["sales_history_raw"].partitions > 3 and rep["rejects"] == {}
    stored = spark.read.parquet(f"{out}/sales_history_raw")
    expected = f.sales.join(f.order_flags, F.col("order_id") == F.col("o_orderkey").cast("string")) \
        .filter(~F.col("test") & ~F.col("cancelled") & (F.col("sale_date") >= F.lit("2001-09-30").cast("date"))) \
        .select("sale_id").distinct().count()
    assert stored.select("sale_id").distinct().count() == expected
    # loading the same pages again changes nothing (idempotent upsert)
    n1 = stored.count()
    daily_load(spark, land, out, since=SINCE, on_duplicate="latest")
    assert spark.read.parquet(f"{out}/sales_history_raw").count() == n1


def _lines(path, lines):
    os.makedirs(path)
    with open(f"{path}/part.json", "w") as f:
        f.writelines(x + "\n" for x in lines)


def _order_page(oid, created, quantity=1, page=1):
    line = {"id": "gid://x/LineItem/1", "title": "t", "sku": "S", "quantity": quantity,
            "variant": {"id": "gid://x/ProductVariant/9", "product": {"vendor": "V"}}}
    order = {"id": f"gid://x/Order/{oid}", "name": f"#{oid}", "createdAt": created, "test": False,
             "lineItems": {"edges": [{"node": line}]}}
    return json.dumps({"page": page, "data": {"orders": {"edges": [{"node": order}]}}})


def test_bad_pages_are_rejected_and_counted(spark, tmp_path):
    land, out = str(tmp_path / "landing"), str(tmp_path / "store")
    good = _order_page(1, "2001-11-01T10:00:00Z")
    _lines(f"{land}/orders", [good, good[:-20], _order_page(2, "yesterday"), _order_page(3, "2001-11-01T10:00:00Z", "two"), ""])
    for kind in ("products", "locations", "inventory"):
        _lines(f"{land}/{kind}", [])
    with pytest.raises(ValueError, match="'orders': 3"):
        daily_load(spark, land, out)
    assert not os.path.exists(f"{out}/sales_history_raw")
    rep = daily_load(spark, land, out, on_reject="quarantine")
    assert rep["rejects"] == {"orders": 3}
    assert [r.sale_id for r in spark.read.parquet(f"{out}/sales_history_raw").collect()] == ["1_1"]
    reasons = sorted(r.reason for r in spark.read.parquet(f"{out}/rejects").collect())
    assert reasons == ["not the page schema", "not the page schema", "unreadable instant"]


def test_only_new_days_are_read(spark, tmp_path):
    land, out = str(tmp_path / "landing"), str(tmp_path / "store")
    for kind in ("products", "locations", "inventory"):
        _lines(f"{land}/{kind}/day=2001-11-01", [])
    _lines(f"{land}/orders/day=2001-11-01", [_order_page(1, "2001-11-01T10:00:00Z")])
    assert daily_load(spark, land, out)["days"] == ["2001-11-01"]
    assert daily_load(spark, land, out) == {"days": []}
    _lines(f"{land}/orders/day=2001-11-02", [_order_page(2, "2001-11-02T10:00:00Z")])
    rep = daily_load(spark, land, out)
    assert rep["days"] == ["2001-11-02"] and rep["sales_history_raw"] == (1, 0)
    assert spark.read.parquet(f"{out}/sales_history_raw").count() == 2


def _add(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.writelines(x + "\n" for x in lines)


def _product_page(title, pid=1, page=1):
    node = {"id": f"gid://x/Product/{pid}", "title": title, "vendor": "V", "status": "ACTIVE", "createdAt": "2001-01-01T00:00:00Z",
            "updatedAt": "2001-01-01T00:00:00Z",
            "variants": {"edges": [{"node": {"id": f"gid://x/ProductVariant/{pid}", "sku": "S", "title": title, "price": "1"}}]}}
    return json.dumps({"page": page, "data": {"products": {"edges": [{"node": node}]}}})


def test_late_pages_of_a_read_day(spark, tmp_path):
    land, out = str(tmp_path / "landing"), str(tmp_path / "store")
    read = lambda name, col: sorted(r[col] for r in spark.read.parquet(f"{out}/{name}").collect())
    day = "day=2001-11-02"
    _add(f"{land}/orders/{day}", "a", [_order_page(1, "2001-11-02T10:00:00Z"), _order_page(2, "bad")])
    _add(f"{land}/products/{day}", "a", [_product_page("first")])
    assert daily_load(spark, land, out, on_reject="quarantine")["rejects"] == {"orders": 1}
    # a page put aside lands again, corrected, in the day that was read; products are listed again, with one more
    _add(f"{land}/orders/{day}", "b", [_order_page(2, "2001-11-02T11:00:00Z")])
    _add(f"{land}/products/{day}", "b", [_product_page("second"), _product_page("other", pid=2, page=2)])
    os.utime(f"{land}/products/{day}/a.json", (1e9, 1e9 - 60))
    rep = daily_load(spark, land, out)
    assert rep["days"] == ["2001-11-02"] and rep["rejects"] == {}
    assert read("sales_history_raw", "sale_id") == ["1_1", "2_1"]
    assert read("products", "title") == read("variants", "title") == ["other", "second"]
    # an older day that lands late brings its sales, and not its products
    _add(f"{land}/orders/day=2001-11-01", "a", [_order_page(3, "2001-11-01T10:00:00Z")])
    _add(f"{land}/products/day=2001-11-01", "a", [_product_page("older")])
    assert daily_load(spark, land, out)["days"] == ["2001-11-01"]
    assert read("sales_history_raw", "sale_id") == ["1_1", "2_1", "3_1"]
    assert read("products", "title") == ["other", "second"]
    assert daily_load(spark, land, out) == {"days": []}


def test_streaming_ingest_upserts_each_file_once(spark, tmp_path):
    f = Fixture(spark, SF, "bt", P)
    land, target, ckpt = str(tmp_path / "orders"), str(tmp_path / "sales"), str(tmp_path / "ckpt")
    allp = pages.order_pages(f).cache()
    first = allp.limit(3)
    _land(first, f"{land}/batch1")
    q = ingest_sales(spark, f"{land}/*", target, ckpt, since=SINCE, on_duplicate="latest")
    q.awaitTermination(120)
    n1 = spark.read.parquet(target).count()
    assert n1 > 0
    _land(allp, f"{land}/batch2")          # overlaps batch1: upsert, not duplicate
    q = ingest_sales(spark, f"{land}/*", target, ckpt, since=SINCE, on_duplicate="latest")
    q.awaitTermination(120)
    n2 = spark.read.parquet(target).count()
    assert n2 >= n1
    q = ingest_sales(spark, f"{land}/*", target, ckpt, since=SINCE, on_duplicate="latest")   # nothing new
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == n2
    allp.unpersist()


def test_streamed_bad_pages_are_rejects(spark, tmp_path):
    land, target = str(tmp_path / "orders"), str(tmp_path / "sales")
    good, late = _order_page(1, "2001-11-01T10:00:00Z"), _order_page(2, "2001-11-02T10:00:00Z")
    _lines(f"{land}/a", [good, good[:len(good) // 2], "", _order_page(3, "yesterday")])
    _lines(f"{land}/b", [late])
    q = ingest_sales(spark, f"{land}/*", target, str(tmp_path / "c1"))
    with pytest.raises(StreamingQueryException, match="rejected pages"):
        q.awaitTermination(120)
    assert not os.path.exists(target)
    q = ingest_sales(spark, f"{land}/*", target, str(tmp_path / "c2"), on_reject="quarantine", max_files_per_trigger=1)
    q.awaitTermination(120)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 2       # one file a micro-batch
    assert sorted(r.order_id for r in spark.read.parquet(target).collect()) == ["1", "2"]
    bad = spark.read.parquet(f"{target}_rejects").collect()
    assert sorted(r.reason for r in bad) == ["not the page schema", "unreadable instant"]


def test_ledger_by_day_and_rejects_of_a_load_run_again(spark, tmp_path, monkeypatch):
    from shelfcast.sources import store

    land, out = str(tmp_path / "landing"), str(tmp_path / "store")
    for kind in ("products", "locations", "inventory"):
        os.makedirs(f"{land}/{kind}")
    good = _order_page(1, "2001-11-01T10:00:00Z")
    _lines(f"{land}/orders/day=2001-11-01", [good, "{"])
    upsert = store.upsert_partitions
    monkeypatch.setattr(store, "upsert_partitions", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        daily_load(spark, land, out, on_reject="quarantine")
    monkeypatch.setattr(store, "upsert_partitions", upsert)
    assert daily_load(spark, land, out, on_reject="quarantine")["rejects"] == {"orders": 1}
    assert spark.read.parquet(f"{out}/rejects").count() == 1                   # not once a try
    assert [n for n in os.listdir(f"{out}/_files_read") if n.startswith("day=")] == ["day=2001-11-01"]
    assert daily_load(spark, land, out) == {"days": []}
    _lines(f"{land}/orders/day=2001-11-01/late", [_order_page(2, "2001-11-01T11:00:00Z")])
    assert daily_load(spark, land, out)["days"] == ["2001-11-01"]
    assert spark.read.parquet(f"{out}/sales_history_raw").count() == 2
    assert spark.read.parquet(f"{out}/_files_read").count() == 2


def test_weekly_run_writes_outputs_and_views(spark, tmp_path):
    from shelfcast.plans.weekly import from_fixture

    f = Fixture(spark, SF, "bt", P)
    run = from_fixture(f, P)
    paths = run.write_all(str(tmp_path / "out"))
    assert set(paths) >= {"model_quality_flags", "demand_forecasts", "vendor_restocks_weekly", "stockout_predictions"}
    flags = spark.read.parquet(paths["model_quality_flags"])
    assert flags.count() > 0
    assert set(run.register_views()) == {"current_inventory", "v_active_vendors", "v_variant_vendor_map",
                                         "v_current_inventory_active", "v_vendor_restocks_weekly_active",
                                         "v_vendor_summary", "v_inventory_exceptions"}
    assert spark.sql("SELECT count(*) FROM v_vendor_summary").first()[0] > 0
    import os

    local = run.work_dir.replace("file:", "", 1)
    assert os.path.isdir(local)
    run.cleanup()
    assert not os.path.exists(local)


def test_cli_weekly_over_a_store(spark, tmp_path):
    from shelfcast import cli
    from shelfcast.sources import store

    f = Fixture(spark, SF, "bt", P)
    st = str(tmp_path / "store")
    for name, df in (("variants", f.variants), ("products", f.products), ("vendors", f.vendors_existing),
                     ("vendor_status", f.vendor_status_existing)):
        df.write.parquet(f"{st}/{name}")
    recent = f.sales_table().filter(F.col("sale_date") >= F.lit("2000-10-01").cast("date"))
    store.write_fact(recent, f"{st}/sales_history_raw", "sales_history_raw")
    store.write_fact(f.inventory, f"{st}/inventory_snapshots_raw", "inventory_snapshots_raw")
    args = cli.argparse.Namespace(store=st, out=str(tmp_path / "out"), as_of=P.as_of.isoformat(), internal_vendor=["Brand#1"])
    paths = cli._weekly(spark, args)
    assert spark.read.parquet(paths["vendor_restocks_weekly"]).count() > 0
    assert {"negative_stock_skus", "model_kpis", "proof_series", "views/v_vendor_summary",
            "vendor_restock_cadence_one_time"} <= set(paths)
    assert any(n.startswith("sale_date=") for n in os.listdir(paths["sales_daily"]))
    read = lambda name: sorted(map(tuple, spark.read.parquet(f"{st}/{name}").collect()), key=repr)
    first = {name: read(name) for name in ("vendors", "vendor_status", "vendor_restock_cadence_one_time")}
    assert len(first["vendors"]) > f.vendors_existing.count()
    # a later run keeps ids, status and the frozen cadence
    args.as_of = (P.as_of - dt.timedelta(days=28)).isoformat()
    args.out = str(tmp_path / "out2")
    again = cli._weekly(spark, args)
    assert "vendor_restock_cadence_one_time" not in again
    assert {name: read(name) for name in first} == first
