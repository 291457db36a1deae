import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.session import checkpoint_dir
from shelfcast.sources import store

from conftest import D, TS


def sale(spark, rows):
    full = [(sid, "o", "#o", "v", "s", "t", q, D(d), TS(d + " 10:00:00"), "ven", None) for sid, q, d in rows]
    return spark.createDataFrame(full, schemas.SALES_HISTORY)


def state(df):
    return sorted((r.sale_id, r.quantity_sold, str(r.sale_date)) for r in df.collect())


def test_upsert_semantics(spark):
    target = sale(spark, [("a", 1, "2001-11-02"), ("b", 2, "2001-11-02"), ("moved", 3, "2001-10-01"),
                          ("old", 9, "2001-09-01")])
    source = sale(spark, [("a", 10, "2001-11-03"), ("c", 4, "2001-11-03"), ("moved", 5, "2001-11-02")])
    out = store.upsert_sales(target, source)
    # a: updated, date kept from the stored row; b: untouched; c: inserted;
    # moved: stored outside the batch range [11-02, 11-03] -> inserted again (reference behaviour)
    assert state(out) == [("a", 10, "2001-11-02"), ("b", 2, "2001-11-02"), ("c", 4, "2001-11-03"),
                          ("moved", 3, "2001-10-01"), ("moved", 5, "2001-11-02"), ("old", 9, "2001-09-01")]
    assert state(store.upsert_sales(out, source)) == state(out)          # idempotent


def test_upsert_empty_batch_is_identity(spark):
    target = sale(spark, [("a", 1, "2001-11-01")])
    assert state(store.upsert_sales(target, target.limit(0))) == state(target)


def test_upsert_partitions_on_disk(spark, tmp_path):
    path = str(tmp_path / "sales")
    store.write_fact(sale(spark, [("a", 1, "2001-11-01"), ("b", 2, "2001-11-02"), ("x", 7, "2001-10-01")]),
                     path, "sales_history_raw")
    n = store.upsert_partitions(spark, path, "sales_history_raw",
                                sale(spark, [("a", 10, "2001-11-01"), ("c", 4, "2001-11-02")]))
    assert n == (2, 0)
    assert state(spark.read.parquet(path)) == [("a", 10, "2001-11-01"), ("b", 2, "2001-11-02"),
                                               ("c", 4, "2001-11-02"), ("x", 7, "2001-10-01")]
    again = store.upsert_partitions(spark, path, "sales_history_raw",
                                    sale(spark, [("a", 10, "2001-11-01"), ("c", 4, "2001-11-02")]))
    assert again.partitions == 2 and len(state(spark.read.parquet(path))) == 4
    assert store.upsert_partitions(spark, path, "sales_history_raw", sale(spark, [])) == (0, 0)
    with pytest.raises(ValueError):
        store.upsert_partitions(spark, path, "sales_history_raw",
                                sale(spark, [("a", 1, "2001-11-01"), ("a", 2, "2001-11-01")]))
    kept = store.upsert_partitions(spark, path, "sales_history_raw",
                                   sale(spark, [("a", 1, "2001-11-01"), ("a", 2, "2001-11-01")]), on_duplicate="latest")
    assert kept == (1, 1)                                   # the staged row given up is reported
    assert store.latest_partition(spark, path, "sale_date") == dt.date(2001, 11, 2)
    assert store.enforce_retention(spark, path, "sale_date", dt.date(2001, 11, 5), 30) == ["2001-10-01"]
    assert store.partition_values(spark, path, "sale_date") and "2001-10-01" not in store.partition_values(spark, path, "sale_date")


def test_upsert_in_a_plain_session_keeps_the_other_partitions(spark, tmp_path):
    """A caller's own session has static partition overwrite: the writer must not depend on it."""
    import os

    path = str(tmp_path / "sales")
    plain = spark.newSession()
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    store.write_fact(sale(plain, [("a", 1, "2001-11-01"), ("x", 7, "2001-10-01")]), path, "sales_history_raw")
    before = set(os.listdir(checkpoint_dir(plain).replace("file:", "")))
    store.upsert_partitions(plain, path, "sales_history_raw", sale(plain, [("c", 4, "2001-11-01")]))
    assert state(plain.read.parquet(path)) == [("a", 1, "2001-11-01"), ("c", 4, "2001-11-01"), ("x", 7, "2001-10-01")]
    assert set(os.listdir(checkpoint_dir(plain).replace("file:", ""))) == before        # no staging copy stays


def test_null_keys_fail_dimensions_and_staging(spark, tmp_path):
    locs = spark.createDataFrame([(None, "x", True)], "location_id string, name string, active boolean")
    with pytest.raises(Exception, match="NULL key"):
        store.write_dimension(locs, str(tmp_path / "l"), "locations")
    bad = sale(spark, [("a", 1, "2001-11-01")]).withColumn("sale_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NULL key"):
        store.stage(bad, str(tmp_path / "s"), "sales_history_stg")


def test_dedupe_keeps_first_in_total_order(spark):
    df = sale(spark, [("a", 5, "2001-11-01"), ("a", 3, "2001-11-01"), ("b", 1, "2001-11-02")])
    got = store.dedupe(df, "sale_id", ["quantity_sold"])
    assert state(got) == [("a", 3, "2001-11-01"), ("b", 1, "2001-11-02")]


def test_refresh_dimension_keeps_rows_on_empty_load(spark):
    cur = spark.createDataFrame([("1", "old", True)], schemas.LOCATIONS)
    new = spark.createDataFrame([("2", "new", False)], schemas.LOCATIONS)
    assert [r.name for r in store.refresh_dimension(cur, new.limit(0)).collect()] == ["old"]
    assert [r.name for r in store.refresh_dimension(cur, new).collect()] == ["new"]


def test_require_not_null(spark):
    df = spark.createDataFrame([(None, "x", True)], "location_id string, name string, active boolean")
    with pytest.raises(Exception):
        store.require_not_null(df, "locations").collect()
    assert store.conform(df.select("name"), "locations").columns == ["location_id", "name", "active"]


def test_replace_table_reading_itself(spark, tmp_path):
    from shelfcast.operators import vendors as vops
    from shelfcast.sources.testdata import FIXTURE_PARAMS as P

    path = str(tmp_path / "vendors")
    spark.createDataFrame([(3, "Old", None, None, None)], schemas.VENDORS).write.parquet(path)
    products = spark.createDataFrame([("p", "t", "New", "A", None, None)], schemas.PRODUCTS)
    current = spark.read.parquet(path)
    store.replace_table(vops.maintain_vendors(products, current, P), path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [(3, "Old", 5, 6, 6), (4, "New", 5, 6, 6)]
    assert store.table_exists(spark, path)
    import os
    assert sorted(os.listdir(tmp_path)) == ["vendors"]


def test_sync_tables_round_trip(spark, tmp_path):
    locs = spark.createDataFrame([("1", "A", True)], schemas.LOCATIONS)
    store.write_sync_tables({"locations": locs}, str(tmp_path / "sync"))
    back = spark.read.schema(schemas.LOCATIONS).json(str(tmp_path / "sync" / "locations"))
    assert [tuple(r) for r in back.collect()] == [("1", "A", True)]
