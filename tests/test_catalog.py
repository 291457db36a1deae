import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import views
from shelfcast.sources import catalog, store

from conftest import D, TS

TABLE = "sales_history_raw"


def sale(spark, rows):
    return spark.createDataFrame([(sid, "o", "#o", "v", "s", "t", q, D(d), TS(d + " 10:00:00"), "ven", None) for sid, q, d in rows],
                                 schemas.SALES_HISTORY)


def state(df):
    return sorted((r.sale_id, r.quantity_sold, str(r.sale_date)) for r in df.collect())


@pytest.fixture
def fact(spark, tmp_path):
    db = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}/db'")
    yield f"{db}.{TABLE}", str(tmp_path / "fact")
    spark.sql(f"DROP DATABASE {db} CASCADE")


FIRST = [("a", 1, "2001-11-01"), ("b", 2, "2001-11-02"), ("c", 3, "2001-11-03"), ("old", 9, "2001-01-01")]
BATCH = [("a", 10, "2001-11-01"), ("d", 4, "2001-11-03"), ("e", 5, "2001-11-04")]
MERGED = [("a", 10, "2001-11-01"), ("b", 2, "2001-11-02"), ("c", 3, "2001-11-03"), ("d", 4, "2001-11-03"), ("e", 5, "2001-11-04"), ("old", 9, "2001-01-01")]


def test_upsert_is_the_bounded_merge_and_names_its_dates(spark, fact):
    name, root = fact
    assert not catalog.exists(spark, name) and catalog.version(spark, name) == 0
    catalog.create(spark, name, TABLE, root, sale(spark, FIRST))
    done = catalog.upsert(spark, name, TABLE, root, sale(spark, BATCH))
    assert done.dates == ("2001-11-01", "2001-11-02", "2001-11-03", "2001-11-04") and done.dropped == 0
    assert state(spark.table(name)) == MERGED
    assert catalog.partition_dates(spark, name) == ["2001-01-01", "2001-11-01", "2001-11-02", "2001-11-03", "2001-11-04"]
    assert catalog.upsert(spark, name, TABLE, root, sale(spark, [])).dates == () and catalog.version(spark, name) == 2
    assert catalog.expire(spark, name, TABLE, root, dt.date(2001, 11, 5), 100) == ["2001-01-01"]
    assert state(spark.table(name)) == [r for r in MERGED if r[0] != "old"]
    catalog.upsert(spark, name, TABLE, root, sale(spark, [("f", 1, "2001-11-04")]))
    assert catalog.version(spark, name) == 4 and not store.table_exists(spark, f"{root}/_versions/n=2")
    assert store.table_exists(spark, f"{root}/_versions/n=3")


def test_a_failure_at_any_step_leaves_the_old_version(spark, fact, monkeypatch):
    name, root = fact
    catalog.create(spark, name, TABLE, root, sale(spark, FIRST))
    before = state(spark.table(name))
    sql = type(spark).sql

    def fails_at(word):
        def run(self, text, *a, **k):
            if word in text:
                raise RuntimeError(word)
            return sql(self, text, *a, **k)
        return run

    class Killed(RuntimeError):
        pass

    poisoned = sale(spark, BATCH).withColumn("quantity_sold", F.when(F.col("sale_id") == "e", F.raise_error(F.lit("disk"))).otherwise(F.col("quantity_sold")))
    with pytest.raises(Exception, match="disk"):                                     # while the batch is read
        catalog.upsert(spark, name, TABLE, root, poisoned)
    write = store.write_fact

    def write_some(df, path, table, mode="overwrite"):                               # between two partitions
        write(df.filter("sale_date <= DATE '2001-11-02'"), path, table, mode)
        raise Killed()

    with monkeypatch.context() as m:
        m.setattr(store, "write_fact", write_some)
        with pytest.raises(Killed):
            catalog.upsert(spark, name, TABLE, root, sale(spark, BATCH))
    assert state(spark.table(name)) == before and catalog.version(spark, name) == 1
    for word in ("CREATE TABLE", "ADD PARTITION", "CREATE OR REPLACE VIEW"):
        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", fails_at(word))
            with pytest.raises(RuntimeError, match=word):
                catalog._register(spark, name, TABLE, root, 2, {"2001-11-01": f"{root}/v=1/sale_date=2001-11-01"})
        assert state(spark.table(name)) == before
    catalog.upsert(spark, name, TABLE, root, sale(spark, BATCH))                     # the next run starts over
    assert state(spark.table(name)) == MERGED


def test_attach_registers_the_newest_committed_version(spark, fact):
    name, root = fact
    catalog.create(spark, name, TABLE, root, sale(spark, FIRST))
    catalog.upsert(spark, name, TABLE, root, sale(spark, BATCH))
    other = name + "_again"
    assert catalog.attach(spark, other, TABLE, root) == 2 and state(spark.table(other)) == MERGED
    spark.range(1).selectExpr("'2001-11-09' AS date", "'nowhere' AS folder").write.parquet(f"{root}/_versions/n=3")
    store.delete_folder(spark, f"{root}/_versions/n=3/_SUCCESS")                     # a list whose write did not end
    assert catalog.attach(spark, other, TABLE, root) == 2
    assert catalog.attach(spark, name + "_none", TABLE, root + "-none") == 0


def test_reads_by_name_prune_partitions(spark, fact):
    name, root = fact
    catalog.create(spark, name, TABLE, root, sale(spark, FIRST))
    df = spark.table(name).filter("sale_date = DATE '2001-11-02'")
    assert state(df) == [("b", 2, "2001-11-02")] and len(df.inputFiles()) == 1


def test_moved_keys_are_listed_and_can_stop_an_upsert(spark, fact):
    name, root = fact
    rows = [(f"k{i}", 1, f"2001-0{1 + i % 9}-0{1 + i % 7}") for i in range(400)]
    catalog.create(spark, name, TABLE, root, sale(spark, rows + [("in", 1, "2001-11-02")]))
    staged = sale(spark, [(f"k{i}", 2, "2001-11-02") for i in range(0, 400, 25)] + [("in", 2, "2001-11-03"), ("new", 1, "2001-11-01"), ("new2", 1, "2001-11-03")])
    moved = store.moved_keys(spark.table(name), staged, "sale_id", "sale_date")
    assert sorted((r.sale_id, str(r.stored_date), str(r.staged_date)) for r in moved.collect()) == sorted(
        (k, d, "2001-11-02") for k, _, d in rows if int(k[1:]) % 25 == 0)
    with pytest.raises(ValueError, match="outside the batch"):
        catalog.upsert(spark, name, TABLE, root, staged, on_moved="error")
    assert catalog.version(spark, name) == 1
    assert store.moved_keys(spark.table(name), staged.limit(0), "sale_id", "sale_date").count() == 0
    catalog.upsert(spark, name, TABLE, root, staged)                                 # inserted again, as the bounded merge does
    assert spark.table(name).filter("sale_id = 'k25'").count() == 2


def test_the_filter_never_loses_a_key_and_drops_most_others(spark):
    keys = spark.range(0, 20_000, 4).selectExpr("CAST(id AS STRING) AS k")
    words, n = store.bloom_words(keys, "k", 5_000)
    hits = {int(r.k) for r in spark.range(20_000).selectExpr("CAST(id AS STRING) AS k").filter(store.may_contain(words, n, "k")).collect()}
    assert hits >= set(range(0, 20_000, 4)) and len(hits) < 5_000 + 300
    plan = spark.range(9).selectExpr("CAST(id AS STRING) AS k").filter(store.may_contain(words, n, "k"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_views_and_tables_by_name(spark, fact, tmp_path):
    db = fact[0].split(".")[0]
    products = spark.createDataFrame([("p1", "P", "ven", "ACTIVE", None, None), ("p2", "Q", "gone", "ACTIVE", None, None)], schemas.PRODUCTS)
    variants = spark.createDataFrame([("v1", "p1", "", "t", 1.0, "i1"), ("v2", "p2", "s2", "t", 1.0, "i2")], schemas.VARIANTS)
    status = spark.createDataFrame([("ven", None, None, None), ("gone", True, None, None)], schemas.VENDOR_STATUS)
    snapshots = spark.createDataFrame([(f"{v}{i}", v, "s", "1", q, 0, 0, D(d), None) for i, (v, q, d) in enumerate(
        [("v1", 5, "2001-11-01"), ("v1", -7, "2001-11-02"), ("v2", 3, "2001-11-02"), ("v9", 2, "2001-11-02")])], schemas.INVENTORY_SNAPSHOTS)
    catalog.create(spark, f"{db}.inventory_snapshots_raw", "inventory_snapshots_raw", str(tmp_path / "inv"), snapshots)
    for name, df in {"products": products, "variants": variants, "vendor_status": status}.items():
        df.write.parquet(str(tmp_path / name))
        catalog.add_table(spark, f"{db}.{name}", str(tmp_path / name))
    assert views.create_views(spark, db) == list(views.VIEW_SQL)
    assert [tuple(r) for r in spark.table(f"{db}.v_vendor_summary").collect()] == [("ven", 1, 0, 1)]
    assert sorted((r.variant_id, r.exception_type) for r in spark.table(f"{db}.v_inventory_exceptions").collect()) == [
        ("v1", "NEGATIVE_STOCK"), ("v9", "MISSING_VENDOR_MAPPING")]
    assert {r.table_name: r.is_view for r in catalog.tables(spark, db).collect()} == {
        "products": False, "variants": False, "vendor_status": False, "inventory_snapshots_raw": True} | {v: True for v in views.VIEW_SQL}
    assert [(r.table_name, str(r.partition_date)) for r in catalog.partitions(spark, {"inv": f"{db}.inventory_snapshots_raw"}).collect()] == [
        ("inv", "2001-11-01"), ("inv", "2001-11-02")]
