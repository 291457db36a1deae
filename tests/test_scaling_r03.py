"""Plans and files of the queries that grow with the order lines: one pass, narrow shuffles, packed pages."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators.forecast import to_quantity
from shelfcast.plans import catalog_store, catalog_tables
from shelfcast.plans.catalog import fx
from shelfcast.sources import document, store
from shelfcast.sources import testdata_pages as pages


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_tables_read_their_own_rows(spark, tmp_path, monkeypatch):
    seen, check = [], document._check
    monkeypatch.setattr(document, "_check", lambda pieces: (seen.append(pieces), check(pieces))[1])
    tables = {name: spark.createDataFrame([], store.table_schema(t)) for name, t in store.SYNC_TABLES.items()}
    tables["products"] = spark.range(30).select(F.concat(F.lit("p"), "id").alias("product_id"))
    document.write_documents(tables, str(tmp_path / "out"))
    back = document.read_documents(spark, str(tmp_path / "out"), str(tmp_path / "work"))
    assert len(seen) == 1 and back["products"].count() == 30
    assert all("/rows/" in f for f in back["products"].inputFiles())       # its own rows, not all pieces


def test_landed_pages_are_packed(spark):
    made = len(catalog_store._MADE)
    good = catalog_store._landed(fx(spark, SF_SMALL), "orders")
    files = [(p, n) for p, n, _ in store.data_files(spark, catalog_store._MADE[made])]
    text = good.select(F.sum(F.length(F.to_json(F.struct("page", "data"))))).first()[0]
    assert files and all(os.path.splitext(p)[1] == ".lz4" for p, _ in files)
    assert sum(n for _, n in files) * 3 < text


def test_order_lines_meet_flags_and_pages_in_one_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(pages.order_pages(fx(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # part and lines by part key, flags and lines by order key, lines by page: numbers are compared, titles come after the last one
    assert plan.count("Exchange hashpartitioning") == 5 and "SortMergeJoin [l_orderkey" in plan
    assert not any("product_title" in line for line in plan.splitlines() if "Exchange" in line or "Project" in line)


def test_quantity_rounds_once(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (None,), (0.4999999999,)], "v double")
    out = df.select(to_quantity("v").alias("q"))
    assert [r.q for r in out.collect()] == [3, 0, None, 1]
    assert _plan(out).split("Scan")[0].count("round(") == 2


def test_kept_up_batches_read_the_kept_history(spark, monkeypatch):
    seen, upsert = [], store.upsert_partitions
    monkeypatch.setattr(store, "upsert_partitions", lambda s, path, name, batch, **kw: (seen.append(batch.inputFiles()),
                                                                                         upsert(s, path, name, batch, **kw))[1])
    catalog_tables._kept_up(fx(spark, SF_SMALL), weekly=False)
    assert len(seen) == 3 and not any("lineitem" in path for files in seen for path in files)
