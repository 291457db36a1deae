"""The hand-off documents: split reading, positions, refused layouts."""

import json

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import document, store

ROWS = {
    "products": [{"product_id": f"p{i}", "title": 'a "}, {" \\ \n    } ü' if i % 3 else "", "vendor": None} for i in range(40)],
    "variants": [{"variant_id": f"v{i}", "product_id": f"p{i % 40}", "sku": "], [", "price": 1.5} for i in range(70)],
    "locations": [{"location_id": "l1", "name": '"sales": [', "active": True}],
    "inventory": [],
    "sales": [{"sale_id": f"s{i}", "variant_id": f"v{i % 70}", "quantity_sold": i, "sale_date": "2024-03-01"} for i in range(300)],
}


def _write(folder, name, content, **layout):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(content, **layout), encoding="utf-8")


def _read(spark, folder, tmp_path):
    return document.read_documents(spark, str(folder), str(tmp_path / "work"))


def _rows(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("block", [200, 1 << 27])
def test_document_cut_anywhere_gives_its_rows(spark, tmp_path, block):
    _write(tmp_path / "in", "sync.json", ROWS, indent=2, ensure_ascii=False)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        if block == 200:
            assert document._pieces(spark, str(tmp_path / "in")).rdd.getNumPartitions() > 50
        back = _read(spark, tmp_path / "in", tmp_path)
        got = {name: df.collect() for name, df in back.items()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {n: len(r) for n, r in got.items()} == {n: len(r) for n, r in ROWS.items()}
    titles = {r["product_id"]: r["title"] for r in got["products"]}
    assert titles == {r["product_id"]: r["title"] for r in ROWS["products"]}
    assert sorted(r["quantity_sold"] for r in got["sales"]) == list(range(300))
    assert got["locations"][0]["name"] == '"sales": ['


def test_several_documents_with_missing_and_empty_arrays(spark, tmp_path):
    _write(tmp_path / "in", "a.json", {"sales": ROWS["sales"][:3], "products": ROWS["products"][:2]}, indent=2)
    _write(tmp_path / "in", "b.json", {"products": [], "sales": ROWS["sales"][3:7]}, indent=2)
    _write(tmp_path / "in", "c.json", {"products": [], "sales": []}, indent=2)
    back = _read(spark, tmp_path / "in", tmp_path)
    assert sorted(_rows(back["sales"], "sale_id")) == [f"s{i}" for i in range(7)]
    assert sorted(_rows(back["products"], "product_id")) == ["p0", "p1"]
    assert back["variants"].count() == 0


@pytest.mark.parametrize("spoil", [lambda t: t[:len(t) // 2], lambda t: json.dumps(json.loads(t)),
                                   lambda t: t[:t.rindex('"quantity_sold"')].rstrip(" ,\n"), lambda t: ""])
def test_cut_or_compact_document_is_refused(spark, tmp_path, spoil):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "sync.json").write_text(spoil(json.dumps(ROWS, indent=2)))
    with pytest.raises(ValueError, match="documents"):
        _read(spark, folder, tmp_path)


def test_row_of_a_wrong_type_fails(spark, tmp_path):
    _write(tmp_path / "in", "sync.json", {"sales": [{"sale_id": "s", "quantity_sold": "many"}]}, indent=2)
    with pytest.raises(Exception, match="MALFORMED"):
        _read(spark, tmp_path / "in", tmp_path)["sales"].collect()


def test_written_documents_are_json_and_come_back(spark, tmp_path):
    tables = {name: spark.createDataFrame([], store.table_schema(t)) for name, t in store.SYNC_TABLES.items()}
    tables["sales"] = (spark.range(500).select(F.concat(F.lit("s"), "id").alias("sale_id"), F.lit('}\n    }"').alias("sku"),
                                               F.col("id").alias("quantity_sold")))
    tables["products"] = spark.range(30).select(F.concat(F.lit("p"), "id").alias("product_id"))
    document.write_documents(tables, str(tmp_path / "out"), rows_per_document=100)
    files = [p for p in (tmp_path / "out").rglob("part-*.txt")]
    parsed = [json.loads(p.read_text()) for p in files]
    assert len(files) == 6 and sum(len(p.get("sales", [])) for p in parsed) == 500
    back = document.read_documents(spark, str(tmp_path / "out"), str(tmp_path / "work"))
    assert back["products"].count() == 30
    assert back["sales"].select(F.sum("quantity_sold"), F.count_distinct("sale_id"), F.max("sku")).first()[:] == (124750, 500, '}\n    }"')
