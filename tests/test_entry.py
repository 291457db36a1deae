import duckdb

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem documents embeddings benchmark labels".split()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "reorder_qty" in df.columns


def test_every_query_has_a_unique_name_and_most_have_oracles():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45


def test_sample_queries_match_oracle(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    for name in ("c11_current_inventory", "c22_sales_weekly", "c29_model_quality_flags", "c08_upsert_sales"):
        s = sorted(map(tuple, q[name](spark, SF).select(*sorted(q[name](spark, SF).columns)).collect()), key=repr)
        rel = con.sql(o[name])
        cols = sorted(rel.columns)
        d = sorted(map(tuple, con.sql(f"SELECT {', '.join(cols)} FROM ({o[name]})").fetchall()), key=repr)
        assert len(s) == len(d), name
        assert s == d, name


def test_all_oracles_plan_and_column_names_match(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    for name, sql in o.items():
        con.execute("EXPLAIN " + sql)                       # parses and plans, no execution
        cols = con.sql(f"SELECT * FROM ({sql}) LIMIT 0").columns
        if name.startswith(("c0", "c1", "c20", "c21", "c22", "c34", "c35", "c36", "c38", "c39")) and not name.endswith("_part"):
            assert sorted(cols) == sorted(q[name](spark, SF).columns), name
