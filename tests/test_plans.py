"""Plan checks: date predicates reach stored fact scans as partition filters."""

import datetime as dt

from shelfcast.operators import demand, restock, vendors
from shelfcast.sources.testdata import FIXTURE_PARAMS as P
from shelfcast.sources import store
from shelfcast.sources.testdata import Fixture

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_lines(plan: str, table: str) -> list[str]:
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "PartitionFilters: [isnotnull(sale_date" in ln]


def test_fact_reads_prune_partitions(spark, tmp_path):
    f = Fixture(spark, SF, "bt", P)
    path = str(tmp_path / "sales_history_raw")
    recent = f.sales_table().filter("sale_date >= DATE'2000-06-01'")       # keep the test write small
    store.write_fact(recent, path, "sales_history_raw")
    sales = spark.read.parquet(path)

    daily = demand.sales_daily(sales, f.variants, P)
    lines = scan_lines(plan_of(daily), "sales_history_raw")
    assert lines and all("PartitionFilters: [isnotnull(sale_date" in ln and "sale_date" in ln and ">= 2000-11-05" in ln
                         for ln in lines), lines
    assert all("ReadSchema: struct<variant_id:string,sku:string,quantity_sold:bigint>" in ln for ln in lines), lines

    fb = restock.fallback_demand(sales, P)
    assert all(">= 2001-09-10" in ln for ln in scan_lines(plan_of(fb), "sales_history_raw"))

    rank = vendors.vendor_sales_rank(sales, f.variants, f.products, P)
    assert all(">= 2001-05-05" in ln for ln in scan_lines(plan_of(rank), "sales_history_raw"))

    ranged = store.read_fact(spark, path, "sales_history_raw", dt.date(2001, 10, 1), dt.date(2001, 10, 31))
    assert all("<= 2001-10-31" in ln for ln in scan_lines(plan_of(ranged), "sales_history_raw"))
