import dataclasses
import datetime as dt
import random
import re

import pytest

from shelfcast import schemas
from shelfcast.operators import demand, incremental
from shelfcast.params import Params
from shelfcast.sources import store

from conftest import TS

AS_OF = dt.date(2001, 11, 7)
P0 = Params(as_of=AS_OF, run_ts=dt.datetime(2001, 11, 7), internal_vendors=())
P0 = dataclasses.replace(P0, sales_lookback_days=30)


def sales(spark, rows):
    return spark.createDataFrame([(i, "o", "#o", v, "s" + v, "t", q, d, TS(f"{d} 10:00:00"), "ven", None) for i, v, q, d in rows], schemas.SALES_HISTORY)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_three_batches_with_corrections_late_days_and_a_moving_window(spark, tmp_path):
    rng = random.Random(1)
    path, daily, weekly, priced = (str(tmp_path / n) for n in ("sales", "daily", "weekly", "priced"))
    variants = spark.createDataFrame([(f"v{i}", "p", "s", "t", i + 0.5, "i") for i in range(4)], schemas.VARIANTS)
    vmap = spark.createDataFrame([("v0",), ("v1",), ("v1",), ("v2",)], "variant_id string")
    day = lambda n: AS_OF + dt.timedelta(days=n)
    stored = lambda at, name: spark.read.schema(store.table_schema(name)).parquet(at)
    history = [(f"h{n}", f"v{rng.randrange(5)}" if n % 9 else "", rng.randrange(1, 9), day(-rng.randrange(45))) for n in range(300)]
    batches = [(0, history),
               (3, [(i, v, q + 1, d) for i, v, q, d in history[::7] if d > day(-10)] + [("n1", "v1", 4, day(2)), ("n2", "v9", 1, day(3))]),
               (7, [("late", "v2", 5, day(-8)), ("n3", "v0", 2, day(7))]),
               (16, [("n4", "v1", 3, day(15)), ("n5", "", 3, day(16))])]
    for n, (shift, batch) in enumerate(batches):
        p = dataclasses.replace(P0, as_of=day(shift))
        done = store.upsert_partitions(spark, path, "sales_history_raw", sales(spark, batch))
        facts = stored(path, "sales_history_raw")
        dates = done.dates if n else None
        changed = incremental.refresh_daily(spark, facts, daily, dates, p)
        incremental.refresh_daily(spark, facts, priced, dates, p, variants)
        incremental.refresh_weekly(spark, stored(daily, "sales_daily"), vmap, weekly, changed, p)
        assert (changed is None) == (n == 0)
        cols = ["sale_date", "variant_id", "sku", "qty_sold"]
        full = demand.sales_daily_validation(facts, p)
        assert rows_of(stored(daily, "sales_daily").select(*cols)) == rows_of(full.select(*cols))
        assert rows_of(stored(priced, "sales_daily").select(*cols, "gross_revenue")) == rows_of(demand.sales_daily(facts, variants, p).select(*cols, "gross_revenue"))
        week = ["week_start", "variant_id", "sku", "qty_sold"]
        assert rows_of(stored(weekly, "sales_weekly").select(*week)) == rows_of(demand.sales_weekly(full, vmap, p).select(*week))


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "sales")
    store.write_fact(sales(spark, [(f"s{n}", "v", 1, AS_OF - dt.timedelta(days=n)) for n in range(20)]), path, "sales_history_raw")
    facts = spark.read.schema(store.table_schema("sales_history_raw")).parquet(path)
    touched = incremental._among(facts, "sale_date", {AS_OF, AS_OF - dt.timedelta(days=3)})
    scan = demand.sales_daily_validation(touched, P0)._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", scan).group(1)             # literal dates: no other folder is opened
    assert re.search(r"sale_date#\d+ IN \(2001-11-04,2001-11-07\)", filters) and touched.count() == 2


@pytest.mark.parametrize("dates", [[], ["1990-01-01"]])
def test_nothing_touched_changes_nothing(spark, tmp_path, dates):
    path, daily = str(tmp_path / "sales"), str(tmp_path / "daily")
    store.write_fact(sales(spark, [("s1", "v", 1, AS_OF)]), path, "sales_history_raw")
    facts = spark.read.schema(store.table_schema("sales_history_raw")).parquet(path)
    incremental.refresh_daily(spark, facts, daily, None, P0)
    before = store.data_files(spark, daily)
    assert incremental.refresh_daily(spark, facts, daily, dates, P0) == set()
    assert store.data_files(spark, daily) == before
