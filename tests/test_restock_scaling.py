"""The restock list's steps at scale: forecasts never shuffled, snapshots derived once, rounding without decimal digits."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.functions.semantics import round_to_long
from shelfcast.operators import forecast, holidays
from shelfcast.plans.weekly import from_fixture
from shelfcast.session import apply_runtime_conf
from shelfcast.sources.testdata import FIXTURE_PARAMS as P
from shelfcast.sources.testdata import Fixture

DAY = dt.timedelta(days=1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _demand(spark):
    """Training rows (a busy and a sparse series, one day alone), their model, effects and calendar."""
    end = dt.date(2001, 11, 4)
    rows = [("busy", end - i * DAY, 3 + i % 7 + (20 if (end - i * DAY).month == 7 else 0)) for i in range(340)]
    rows += [("sparse", d, 5) for d in (dt.date(2000, 11, 23), dt.date(2000, 12, 25), dt.date(2001, 1, 1), dt.date(2001, 10, 20))]
    rows += [("alone", dt.date(2001, 7, 4), 9)]
    train = spark.createDataFrame(rows, "variant_id string, sale_date date, qty_sold bigint")
    model, calendar = forecast.fit_demand_model(train), holidays.run_calendar(spark, P)
    return train, model, holidays.holiday_effects(train, model, "variant_id", "sale_date", "qty_sold", calendar), calendar


def test_forecasts_are_not_shuffled_to_meet_holidays(spark):
    _, model, effects, calendar = _demand(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(forecast.demand_forecasts(model, P, holiday_effects=effects, calendar=calendar))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    after = plan.split("Generate explode")[0]
    assert "Exchange" not in after and "Join" not in after


def test_holiday_shifts_equal_a_join_by_holiday(spark):
    _, model, effects, calendar = _demand(spark)
    plain = forecast.forecast(model, "variant_id", P.forecast_horizon_days, 1, P.z_value).collect()
    shift, names = {(r[0], r[1]): r[2] for r in effects.collect()}, {r.holiday_date: r.holiday for r in calendar.collect()}
    want = {}
    for r in plain:
        e = shift.get((r.variant_id, names.get(r.forecast_ts)), 0.0)
        if r.forecast_value + e > 0:
            want[r.variant_id, r.forecast_ts] = max(0, int(abs(r.forecast_value + e) + 0.5))
    got = {(r.variant_id, r.forecast_date): r.predicted_qty
           for r in forecast.demand_forecasts(model, P, holiday_effects=effects, calendar=calendar).collect()}
    assert got == want and any(shift.get((v, names.get(d))) for v, d in want)


def test_holiday_effects_by_hand(spark):
    train, model, effects, calendar = _demand(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(effects)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.split("Generate explode")[0].count("Exchange hashpartitioning") <= 1     # days stay where their series is
    sold = {(r[0], r[1]): r[2] for r in train.collect()}
    want = {}
    for m in model.collect():
        first = m.last_ts - (m.n - 1) * DAY
        for c in calendar.collect():
            if first <= c.holiday_date <= m.last_ts:
                fit = m.intercept + m.slope * (c.holiday_date - first).days if m.slope is not None else m.y_mean
                weekday = ((c.holiday_date - dt.date(1970, 1, 1)).days) % 7
                off = getattr(m, f"season_w{weekday}") or 0.0
                want.setdefault((m.variant_id, c.holiday), []).append(sold.get((m.variant_id, c.holiday_date), 0) - fit - off)
    got = {(r.variant_id, r.holiday): r.holiday_effect for r in effects.collect()}
    assert got.keys() == want.keys() and len(got) > 15
    assert all(abs(got[k] - sum(v) / len(v)) < 1e-9 for k, v in want.items())


def test_snapshots_are_derived_once(spark, tmp_path):
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    table("part", [(1, "Brand#2", "LARGE", 10.0), (2, "Brand#3", "SMALL", 5.0), (3, "Brand#3", "TINY", None)],
          "p_partkey bigint, p_brand string, p_type string, p_retailprice double")
    table("lineitem", [(1, 1, 1, 1, 2.0, dt.datetime(2001, 10, 1)), (1, 1, 1, 1, 2.0, dt.datetime(2001, 10, 1)),
                       (2, 1, 2, 1, 1.0, dt.datetime(2001, 10, 2)), (3, 2, 2, 1, 1.0, dt.datetime(2001, 10, 3)),
                       (4, None, 2, 1, 1.0, dt.datetime(2001, 10, 3))],
          "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz")
    table("supplier", [(1, 1), (2, 2)], "s_suppkey bigint, s_nationkey bigint")
    table("nation", [(1, 0), (2, 3)], "n_nationkey bigint, n_regionkey bigint")
    f = Fixture(spark, str(tmp_path), "part", P)
    run = from_fixture(f, P)
    try:
        assert run.newest_day == dt.date(2001, 11, 4)
        assert run.snapshots.inputFiles() and not any("lineitem" in x for x in run.snapshots.inputFiles())
        assert sorted(run.snapshots.collect()) == sorted(f.inventory.collect()) and run.snapshots.count() == 9
        assert {r.variant_id: r.raw_stock for r in run.current.collect()} == {"1": 17 + 50 - 60, "2": (2 * 37 + 33 + 5) % 60 - 25}
    finally:
        run.cleanup()


def test_rounding_goes_by_digits_only_near_a_half(spark):
    values = [2.5, -2.5, 0.5, -0.5, 0.49999999, 0.4999999, 1.500001, -1.49999999, 7.0, -0.3, 0.0, -7.6, 1e9 + 0.5, -3e12 - 0.5,
              123456789.4999999, 123456789.5, 4.9e17, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = df.select(round_to_long("v").alias("new"), F.round(F.round("v", 6), 0).cast("bigint").alias("old"))
    assert "FLOOR" in _plan(out) and all(r.new == r.old for r in out.collect())


def test_long_generated_methods_are_left_to_smaller_ones(spark):
    apply_runtime_conf(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
