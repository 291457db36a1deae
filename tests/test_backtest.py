import datetime as dt

from shelfcast import schemas
from shelfcast.operators import backtest
from shelfcast.params import Params

P = Params(as_of=dt.date(2001, 11, 5))   # last complete week 2001-10-29, cutoff 2001-10-01


def weekly(spark, rows):
    return spark.createDataFrame([(v, dt.date.fromisoformat(w), "s", q) for v, w, q in rows],
                                 "variant_id string, week_start date, sku string, qty_sold bigint")


def test_guard_empties_every_output_with_schema(spark):
    # holdout sales but no positive training rows
    out = backtest.run_backtest(weekly(spark, [("a", "2001-10-08", 5), ("a", "2001-09-24", 0)]), P)
    for name, df in out.items():
        assert df.count() == 0, name
    assert out["model_quality_flags"].schema.fieldNames() == schemas.MODEL_QUALITY_FLAGS.fieldNames()
    assert out["backtest_metrics_variant_4w"].schema.fieldNames() == schemas.BACKTEST_METRICS.fieldNames()


def test_metrics_baseline_and_labels(spark):
    P2 = P
    fc = spark.createDataFrame([("a", dt.date(2001, 10, 1), 4), ("a", dt.date(2001, 10, 8), 4),
                                ("b", dt.date(2001, 10, 8), 2)], "variant_id string, week_start date, predicted_qty bigint")
    w = weekly(spark, [("a", "2001-09-24", 1), ("a", "2001-10-01", 4), ("a", "2001-10-08", 4), ("a", "2001-10-22", 2),
                       ("b", "2001-10-15", 3), ("b", "2001-08-01", 1)])
    hold = backtest.holdout_with_baseline(w, P2)
    guard = backtest.has_training(w, P2)
    j = backtest.backtest_joined(hold, fc)
    scores = backtest.backtest_scores(j, guard)
    m = {r.variant_id: r for r in backtest.backtest_metrics(scores, P2).collect()}
    # a: actual 4,4,2 vs pred 4,4,0 -> error 2 / 10
    assert (m["a"].sum_actual, m["a"].sum_abs_error, m["a"].wape) == (10, 2, 0.2)
    assert m["b"].sum_abs_error == 5 and m["b"].mape == 1.0      # forecast-only week (actual 0) is not in MAPE
    b = {r.variant_id: r for r in backtest.backtest_baseline(scores).collect()}
    assert set(b) == {"a", "b"} and set(m) == {"a", "b"}
    # a baseline: 1->4 (3), 4->4 (0), week 10-15 missing -> 2 vs 0 (2) => 5/10
    assert b["a"].baseline_wape == 0.5 and b["a"].sum_actual_holdout == 10
    flags = {r.variant_id: r.model_quality for r in backtest.model_quality_flags(scores, P2).collect()}
    assert flags == {"a": "GOOD", "b": "NO_DATA"}


def test_label_thresholds(spark):
    m = spark.createDataFrame([(v, w, 10) for v, w in [("g", 0.60), ("w", 0.80), ("bad", 1.0001), ("wk", 0.81),
                                                           ("worse", 0.7), ("nodata", 0.5)]],
                              "variant_id string, wape double, sum_actual bigint")
    b = spark.createDataFrame([("g", 0.1, 10), ("w", 0.9, 10), ("bad", 2.0, 10), ("wk", None, 10), ("worse", 0.7, 10),
                               ("nodata", 0.1, 3)], "variant_id string, baseline_wape double, sum_actual_holdout bigint")
    got = {r.variant_id: r.model_quality for r in backtest.model_quality_flags(m.join(b, "variant_id"), P).collect()}
    assert got == {"g": "GOOD", "w": "GOOD", "bad": "BAD", "wk": "WEAK", "worse": "WORSE_THAN_BASELINE", "nodata": "NO_DATA"}


def test_inclusive_holdout_scores_the_newest_week_against_zero(spark):
    import dataclasses

    # training weeks before the cutoff, then a constant 5 units through the last complete week
    rows = [("a", str(dt.date(2001, 6, 4) + dt.timedelta(weeks=i)), 5) for i in range(22)]
    w = weekly(spark, rows)
    out = backtest.run_backtest(w, P)
    fc_weeks = sorted(str(r.week_start) for r in out["backtest_forecast_4w"].collect())
    assert fc_weeks == ["2001-10-01", "2001-10-08", "2001-10-15", "2001-10-22"]
    proof = {str(r.week_start): (r.actual_qty, r.predicted_qty) for r in out["backtest_proof_4w"].collect()}
    assert proof["2001-10-29"] == (5, 0)                      # Q1: 5th holdout week has no forecast
    m = out["backtest_metrics_variant_4w"].first()
    assert (m.sum_actual, m.sum_abs_error) == (25, 5)
    strict = backtest.run_backtest(w, dataclasses.replace(P, holdout_inclusive=False))
    ms = strict["backtest_metrics_variant_4w"].first()
    assert (ms.sum_actual, ms.sum_abs_error, ms.wape) == (20, 0, 0.0)   # WAPE(actual = pred) = 0


def test_stockout_from_as_of_option(spark):
    import dataclasses

    from shelfcast.operators import restock

    days = [P.as_of + dt.timedelta(days=i) for i in range(-3, 5)]
    fc = spark.createDataFrame([("a", d, 2) for d in days], "variant_id string, forecast_date date, predicted_qty bigint")
    cur = spark.createDataFrame([("a", 4)], "variant_id string, current_stock bigint")
    r = restock.stockout_predictions(fc, cur, P).first()
    assert r.days_remaining == -2                              # Q9: counts forecast days before as_of
    r2 = restock.stockout_predictions(fc, cur, dataclasses.replace(P, stockout_from_as_of=True)).first()
    assert r2.days_remaining == 1
