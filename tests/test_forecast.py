import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.operators import forecast


def series(spark, rows, step=1, start=dt.date(2001, 1, 1)):
    data = [("k", start + dt.timedelta(days=step * t), y) for t, y in rows]
    return spark.createDataFrame(data, "variant_id string, ts date, y bigint")


def fit(spark, rows, step=1):
    return forecast.fit_forecaster(series(spark, rows, step), "variant_id", "ts", "y", step).first()


def test_short_series_use_mean(spark):
    one = fit(spark, [(0, 5)])
    assert (one.model, one.n, one.sigma, one.y_mean) == ("mean", 1, 0.0, 5.0)
    two = fit(spark, [(0, 2), (1, 4)])
    assert two.model == "mean" and two.sigma == pytest.approx(2 ** 0.5)


def test_linear_trend_is_recovered_with_gaps(spark):
    # y = 3 + 2t observed on a weekly grid, one week missing (a zero week after regularisation)
    rows = [(t, 3 + 2 * t) for t in range(12) if t != 5]
    m = forecast.fit_forecaster(series(spark, rows, 7), "variant_id", "ts", "y", 7).first()
    assert m.n == 12
    full = [(t, (3 + 2 * t) if t != 5 else 0) for t in range(12)]
    ys = [y for _, y in full]
    n = len(ys)
    tbar, ybar = (n - 1) / 2, sum(ys) / n
    b = sum((t - tbar) * (y - ybar) for t, y in full) / sum((t - tbar) ** 2 for t, _ in full)
    assert m.slope == pytest.approx(b) and m.intercept == pytest.approx(ybar - b * tbar)


def test_exact_line_picks_trend_or_drift_and_extrapolates(spark):
    rows = [(t, 10 + 3 * t) for t in range(20)]
    m = fit(spark, rows)
    assert m.model in ("trend", "drift")
    fc = forecast.forecast(forecast.fit_forecaster(series(spark, rows), "variant_id", "ts", "y", 1),
                           "variant_id", 5, 1, 1.96).orderBy("forecast_ts").collect()
    assert [round(r.forecast_value, 6) for r in fc] == [10 + 3 * t for t in range(20, 25)]
    assert fc[0].forecast_ts == dt.date(2001, 1, 21)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=50), min_size=3, max_size=30), st.integers(1, 9))
def test_forecast_rows_and_interval_order(spark, ys, horizon):
    s = series(spark, list(enumerate(ys)))
    m = forecast.fit_forecaster(s, "variant_id", "ts", "y", 1)
    fc = forecast.forecast(m, "variant_id", horizon, 1, 1.959964).collect()
    assert len(fc) == horizon
    for r in fc:
        assert r.prediction_interval_lower_bound <= r.forecast_value <= r.prediction_interval_upper_bound


def test_constant_series_has_collapsed_interval(spark):
    m = fit(spark, [(t, 4) for t in range(10)])
    assert m.model in ("mean", "last") and m.sigma < 1e-3


def test_weekday_pattern_selects_season_and_recovers_offsets(spark):
    pattern = [5, 1, 1, 2, 9, 3, 1]
    rows = [(t, 10 + pattern[t % 7]) for t in range(8 * 7)]
    s = series(spark, rows)            # starts 2001-01-01
    m = forecast.fit_forecaster(s, "variant_id", "ts", "y", 1, season=True).first()
    assert m.model == "trend_season"
    epoch_wd0 = (dt.date(2001, 1, 1) - dt.date(1970, 1, 1)).days % 7
    mean_pat = sum(pattern) / 7
    for t in range(7):
        w = (epoch_wd0 + t) % 7
        assert getattr(m, f"season_w{w}") == pytest.approx(pattern[t] - mean_pat, abs=1e-6)
    fc = forecast.forecast(forecast.fit_forecaster(s, "variant_id", "ts", "y", 1, season=True), "variant_id", 7, 1, 1.96)
    got = [round(r.forecast_value, 6) for r in fc.orderBy("forecast_ts").collect()]
    assert got == [10 + pattern[t % 7] for t in range(56, 63)]


def test_regularize_policies_and_frequency(spark):
    s = spark.createDataFrame([("a", dt.date(2001, 1, 1), 2), ("a", dt.date(2001, 1, 4), 8), ("b", dt.date(2001, 1, 1), 5)],
                              "variant_id string, ts date, y bigint")
    z = {(r.variant_id, r.ts.day): r.y for r in forecast.regularize(s, "variant_id", "ts", "y", 1).collect()}
    assert z == {("a", 1): 2.0, ("a", 2): 0.0, ("a", 3): 0.0, ("a", 4): 8.0, ("b", 1): 5.0}
    lin = {r.ts.day: r.y for r in forecast.regularize(s, "variant_id", "ts", "y", 1, "linear").collect()
           if r.variant_id == "a"}
    assert lin == {1: 2.0, 2: 4.0, 3: 6.0, 4: 8.0}
    none = [r.y for r in forecast.regularize(s, "variant_id", "ts", "y", 1, "none").collect() if r.variant_id == "a"]
    assert sorted(none, key=lambda v: (v is None, v)) == [2, 8, None, None]
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=d) for d in (0, 7, 14, 15, 22)]
    f = spark.createDataFrame([("w", d) for d in days] + [("one", dt.date(2001, 1, 1))], "variant_id string, ts date")
    got = {r.variant_id: r.freq_days for r in forecast.infer_frequency(f, "variant_id", "ts").collect()}
    assert got == {"w": 7, "one": None}


def test_holiday_calendar_rules(spark):
    from shelfcast.operators.holidays import holiday_calendar

    cal = {(r.year, r.holiday): r.holiday_date for r in
           holiday_calendar(spark.createDataFrame([(2001,), (2020,), (2024,)], "year int")).collect()}
    assert cal[(2001, "Thanksgiving")] == dt.date(2001, 11, 22)
    assert cal[(2024, "Memorial")] == dt.date(2024, 5, 27)
    assert cal[(2024, "MartinLutherKing")] == dt.date(2024, 1, 15)
    assert cal[(2024, "Labor")] == dt.date(2024, 9, 2)
    assert (2020, "Juneteenth") not in cal and cal[(2024, "Juneteenth")] == dt.date(2024, 6, 19)
