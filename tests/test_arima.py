import datetime as dt

import numpy as np
import pytest

from shelfcast.operators import arima, frequency

D0 = dt.date(2001, 1, 1)


def table(spark, series):
    rows = [(k, D0 + dt.timedelta(days=int(t)), int(y)) for k, ys in series.items() for t, y in enumerate(ys) if y != 0 or t in (0, len(ys) - 1)]
    return spark.createDataFrame(rows, "variant_id string, ts date, y bigint")


def simulate(phi, n, seed, mean=5000, d=0, scale=100):
    rng = np.random.default_rng(seed)
    x = np.zeros(n + 200)
    for t in range(len(phi), len(x)):
        x[t] = sum(f * x[t - 1 - j] for j, f in enumerate(phi)) + rng.standard_normal()
    x = np.round(x[200:] * scale)
    return (np.cumsum(x) if d else x) + mean


def brute(ys, max_p=5):
    """Yule-Walker by a linear solve on the points, AICc over (p, d)."""
    best = None
    for d in (0, 1):
        x = np.diff(ys) if d else np.asarray(ys, dtype=float)
        n, m, xc = len(x), len(ys) - 1, x - np.mean(x)
        c = [float(xc[k:] @ xc[:n - k]) / n if k < n else 0.0 for k in range(max_p + 1)]
        for p in range(max_p + 1):
            k = p + 2
            if m <= k + 1:
                continue
            phi = np.linalg.solve([[c[abs(i - j)] for j in range(p)] for i in range(p)], c[1:p + 1]) if p and c[0] > 1e-9 else np.zeros(p)
            v = c[0] - float(np.dot(phi, c[1:p + 1]))
            s = round(m * np.log(max(v, 1e-9)) + 2 * k + 2 * k * (k + 1) / (m - k - 1), 6)
            if best is None or (s, d, p) < best[:3]:
                best = (s, d, p, phi, v, np.mean(x))
    return best


def test_recovers_synthetic_processes(spark):
    made = {"ar2": ([0.5, 0.3], 0), "ar1": ([-0.7], 0), "walk": ([], 1), "ari1": ([0.6], 1)}
    t = table(spark, {k: simulate(phi, 3000, i, d=d) for i, (k, (phi, d)) in enumerate(made.items())})
    got = {r.variant_id: r for r in arima.fit_arima(t, "variant_id", "ts", "y", 1).collect()}
    for k, (phi, d) in made.items():
        found = [got[k][f"phi{j + 1}"] for j in range(5)]
        assert got[k].d == d, k
        assert found == pytest.approx(phi + [0.0] * (5 - len(phi)), abs=0.07), k
        assert got[k].sigma2 == pytest.approx(10_000, rel=0.1), k


def test_equals_a_solve_on_the_points_with_gaps_and_short_series(spark):
    rng = np.random.default_rng(2)
    series = {f"s{i}": rng.integers(0, 9, size) * (rng.random(size) < 0.7) + np.arange(size) * (i % 3) for i, size in enumerate([1, 2, 3, 5, 6, 8, 9, 12, 30, 60, 90])}
    series["flat"], series["line"] = np.full(20, 7), 3 + 2 * np.arange(20)
    got = {r.variant_id: r for r in arima.fit_arima(table(spark, series), "variant_id", "ts", "y", 1).collect()}
    assert set(got) == set(series)
    for k, ys in series.items():
        best, r = brute(ys), got[k]
        assert r.n == len(ys)
        if best is None:
            assert (r.d, r.p, r.score, r.mu) == (0, 0, None, pytest.approx(np.mean(ys)))
            assert r.sigma2 == pytest.approx(np.var(ys, ddof=1) if len(ys) > 1 else 0.0)
            continue
        assert (r.d, r.p) == best[1:3] and r.score == pytest.approx(best[0], abs=1e-5), k
        assert [r[f"phi{j + 1}"] for j in range(best[2])] == pytest.approx(best[3], abs=1e-7)


def test_forecasts_follow_the_recursion(spark):
    series = {"ar2": simulate([0.5, 0.3], 400, 7), "ari": simulate([0.6], 400, 8, d=1), "line": 3 + 2 * np.arange(20)}
    model = arima.fit_arima(table(spark, series), "variant_id", "ts", "y", 1).cache()
    out = arima.forecast_arima(model, "variant_id", 9, 1, 1.96).orderBy("variant_id", "forecast_ts").collect()
    for r in model.collect():
        ys = series[r.variant_id]
        phi = [r[f"phi{j + 1}"] for j in range(5)]
        x = list(np.diff(ys) if r.d else ys.astype(float))
        psi, level, expected = [1.0], float(ys[-1]), []
        for h in range(9):
            x.append(r.mu + sum(f * (x[-1 - j] - r.mu) for j, f in enumerate(phi)))
            level = level + x[-1] if r.d else x[-1]
            weights = np.cumsum(psi) if r.d else np.array(psi)
            expected.append((level, (r.sigma2 * (weights ** 2).sum()) ** 0.5))
            psi.append(sum(f * psi[-1 - j] for j, f in enumerate(phi) if j < len(psi)))
        own = [o for o in out if o.variant_id == r.variant_id]
        assert [o.forecast_value for o in own] == pytest.approx([e[0] for e in expected])
        assert [o.prediction_interval_upper_bound - o.forecast_value for o in own] == pytest.approx([1.96 * e[1] for e in expected], abs=1e-6)
        assert own[0].forecast_ts == D0 + dt.timedelta(days=len(ys))


def test_plans_stay_in_the_jvm_with_one_exchange_per_fit(spark):
    t = table(spark, {"a": np.arange(40) % 7})
    model = arima.fit_arima(t, "variant_id", "ts", "y", 1)
    plan = model._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
    assert "Python" not in arima.forecast_arima(model, "variant_id", 5, 1, 2.0)._jdf.queryExecution().executedPlan().toString()


def test_each_series_gets_its_own_step(spark):
    def dates(kind, n):
        return {"d": [D0 + dt.timedelta(days=i) for i in range(n)], "w": [D0 + dt.timedelta(days=7 * i) for i in range(n)],
                "m": [dt.date(2001 + i // 12, i % 12 + 1, 1) for i in range(n)], "q": [dt.date(2001 + i // 4, 3 * (i % 4) + 1, 1) for i in range(n)],
                "y": [dt.date(2001 + i, 1, 1) for i in range(n)], "one": [D0], "10": [D0 + dt.timedelta(days=10 * i) for i in range(n)]}[kind]

    rows = [(k, x, 10 + 3 * i) for k in ("d", "w", "m", "q", "y", "one", "10") for i, x in enumerate(dates(k, 14)) if i != 5]
    rows += [("w", D0 + dt.timedelta(days=7 * 3 + 2), 4)]                               # off the grid: belongs to the week before it
    model = frequency.fit_auto(spark.createDataFrame(rows, "variant_id string, ts date, y bigint"), "variant_id", "ts", "y").cache()
    got = {r.variant_id: r for r in model.collect()}
    assert {k: (r.unit, r.step, r.n) for k, r in got.items()} == {
        "d": ("day", 1, 14), "w": ("day", 7, 14), "m": ("month", 1, 14), "q": ("month", 3, 14), "y": ("month", 12, 14), "one": ("day", 1, 1),
        "10": ("day", 10, 14)}
    assert all(r.last_ts == dates(k, 14)[-1] for k, r in got.items())
    assert got["w"].y_mean == pytest.approx((sum(10 + 3 * i for i in range(14) if i != 5) + 4) / 14)
    nxt = {r.variant_id: r.t for r in frequency.forecast_auto(model, "variant_id", 2, 2.0).groupBy("variant_id").agg({"forecast_ts": "max"}).toDF("variant_id", "t").collect()}
    assert nxt == {"d": dt.date(2001, 1, 16), "w": dt.date(2001, 4, 16), "m": dt.date(2002, 4, 1), "q": dt.date(2004, 10, 1), "y": dt.date(2016, 1, 1),
                   "one": dt.date(2001, 1, 3), "10": dt.date(2001, 5, 31)}
    both = frequency.fit_auto(spark.createDataFrame(rows, "variant_id string, ts date, y bigint"), "variant_id", "ts", "y", ar=True)
    assert {r.variant_id: r.last_ts for r in both.collect()} == {k: r.last_ts for k, r in got.items()}
    assert frequency.forecast_auto(both, "variant_id", 3, 2.0, ar=True).count() == 3 * 7
