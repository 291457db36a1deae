"""Series of different frequencies in one fit (``AUTO_FREQUENCY``, SURVEY §2.10).

Every series gets the step that its own dates show: the most frequent gap, read
as months where it is a month, a quarter or a year long, else as days. Rows are
then numbered by period within their series (several rows of a period add up),
and a period number is all the fit needs. So daily, weekly and monthly series
of one table go through one fit, and forecasts are dated back per series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import arima, forecast

# Gaps in days that are calendar steps, as (least, most, months).
CALENDAR_GAPS = ((28, 31, 1), (89, 92, 3), (365, 366, 12))
EPOCH = "DATE '1970-01-01'"


def modal_gaps(series: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, origin, gap) of each series: its first date and its most frequent gap in days (ties -> smaller, null for one date).

    Gaps are counted per (key, gap) within the layout that the window has
    made, so the whole takes one exchange.
    """
    gaps = series.selectExpr(key, f"{ts} AS ts", f"datediff({ts}, lag({ts}) OVER (PARTITION BY {key} ORDER BY {ts})) AS gap")
    counts = gaps.groupBy(key, "gap").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"))
    best = "min(CASE WHEN gap > 0 THEN struct(-n AS less, gap AS gap) END)"
    return counts.groupBy(key).agg(F.min("first").alias("origin"), F.expr(f"{best}.gap AS gap"))


def frequencies(series: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, origin, unit, step): 'month' with a number of months, or 'day' with a number of days (1 for a single date)."""
    months = "CASE " + " ".join(f"WHEN gap BETWEEN {a} AND {b} THEN {m}" for a, b, m in CALENDAR_GAPS) + " END"
    return modal_gaps(series, key, ts).selectExpr(
        key, "origin", f"CASE WHEN {months} IS NOT NULL THEN 'month' ELSE 'day' END AS unit", f"coalesce({months}, gap, 1) AS step")


def periods(series: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(key, origin, unit, step, t, y): values by period number, 0 for the period of the series' first date.

    Both sides of the join are laid out by key; a period off the grid belongs
    to the grid period before it.
    """
    freq = frequencies(series, key, ts)
    months = lambda c: f"(year({c}) * 12 + month({c}))"
    at = f"CASE WHEN unit = 'month' THEN floor(({months(ts)} - {months('origin')}) / step) ELSE floor(datediff({ts}, origin) / step) END"
    return (series.select(key, ts, value).join(freq, key)
            .selectExpr(key, "origin", "unit", "step", f"CAST({at} AS INT) AS t", f"CAST({value} AS BIGINT) AS y")
            .groupBy(key, "origin", "unit", "step", "t").agg(F.sum("y").alias("y")))


def _dated(t: str) -> str:
    return f"CASE WHEN unit = 'month' THEN add_months(origin, ({t}) * step) ELSE date_add(origin, ({t}) * step) END"


def fit_auto(series: DataFrame, key: str, ts: str, value: str, ar: bool = False) -> DataFrame:
    """One fit over series of any frequency: the fit's columns with origin, unit and step; ``last_ts`` is the last period's date.

    ``ar`` fits `arima.fit_arima`, else the closed-form candidates.
    """
    p = periods(series, key, ts, value)
    numbered = p.select(F.struct(key, "origin", "unit", "step").alias("series"), F.expr(f"date_add({EPOCH}, t)").alias("period"), "y")
    model = (arima.fit_arima if ar else forecast.fit_forecaster)(numbered, "series", "period", "y", 1)
    return model.selectExpr("series.*", "* EXCEPT (series)").withColumn("last_ts", F.expr(_dated("CAST(n - 1 AS INT)")))


def forecast_auto(model: DataFrame, key: str, horizon: int, z: float, ar: bool = False) -> DataFrame:
    """``horizon`` periods of each series' own length after its last one, dated by its frequency."""
    numbered = model.withColumn("series", F.struct(key, "origin", "unit", "step")).withColumn("last_ts", F.expr(f"date_add({EPOCH}, CAST(n - 1 AS INT))"))
    steps = (arima.forecast_arima if ar else forecast.forecast)(numbered, "series", horizon, 1, z)
    return steps.selectExpr("series.*", "* EXCEPT (series)").withColumn(
        "forecast_ts", F.expr(_dated(f"datediff(forecast_ts, {EPOCH})"))).drop("origin", "unit", "step")
