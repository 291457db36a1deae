"""US holiday calendar and per-holiday demand effects (``holiday_region='US'``).

The calendar is generated from rules (fixed dates and n-th / last weekday of a
month) for the years a series spans — no lookup table is shipped. Dates are not
moved to observed weekdays.

Effect of holiday H on a series = mean over H's dates inside the series' span
of ``y - fitted trend(+season)``, counting days without sales as 0; it is added
to forecasts that fall on H.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.params import DEFAULT_PARAMS, Params

# US federal holiday rules (name, month, rule). Rule: day of month,
# or (n, weekday) for the n-th weekday (ISO 1 = Monday, n = -1 for the last).
US_HOLIDAY_RULES = (
    ("NewYear", 1, 1),
    ("MartinLutherKing", 1, (3, 1)),
    ("Presidents", 2, (3, 1)),
    ("Memorial", 5, (-1, 1)),
    ("Juneteenth", 6, 19),        # from 2021
    ("Independence", 7, 4),
    ("Labor", 9, (1, 1)),
    ("Columbus", 10, (2, 1)),
    ("Veterans", 11, 11),
    ("Thanksgiving", 11, (4, 4)),
    ("Christmas", 12, 25),
)
JUNETEENTH_FIRST_YEAR = 2021


def _rule_date(year: Column, month: int, rule) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if isinstance(rule, int):
        return F.make_date(year, F.lit(month), F.lit(rule))
    n, iso_wd = rule
    if n > 0:
        # days from the 1st to the first wanted weekday, then (n-1) weeks
        first_wd = F.pmod(F.dayofweek(first) + 5, F.lit(7)) + 1          # ISO weekday of the 1st
        return F.date_add(first, (F.pmod(F.lit(iso_wd) - first_wd, F.lit(7)) + 7 * (n - 1)).cast("int"))
    last = F.last_day(first)
    last_wd = F.pmod(F.dayofweek(last) + 5, F.lit(7)) + 1
    return F.date_sub(last, F.pmod(last_wd - F.lit(iso_wd), F.lit(7)).cast("int"))


def holiday_calendar(years: DataFrame) -> DataFrame:
    """(year, holiday, holiday_date) for every year in ``years(year int)``."""
    y = F.col("year")
    rows = [F.struct(F.lit(name).alias("holiday"), _rule_date(y, month, rule).alias("holiday_date"))
            for name, month, rule in US_HOLIDAY_RULES]
    cal = years.select("year", F.explode(F.array(*rows)).alias("h")).select("year", "h.holiday", "h.holiday_date")
    return cal.filter((F.col("holiday") != "Juneteenth") | (F.col("year") >= JUNETEENTH_FIRST_YEAR))


def run_calendar(spark: SparkSession, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """The holidays a run can meet: training reaches one year back, forecasts ``horizon`` days ahead of it."""
    last = p.as_of + dt.timedelta(days=p.forecast_horizon_days)
    years = spark.range(p.days_ago(p.sales_lookback_days).year, last.year + 1).select(F.col("id").cast("int").alias("year"))
    return holiday_calendar(years).select("holiday", "holiday_date")


def holiday_effects(series: DataFrame, model: DataFrame, key: str, ts: str, value: str, calendar: DataFrame) -> DataFrame:
    """Mean residual per (series, holiday) over the holidays inside each daily series' span.

    ``calendar`` (11 rows a year of the run) is broadcast: only observations on
    a holiday leave the scan, as one row a series. They meet the model in one
    shuffle by series; its holidays are spelled out after it, and stay in place.
    """
    cal = F.broadcast(calendar.withColumn("_year", F.year("holiday_date")))
    first = F.date_sub("last_ts", (F.col("n") - 1).cast("int"))
    dates = F.broadcast(calendar.select(F.col("holiday_date").alias(ts)).distinct())
    obs = (series.join(dates, ts, "left_semi").groupBy(key)
           .agg(F.collect_list(F.struct(F.col(ts).alias("day"), F.col(value).cast("double").alias("y"))).alias("_obs")))
    years = (model.join(obs, key, "left").withColumn("_first", first)
             .withColumn("_year", F.explode(F.sequence(F.year("_first"), F.year("last_ts")))))
    days = (years.join(cal, "_year").filter(F.col("holiday_date").between(F.col("_first"), F.col("last_ts")))
            .withColumnRenamed("holiday_date", ts))
    seen = F.transform(F.filter("_obs", lambda o: o["day"] == F.col(ts)), lambda o: o["y"])
    pts = days.withColumn("_y", F.explode_outer(seen))
    t = F.datediff(F.col(ts), F.col("_first")).cast("double")
    resid = F.coalesce("_y", F.lit(0.0)) - _fitted(t, F.col(ts))
    # ≤ 2 dates per holiday in a one-year window: their sum is the same in either order
    return pts.groupBy(key, "holiday").agg((F.sum(resid) / F.count(resid)).alias("holiday_effect"))


def _fitted(t: Column, day: Column) -> Column:
    offset = F.element_at(F.array(*[F.col(f"season_w{w}") for w in range(7)]),
                          (F.pmod(F.unix_date(day), F.lit(7)) + 1).cast("int"))
    trend = F.coalesce(F.col("intercept") + F.col("slope") * t, F.col("y_mean"))
    return trend + F.coalesce(offset, F.lit(0.0))


def with_holiday_effects(model: DataFrame, effects: DataFrame, key: str, calendar: DataFrame, days: int) -> DataFrame:
    """The model with ``holiday_shifts``: the effect of each holiday in the ``days`` after a series' last one, by date."""
    named = effects.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("holiday", "holiday_effect"))).alias("_effects"))
    dates = calendar.select(F.collect_list(F.struct("holiday_date", "holiday"))).scalar()
    ahead = F.filter("_dates", lambda d: d["holiday_date"].between(F.date_add("last_ts", 1), F.date_add("last_ts", days)))
    shifts = F.map_from_entries(F.transform(ahead, lambda d: F.struct(d["holiday_date"], F.element_at("_effects", d["holiday"]))))
    return (model.join(named, key, "left").withColumn("_dates", dates).withColumn("holiday_shifts", shifts)
            .drop("_dates", "_effects"))


def add_holiday_effects(fc: DataFrame, key: str) -> DataFrame:
    """Shift forecasts (value and bounds) that fall on a holiday by that holiday's effect in ``holiday_shifts``."""
    cols = ("forecast_value", "prediction_interval_lower_bound", "prediction_interval_upper_bound")
    eff = F.coalesce(F.element_at("holiday_shifts", F.col("forecast_ts")), F.lit(0.0))
    return (fc.select(key, "forecast_ts", *cols, eff.alias("_effect"))
            .select(key, "forecast_ts", *[(F.col(c) + F.col("_effect")).alias(c) for c in cols]))
