"""Rollups kept up from the dates that an upsert touched.

Daily rows depend on one date and weekly rows on one week, so after a batch only
the touched dates, and the weeks they fall in, are aggregated again; the scan of
the facts is limited to their partitions by literal dates. The window's own
movement counts too: dates that have left the lookback are dropped, and the week
that its lower bound cuts is taken again.

What depends on a whole dimension cannot be kept up this way: after a change of
prices (C10's revenue) or of the variant map (C22) pass ``dates=None``, which
rebuilds everything.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit
from shelfcast.operators import demand
from shelfcast.params import Params
from shelfcast.session import checkpoint_dir
from shelfcast.sources import store


def _among(df: DataFrame, column: str, dates: Iterable[dt.date]) -> DataFrame:
    """Rows of the given dates, as a literal list: the scan reads their partitions only."""
    wanted = sorted(dates)
    return df.filter(F.col(column).isin(wanted)) if wanted else df.filter(F.lit(False))


def _replace(spark: SparkSession, rows: DataFrame, path: str, column: str, dates: set[dt.date] | None) -> None:
    """Put ``rows`` in place of the partitions of ``dates`` (None: of all); dates without rows lose their partition."""
    if dates is None:
        store.write_rollup(rows, path, column, "variant_id")
        return
    work = f"{checkpoint_dir(spark)}/rollup-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(work)
        rows = spark.read.schema(rows.schema).parquet(work)
        rows.hint("rebalance", column).sortWithinPartitions(column, "variant_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
        filled = {r[0] for r in rows.select(column).distinct().collect()}              # at most one row a date of the batch
        for d in dates - filled:
            store.delete_folder(spark, f"{path}/{column}={d.isoformat()}")
    finally:
        store.delete_folder(spark, work)


def _expire(spark: SparkSession, path: str, column: str, first: dt.date, last: dt.date) -> None:
    for v in store.partition_values(spark, path, column):
        if not first <= dt.date.fromisoformat(v) <= last:
            store.delete_folder(spark, f"{path}/{column}={v}")


def week_of(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())


def _window(p: Params) -> tuple[dt.date, dt.date]:
    return p.days_ago(p.sales_lookback_days), p.as_of


def refresh_daily(spark: SparkSession, sales: DataFrame, path: str, dates: Iterable[str] | None, p: Params,
                  variants: DataFrame | None = None) -> set[dt.date] | None:
    """Bring the daily rollup at ``path`` up to date after ``sales`` changed on ``dates``; returns the dates rewritten.

    With ``variants`` it is C10 (revenue at current prices), else C21. Dates
    that the window did not reach at the last refresh and does now have to be
    among ``dates``; a batch of an upsert is, as facts arrive before their day
    is over. A path without a rollup is built whole.
    """
    first, last = _window(p)
    roll = (lambda s: demand.sales_daily(s, variants, p)) if variants is not None else (lambda s: demand.sales_daily_validation(s, p))
    if dates is None or not store.table_exists(spark, path):
        _replace(spark, roll(sales), path, "sale_date", None)
        return None
    wanted = {d for d in map(dt.date.fromisoformat, dates) if first <= d <= last}
    if wanted:
        _replace(spark, roll(_among(sales, "sale_date", wanted)), path, "sale_date", wanted)
    _expire(spark, path, "sale_date", first, last)
    return wanted


def refresh_weekly(spark: SparkSession, daily: DataFrame, variant_map: DataFrame, path: str, dates: Iterable[dt.date] | None,
                   p: Params) -> set[dt.date] | None:
    """Bring C22 at ``path`` up to date after the daily rollup changed on ``dates``; returns the weeks rewritten."""
    first, last = _window(p)
    if dates is None or not store.table_exists(spark, path):
        _replace(spark, demand.sales_weekly(daily, variant_map, p), path, "week_start", None)
        return None
    weeks = {week_of(d) for d in dates} | {week_of(first)}
    days = [w + dt.timedelta(days=i) for w in weeks for i in range(7)]
    _replace(spark, demand.sales_weekly(_among(daily, "sale_date", days), variant_map, p), path, "week_start", weeks)
    _expire(spark, path, "week_start", week_of(first), last)
    return weeks
