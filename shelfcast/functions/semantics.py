"""Column helpers that pin down warehouse-SQL semantics Spark spells differently.

All helpers return built-in Column expressions (JVM side, inside codegen).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_lit(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def ts_lit(t: dt.datetime) -> Column:
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def null_greatest(c: Column | str, floor: int = 0) -> Column:
    """``GREATEST(x, floor)`` that is NULL when x is NULL (Spark's greatest skips NULLs)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def round_to_long(c: Column | str) -> Column:
    """``CAST(float AS INT64)``: round half away from zero, then cast.

    The inner round to 6 places keeps engines equal for values like x.4999999999.
    A bare Spark cast would truncate (2.7 -> 2). ``round`` of a double goes through
    its decimal digits; below 1e9 and away from x.5 the nearest integer is the same.
    """
    c = F.col(c) if isinstance(c, str) else c
    clear = (F.abs(c) < 1e9) & (F.abs(c - F.floor(c) - 0.5) > 1e-5)
    return F.when(clear, F.floor(c + 0.5)).otherwise(F.round(F.round(c, 6), 0).cast("bigint"))


def safe_div(num: Column, den: Column) -> Column:
    """``SAFE_DIVIDE``: NULL on a zero or NULL divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def gid_suffix(c: Column | str) -> Column:
    """Last ``/``-separated segment of an API global id; NULL or '' gives ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.element_at(F.split(c, "/"), -1), F.lit(""))


def or_default(c: Column | str, default) -> Column:
    """Python ``value or default`` for strings: NULL and '' both fall back."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def any_label(c: Column | str, blank_to_null: bool = True) -> Column:
    """``ANY_VALUE(NULLIF(x, ''))`` made deterministic: the smallest value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.min(F.nullif(c, F.lit("")) if blank_to_null else c)


def week_start(c: Column | str) -> Column:
    """``DATE_TRUNC(d, WEEK(MONDAY))``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(c, "week")
