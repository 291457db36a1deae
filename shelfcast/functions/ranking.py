"""Global ranks and medians without a one-task window.

Rows are dealt into buckets by approximate quantiles of the order value, or by
a sample of the strings (equal values share a bucket), each bucket is ranked by itself, and a bucket's offset
is what the aggregated counts of the buckets before it add up to. Only the
bucket counts, at most ``BUCKETS`` rows, are ordered globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 200
SAMPLE = 8_000          # strings drawn to cut buckets


def _string_cuts(df: DataFrame, order: str) -> Column:
    """At most ``BUCKETS - 1`` of the strings themselves, ascending: even steps through a hash-chosen sample of distinct ones."""
    n = df.select(F.count(F.lit(1))).scalar()
    drawn = F.pmod(F.xxhash64(F.lit(17), order), F.lit(1 << 30)) < F.lit(float(SAMPLE * (1 << 30))) / F.greatest(n, F.lit(1))
    ordered = df.filter(F.col(order).isNotNull() & drawn).select(F.array_sort(F.collect_set(order)).alias("s"))
    steps = f"transform(sequence(1, {BUCKETS - 1}), i -> get(s, CAST(i * size(s) div {BUCKETS} AS INT)))"
    return ordered.select(F.expr(f"array_compact(array_distinct({steps}))")).scalar()


def _string_bucketed(df: DataFrame, order: str) -> DataFrame:
    """``df`` with ``_bucket`` ascending in the whole string; nulls in bucket -1."""
    placed = df.withColumn("_cuts", _string_cuts(df, order))
    below = F.size(F.filter("_cuts", lambda x: x < F.col(order)))
    return placed.withColumn("_bucket", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(below)).drop("_cuts")


def _bucketed(df: DataFrame, order: Column) -> DataFrame:
    """``df`` with ``_bucket`` ascending in ``order``; nulls in bucket -1."""
    cuts = df.select(F.percentile_approx(order, [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).scalar()
    placed = df.withColumn("_cuts", F.array_distinct(cuts)).withColumn("_order", order)
    below = F.size(F.filter("_cuts", lambda x: x < F.col("_order")))
    bucket = F.when(F.col("_order").isNull(), F.lit(-1)).otherwise(F.coalesce(below, F.lit(0)))
    return placed.withColumn("_bucket", bucket).drop("_cuts", "_order")


def _with_offset(bucketed: DataFrame, count: Column, ascending: bool = True) -> DataFrame:
    """Join the number of rows (or distinct values) in all buckets before a row's own as ``_before``."""
    counts = bucketed.groupBy("_bucket").agg(count.alias("_n"))
    order = F.col("_bucket") if ascending else F.col("_bucket").desc()
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)     # one row a bucket
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return bucketed.join(offsets, "_bucket")


def with_dense_rank_desc(df: DataFrame, value: str, name: str) -> DataFrame:
    """``dense_rank() OVER (ORDER BY value DESC)`` as ``name``; nulls rank last."""
    ranked = _with_offset(_bucketed(df, F.col(value)), F.count_distinct(F.coalesce(value, F.lit(float("nan")))), ascending=False)
    own = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(F.col(value).desc()))
    return ranked.withColumn(name, (F.col("_before") + own).cast("int")).drop("_bucket", "_before")


def with_row_number(df: DataFrame, order: str, name: str) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` of a string column as ``name``."""
    ranked = _with_offset(_string_bucketed(df, order), F.count(F.lit(1)))
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return ranked.withColumn(name, (F.col("_before") + own).cast("bigint")).drop("_bucket", "_before")


def exact_median(df: DataFrame, value: str, name: str) -> DataFrame:
    """One row: the median of the non-null values (mean of the middle two), null without any.

    Selected from counts of equal values, which combine map-side: a value that
    half of all rows share is one row here.
    """
    counts = (df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    ranked = _with_offset(_bucketed(counts, F.col("_v")), F.sum("_c"))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy("_bucket").orderBy("_v"))
    n = counts.select(F.sum("_c")).scalar()
    at = lambda place: F.max(F.when((F.col("_upto") - F.col("_c") < place) & (place <= F.col("_upto")), F.col("_v")))
    middle = ranked.withColumn("_upto", upto).agg(at(F.floor((n + 1) / 2)).alias("_a"), at(F.floor((n + 2) / 2)).alias("_b"))
    return middle.select(((F.col("_a") + F.col("_b")) / 2).alias(name))
