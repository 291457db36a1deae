from pyspark.sql import functions as F

from shelfcast.functions.semantics import (gid_suffix, null_greatest, or_default, round_to_long, safe_div,
                                           week_start)


def test_null_aware_greatest_and_rounding(spark):
    df = spark.createDataFrame([(None, 2.5), (-3, -2.5), (5, 2.7), (0, 2.4999)], "x bigint, f double")
    rows = df.select(null_greatest("x").alias("g"), round_to_long("f").alias("r")).collect()
    assert [r.g for r in rows] == [None, 0, 5, 0]
    assert [r.r for r in rows] == [3, -3, 3, 2]   # half away from zero; a bare cast would truncate


def test_gid_suffix_and_defaults(spark):
    df = spark.createDataFrame([("gid://x/Product/12", None), ("", ""), (None, "a")], "id string, s string")
    rows = df.select(gid_suffix("id").alias("g"), or_default("s", "z").alias("d")).collect()
    assert [r.g for r in rows] == ["12", "", ""]
    assert [r.d for r in rows] == ["z", "z", "a"]


def test_safe_div_and_monday_weeks(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (None, 1)], "a bigint, b bigint")
    assert [r.q for r in df.select(safe_div(F.col("a"), F.col("b")).alias("q")).collect()] == [None, 1.5, None]
    w = spark.sql("SELECT DATE'2001-11-04' AS d, DATE'2001-11-05' AS e").select(week_start("d"), week_start("e")).first()
    assert str(w[0]) == "2001-10-29" and str(w[1]) == "2001-11-05"
