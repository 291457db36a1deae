import random
import statistics

from shelfcast.functions import ranking


def test_dense_rank_row_number_and_median_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(f"vendor {rng.randrange(500):03d}/{i}", float(rng.choice([1, 2, 2, 3.5, i % 40]))) for i in range(700)] + [("é", None)]
    df = spark.createDataFrame(rows, "name string, v double")
    distinct = sorted({v for _, v in rows if v is not None}, reverse=True)
    place = {v: i + 1 for i, v in enumerate(distinct)} | {None: len(distinct) + 1}
    got = {r.name: r.r for r in ranking.with_dense_rank_desc(df, "v", "r").collect()}
    assert got == {n: place[v] for n, v in rows}
    numbers = {r.name: r.i for r in ranking.with_row_number(df, "name", "i").collect()}
    assert numbers == {n: i + 1 for i, n in enumerate(sorted(n for n, _ in rows))}
    assert ranking.exact_median(df, "v", "m").first().m == statistics.median(v for _, v in rows if v is not None)
    assert ranking.exact_median(df.filter("v = 2"), "v", "m").first().m == 2.0


def test_empty_and_null_only(spark):
    df = spark.createDataFrame([("a", None)], "name string, v double")
    assert ranking.exact_median(df, "v", "m").first().m is None
    assert ranking.with_dense_rank_desc(df.limit(0), "v", "r").count() == 0
    assert [r.i for r in ranking.with_row_number(df, "name", "i").collect()] == [1]


def test_names_with_a_common_prefix_spread_over_all_buckets(spark):
    df = spark.range(40_000).selectExpr("concat('The same long beginning of all names #', lpad(CAST(id * 7919 % 40000 AS STRING), 6, '0')) AS name")
    sizes = [r["count"] for r in ranking._string_bucketed(df, "name").groupBy("_bucket").count().collect()]
    assert len(sizes) >= ranking.BUCKETS * 0.95 and max(sizes) < 40_000 / 50
    got = ranking.with_row_number(df, "name", "i").selectExpr("min(i) a", "max(i) b", "count(DISTINCT i) n",
                                                              "count_if(CAST(right(name, 6) AS INT) + 1 <> i) wrong").first()
    assert tuple(got) == (1, 40_000, 40_000, 0)


def test_a_value_that_half_of_the_rows_share_is_one_row(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 2 = 0 THEN 1.0D ELSE id / 30000.0D END AS v")
    values = sorted(1.0 if i % 2 == 0 else i / 30000 for i in range(30_000))
    assert ranking.exact_median(df, "v", "m").first().m == (values[14_999] + values[15_000]) / 2
    plan = ranking.exact_median(df, "v", "m")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan
    even = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (4.0,)], "v double")
    assert ranking.exact_median(even, "v", "m").first().m == 3.0
