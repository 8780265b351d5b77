"""Hypothesis tests against brute force and published figures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from nestmetrics.functions.tails import chi_square_upper, normal_two_sided, with_student_t_tail
from nestmetrics.plans import stats


def brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def sample(spark, a, b):
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, v double")
    return stats.two_sample(df, "v", F.col("g") == "a", F.col("g") == "b").first()


def test_rank_sum_with_many_ties(spark):
    rnd = random.Random(4)
    a, b = [float(rnd.randint(1, 9)) for _ in range(80)], [float(rnd.randint(3, 12)) for _ in range(120)]
    row = sample(spark, a, b)
    u = brute_u(a, b)
    pooled = a + b
    n1, n2, n = len(a), len(b), len(pooled)
    ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert row.u == u
    assert row.u_p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-6)
    assert row.r == pytest.approx(1 - 2 * u / (n1 * n2))


def test_welch_and_effect_size(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 10.0], [2.0, 2.5, 8.0]
    row = sample(spark, a, b)
    m1, m2 = sum(a) / 5, sum(b) / 3
    s1, s2 = sum((x - m1) ** 2 for x in a) / 4, sum((x - m2) ** 2 for x in b) / 2
    assert row.t == pytest.approx((m1 - m2) / math.sqrt(s1 / 5 + s2 / 3))
    assert row.d == pytest.approx((m1 - m2) / math.sqrt((4 * s1 + 2 * s2) / 6))


def test_normal_groups_use_welch_and_others_rank(spark):
    rnd = random.Random(8)
    bell = [rnd.gauss(0, 1) for _ in range(400)]
    assert sample(spark, bell, [v + 0.2 for v in bell]).is_normal
    assert not sample(spark, bell, [math.exp(3 * v) for v in bell]).is_normal
    assert not sample(spark, bell[:20], bell[20:40]).is_normal


def test_effect_labels(spark):
    df = spark.createDataFrame([(0.0,), (-0.2,), (0.5,), (-0.8,)], "d double")
    assert [r[0] for r in df.select(stats.effect_label(F.col("d"))).collect()] == ["negligible", "small", "medium", "large"]


def test_constant_groups_have_no_effect(spark):
    row = sample(spark, [2.0] * 12, [2.0] * 12)
    assert row.d == 0.0 and row.u == 72.0


def test_published_p_value(spark):
    """U = 48,962,457.5 for 17,695 and 5,578 rows was published with p = 0.374086 and r = 0.008."""
    df = spark.createDataFrame([(48962457.5, 17695.0, 5578.0)], "u double, n1 double, n2 double").selectExpr(
        "*", "(greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5D) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1)) AS z"
    )
    row = df.selectExpr(f"{normal_two_sided('z')} AS p", f"{stats.rank_biserial('u', 'n1', 'n2')} AS r").first()
    assert row.p == pytest.approx(0.374086, abs=2e-6) and round(row.r, 3) == 0.008


@pytest.mark.parametrize("u,n1,n2,r", [(66431200.5, 16498, 6263, -0.286), (48423545.0, 6929, 10540, -0.326)])
def test_published_effects(spark, u, n1, n2, r):
    df = spark.createDataFrame([(u, n1, n2)], "u double, a long, b long")
    assert round(df.selectExpr(stats.rank_biserial("u", "a", "b")).first()[0], 3) == r


def test_chi_square_tail(spark):
    # Closed forms: 1, 2 and 4 degrees of freedom; tables for 3 and 7.
    cases = [(3.0, 1, math.erfc(math.sqrt(1.5))), (3.0, 2, math.exp(-1.5)), (7.815, 3, 0.05), (5.0, 4, math.exp(-2.5) * 3.5), (14.067, 7, 0.05)]
    df = spark.createDataFrame([(x, k) for x, k, _ in cases], "x double, k int")
    got = [r[0] for r in df.selectExpr(f"{chi_square_upper('x', 'k')}").collect()]
    for g, (_, _, want) in zip(got, cases, strict=True):
        assert g == pytest.approx(want, rel=2e-4)


def test_student_tail(spark):
    # 1 and 2 degrees of freedom have closed forms; 2.228 is the 5 % point for 10.
    cases = [(2.0, 1.0, 1 - 2 * math.atan(2.0) / math.pi), (1.5, 2.0, 1 - 1.5 / math.sqrt(2 + 2.25)), (2.2281388520, 10.0, 0.05), (0.0, 5.0, 1.0), (1.959964, 1e7, 0.05)]
    df = spark.createDataFrame([c[:2] for c in cases], "t double, v double")
    for row, (_, _, want) in zip(with_student_t_tail(df, "t", "v", "p").collect(), cases, strict=True):
        assert row.p == pytest.approx(want, rel=1e-5)


def test_kruskal_wallis(spark):
    groups = [[1.0, 2.0, 2.0, 5.0], [2.0, 3.0, 9.0], [4.0, 5.0, 7.0, 8.0, 8.0]]
    df = spark.createDataFrame([(i + 1, v) for i, g in enumerate(groups) for v in g], "g int, v double")
    row = stats.kruskal_wallis(df, "v", "g", 3).first()
    pooled = sorted(v for g in groups for v in g)
    n = len(pooled)
    rank = {v: pooled.index(v) + (pooled.count(v) + 1) / 2 for v in set(pooled)}
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in g) ** 2 / len(g) for g in groups) - 3 * (n + 1)
    h /= 1 - sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled)) / (n**3 - n)
    assert row.h == pytest.approx(h) and row.p == pytest.approx(math.exp(-h / 2))
    assert (row.groups, row.n_first, row.n_rest, row.n_smallest) == (3, 4, 8, 3)


def report_input(spark, n=300):
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 'Entire home' ELSE 'Private room' END AS room_type",
        "double(50 + id % 90 + CASE WHEN id % 2 = 0 THEN 40 ELSE 0 END) AS price",
        "id % 3 = 0 AS host_is_superhost", "3 + (id * 7 % 65) / 32D AS review_scores_rating",
        "id % 5 < 2 AS is_professional_host", "concat('area ', id % 5) AS neighbourhood_cleansed",
    )


def test_report_rows_and_numbering(spark):
    rows = stats.statistical_report(report_input(spark)).collect()
    assert [r.hypothesis_id for r in rows] == [1, 2, 3, 4] and len(rows[0]) == 13
    assert rows[0].test_used == "Mann-Whitney U (log-transformed)"
    assert rows[0].result_plain_english == "The difference is unlikely to be random."
    assert rows[3].effect_size == "N/A (Omnibus test)"


def test_small_groups_are_skipped(spark):
    rows = stats.statistical_report(report_input(spark, 30)).collect()
    assert [(r.hypothesis_id, r.business_question[:9]) for r in rows] == [(1, "Do entire"), (2, "Do superh"), (3, "Do profes")]


def test_weekend_without_prices_gives_no_row(spark):
    cal = spark.createDataFrame([(1, None, None)], "listing_id long, date date, price double")
    assert stats.test_weekend_price(cal).collect() == []


def test_a_report_without_any_test_is_empty(spark):
    report = stats.statistical_report(spark.range(5))
    assert report.columns[0] == "hypothesis_id" and report.count() == 0


def market(spark, path):
    """Listings and priced days in files of their own, so that reads can be told apart."""
    rnd = random.Random(12)
    rooms = ["Entire home", "Private room", "Shared room", None]
    listings = [
        (i, rnd.choice(rooms), rnd.choice([True, False, None]), rnd.random() < 0.4, rnd.choice(["a", "b", "c", "d", "e", "f", None]),
         rnd.choice([None, 0.0, *map(float, range(40, 400, 7))]), rnd.choice([None, 3.5, 4.0, 4.5, 4.75, 5.0]))
        for i in range(900)
    ]
    days = [(f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", rnd.choice([None, 0.0, *map(float, range(50, 200, 3))])) for i in range(1500)]
    schema = "id long, room_type string, host_is_superhost boolean, is_professional_host boolean, neighbourhood_cleansed string, price double, review_scores_rating double"
    spark.createDataFrame(listings, schema).write.parquet(f"{path}/listings")
    spark.createDataFrame(days, "date string, price double").selectExpr("date(date) AS date", "price").write.parquet(f"{path}/days")
    return spark.read.parquet(f"{path}/listings"), spark.read.parquet(f"{path}/days")


def test_report_equals_the_single_tests_in_one_pass(spark, tmp_path):
    listings, days = market(spark, str(tmp_path))
    report = stats.statistical_report(listings, days)
    got = [tuple(r)[1:] for r in report.collect()]
    single = [
        stats.test_entire_vs_private(listings), stats.test_superhost_scores(listings), stats.test_pro_vs_casual_price(listings),
        stats.test_weekend_price(days), stats.test_neighbourhood_prices(listings),
    ]
    assert got == [tuple(test.first())[1:] for test in single]
    # Days are read once, listings for the counts and for the leading areas; every other use is reused.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = stats.statistical_report(listings, days)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [line.split("ReadSchema")[-1] for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and sum(line.startswith(": struct<date:date") for line in scans) == 1, scans


def test_report_without_columns_and_rows(spark, tmp_path):
    listings, days = market(spark, str(tmp_path))
    assert stats.statistical_report(listings.select("id")).collect() == []
    assert stats.statistical_report(listings.limit(0), days.limit(0)).collect() == []
    only = stats.statistical_report(listings.drop("price"), days).collect()
    assert [r.business_question for r in only] == ["Do superhosts have higher review scores?", "Are weekend prices different from weekday prices?"]
    assert [r.hypothesis_id for r in only] == [1, 2]


def test_figures_of_several_samples(spark):
    rnd = random.Random(5)
    rows = [(t, rnd.choice([1, 2, 3]), float(rnd.randint(0, 9 + t) ** t)) for t in (1, 2, 3) for _ in range(200)]
    got = {r.test: r for r in stats.sample_figures(spark.createDataFrame(rows, "test int, g int, v double"), 3).collect()}
    for t in (1, 2, 3):
        pooled = sorted(v for s, _, v in rows if s == t)
        rank = {v: pooled.index(v) + (pooled.count(v) + 1) / 2 for v in pooled}
        for g in (1, 2, 3):
            mine = [v for s, h, v in rows if (s, h) == (t, g)]
            n, mean = len(mine), sum(mine) / len(mine)
            m2, m3, m4 = (sum((v - mean) ** p for v in mine) / n for p in (2, 3, 4))
            assert got[t][f"n_{g}"] == n and got[t][f"rank_sum_{g}"] == sum(rank[v] for v in mine)
            assert got[t][f"mean_{g}"] == pytest.approx(mean) and got[t][f"var_{g}"] == pytest.approx(m2 * n / (n - 1))
            assert got[t][f"skew_{g}"] == pytest.approx(m3 / m2**1.5) and got[t][f"excess_{g}"] == pytest.approx(m4 / m2**2 - 3)
        assert got[t].tie_sum == sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))


def test_tails_keep_their_digits(spark):
    """Against closed forms, for one to a million million degrees of freedom."""
    closed = {
        1.0: lambda t: 2 / math.pi * math.atan(1 / t),
        2.0: lambda t: 2 / (2 + t * t + t * math.sqrt(2 + t * t)),
        1e12: lambda t: math.erfc(t / math.sqrt(2)),
    }
    cases = [(t, v) for v in closed for t in (0.001, 0.3, 1.0, 1.72, 1.74, 3.0, 4.9)]
    df = spark.createDataFrame(cases, "t double, v double")
    for row in with_student_t_tail(df, "t", "v", "p").collect():
        assert row.p == pytest.approx(closed[row.v](row.t), rel=1e-8), (row.t, row.v)
    zs = [0.0, 0.5, 1.96, 2.8, 2.83, 6.0, 30.0, 60.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").selectExpr(f"{normal_two_sided('z')} AS p").collect()
    for z, row in zip(zs, got, strict=True):
        assert row.p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-12, abs=1e-300)


def test_tails_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None, 3.0), (1.0, None), (0.0, 3.0)], "t double, v double")
    assert [r.p for r in with_student_t_tail(df, "t", "v", "p").collect()] == [None, None, 1.0]
    assert spark.sql(f"SELECT {normal_two_sided('CAST(NULL AS DOUBLE)')} AS p").first().p is None
