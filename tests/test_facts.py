"""Several figures from one count of facts, against the jobs that take one figure each."""

import statistics

import pytest
from pyspark.sql import functions as F

from nestmetrics.operators.facts import Fact, count_facts, leader, of, quantile_of, summarise
from nestmetrics.operators.quantiles import exact_quantiles
from nestmetrics.plans import dashboard, eda, rules
from test_stats import market


def scans(plan_of):
    return [line for line in plan_of._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in line]


def test_summary_of_several_facts(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0), (None, 7.0), (None, float("nan")), ("c", None), ("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    v, g = F.col("v"), F.col("g")
    counts = count_facts([(df, [Fact("all", v), Fact("by", v, g), Fact("rows", key=g), Fact("large", v, where=v > 2)]), (df.limit(0), [Fact("none", v)])])
    got = {(r.fact, r.key): (r.median, r.n, r["mean"]) for r in summarise(counts).collect()}
    assert got[("all", "all")] == (5.0, 5, 21 / 5)
    assert got[("by", "a")] == (2.0, 2, 2.0) and got[("by", "c")] == (None, 0, None) and got[("by", None)] == (7.0, 1, 7.0)
    assert [got[("rows", k)][1] for k in ("a", "b", "c", None)] == [3, 2, 1, 2]
    # NaN is greater than any number to a comparison, and no known value.
    assert got[("large", "all")][:2] == (5.0, 4) and ("none", "all") not in got
    one = summarise(counts).agg(of("all", "median").alias("m"), leader("by", "median").alias("l"), leader("none", "n").alias("x")).first()
    assert one.m == 5.0 and tuple(one.l) == ("b", 5.0) and one.x is None
    assert counts.limit(1).select(quantile_of(counts, "all", 0.25).alias("q")).first().q == 3.0
    assert scans(summarise(counts)) and count_facts([(df, [Fact("n")])]).first().c == len(rows)


def test_weights_count_as_rows(spark):
    pairs = [("a", 1.0, 3), ("a", 2.0, 1), ("a", None, 9), ("b", 4.0, 0), ("b", 8.0, 2), ("c", None, 4)]
    df = spark.createDataFrame(pairs, "g string, v double, w long")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"m": 0.5, "q": 0.9}, size="n", mean="mean", weight="w").collect()}
    for g in "ab":
        values = [v for k, v, w in pairs if k == g and v is not None for _ in range(w)]
        assert got[g].m == statistics.median(values) and got[g].n == len(values)
        assert got[g]["mean"] == pytest.approx(statistics.mean(values))
    assert (got["c"].m, got["c"].n) == (None, 0)


def test_reports_read_each_table_once(spark, tmp_path):
    listings, days = market(spark, str(tmp_path))
    more = listings.withColumns({"calculated_host_listings_count": F.col("id") % 5, "availability_365": (F.col("id") * 7) % 365})
    days = days.withColumn("available", F.col("price") > 100)
    reports = [eda.eda_insights(more, days), rules.recommendations(more, days, "Entire home", "Private room"), rules.market_kpis(more), dashboard.seasonality(days)]
    for report in reports:
        # What is left to plan reads counts and groups; the tables were read by the counting job.
        assert all("c#" in line or "median#" in line for line in scans(report)), scans(report)

    # Each recommendation equals what its rule gives alone.
    got = [tuple(r)[1:] for r in reports[1].collect()]
    alone = [
        rules.rule_host_strategy(more), rules.rule_pricing_gap(more, "Entire home", "Private room"), rules.rule_neighbourhood_opportunity(more),
        rules.rule_guest_experience(more), rules.rule_weekend_premium(days),
    ]
    want = [tuple(r)[1:] for rule in alone for r in rule.collect()]
    assert got == want and len(got) >= 3
    assert rules.recommendations(more.limit(0), days).collect() == []
    assert len(eda.eda_insights(more.limit(0), days.limit(0)).collect()) == 9


def test_a_hot_key_is_counted_before_it_is_shuffled(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), (F.col("id") % 100).cast("double").alias("v"))
    counts = count_facts([(df, [Fact("by", F.col("v"), F.col("g"))])])
    assert counts.where("key = 'hot'").count() == 100
    assert summarise(counts).where("key = 'hot'").first().n == 200_000
