"""Sketches against exact figures, merged over skewed groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestmetrics.operators import sketches


@pytest.fixture(scope="module")
def prices(spark):
    """A third of the rows in month 0; heavy tails, one frequent value, nulls, and values that are no numbers."""
    return spark.range(300_000, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 17 END AS month",
        "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN 500D WHEN id % 1000 = 7 THEN double('NaN')"
        " WHEN id % 1000 = 17 THEN double('Infinity') ELSE exp(pmod(hash(id), 100000) / 10000D) END AS v",
        "pmod(hash(id), 40000) AS k",
    )


@pytest.mark.parametrize("months", [range(17), range(3), [5], [0]])
def test_merged_ranks_are_within_the_bound(prices, months):
    kept = sketches.quantile_sketches(prices, ["month"], "v")
    probs = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q99": 0.99}
    got = sketches.merged_quantiles(kept.where(F.col("month").isin(*months)), [], probs).first()
    rows = prices.where(F.col("month").isin(*months)).where("v IS NOT NULL AND NOT isnan(v) AND v < double('Infinity')")
    values = np.sort(np.array([r.v for r in rows.select("v").collect()]))
    assert got.n == len(values)
    for name, p in probs.items():
        low, high = np.searchsorted(values, got[name], "left"), np.searchsorted(values, got[name], "right")
        assert low / len(values) - sketches.RANK_ERROR <= p <= high / len(values) + sketches.RANK_ERROR


def test_united_counts_are_within_the_bound(prices):
    kept = sketches.distinct_sketches(prices, ["month"], ["k", "v"])
    for months in (range(17), range(4), [9]):
        part = prices.where(F.col("month").isin(*months))
        got = sketches.merged_distinct(kept.where(F.col("month").isin(*months)), [], ["k", "v"]).first()
        want = part.agg(F.countDistinct("k").alias("k"), F.countDistinct("v").alias("v")).first()
        for c in ("k", "v"):
            assert abs(got[c] - want[c]) <= sketches.DISTINCT_ERROR * want[c]


def test_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 2.0), ("b", -0.0), ("b", 0.0), (None, 1.0)], "g string, v double")
    kept = sketches.quantile_sketches(df, ["g"], "v")
    got = {r.g: (r.n, r.q) for r in sketches.merged_quantiles(kept, ["g"], {"q": 0.9}).collect()}
    assert got == {"a": (0, None), "b": (3, 2.0), None: (1, 1.0)}
    assert sketches.merged_quantiles(kept.limit(0), ["g"], {"q": 0.5}).isEmpty()
    counts = sketches.merged_distinct(sketches.distinct_sketches(df.where("NOT isnan(v) OR v IS NULL"), ["g"], ["v"]), ["g"], ["v"])
    assert {r.g: r.v for r in counts.collect()} == {"a": 0, "b": 2, None: 1}


def test_sketches_are_aggregated_before_the_shuffle(prices):
    plan = sketches.merged_quantiles(sketches.quantile_sketches(prices, ["month"], "v"), [], {"q": 0.5})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in text and "partial_kll_merge_agg_double" in text
