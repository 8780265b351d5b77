"""Order-based operators against brute force, on skewed and awkward data."""

import math
import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestmetrics.operators import ordering
from nestmetrics.operators.histogram import histogram
from nestmetrics.operators.joins import lookup_key
from nestmetrics.operators.ordering import (
    argmax_row, dedupe_keep_first, mid_ranks, number_rows, prefix_sums, sample_fixed_n, surrogate_key, top_k,
)
from nestmetrics.operators.quantiles import exact_quantiles, global_quantile, median_by, rank_value
from nestmetrics.operators.radix import bucket_levels


def skewed(n=3000, seed=1):
    """A third of the rows in one group, a third of those one value; nulls, zeros, negatives, extremes."""
    rnd = random.Random(seed)
    data = []
    for _ in range(n):
        group = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        kind = rnd.random()
        if kind < 0.1:
            value = None
        elif kind < 0.4:
            value = 1000.0
        elif kind < 0.5:
            value = 0.0
        elif kind < 0.6:
            value = -rnd.random() * 10 ** rnd.randint(-8, 8)
        else:
            value = round(rnd.lognormvariate(7, 2), 2)
        data.append((group, value))
    data += [("hot", 1e300), ("hot", -1e300), ("hot", 5e-324), ("hot", float("inf")), ("hot", float("nan")), ("void", None)]
    return data


def finite(values):
    return [v for v in values if v is not None and math.isfinite(v)]


def test_grouped_quantiles_match_brute_force(spark):
    data = skewed()
    df = spark.createDataFrame(data, "g string, v double")
    probs = {"q01": 0.01, "q50": 0.5, "q80": 0.8, "q99": 0.99}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, {"n": F.count(F.lit(1))}).collect()}
    groups = {g for g, _ in data}
    assert set(got) == groups
    for g in groups:
        values = finite([v for k, v in data if k == g])
        assert got[g].n == sum(k == g for k, _ in data)
        for name, p in probs.items():
            want = float(np.quantile(values, p)) if values else None
            assert got[g][name] == pytest.approx(want, rel=1e-12) if values else got[g][name] is None


def test_two_keys_and_no_extras(spark):
    df = spark.createDataFrame([(1, None, 5.0), (1, None, 7.0), (1, "x", None), (2, "x", 3.0)], "a int, b string, v double")
    got = {(r.a, r.b): r.m for r in median_by(df, ["a", "b"], "v", "m").collect()}
    assert got == {(1, None): 6.0, (1, "x"): None, (2, "x"): 3.0}


def test_global_quantiles(spark):
    values = finite([v for _, v in skewed()])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, [], "v", {"m": 0.5}, {"n": F.count("v"), "top": F.max("v")}).first()
    assert (row.m, row.n, row.top) == (statistics.median(values), len(values), max(values))
    below = df.where(F.col("v") < global_quantile(df, "v", 0.99)).count()
    assert below == sum(v < np.quantile(values, 0.99) for v in values)


def test_size_and_mean_come_along(spark):
    data = skewed()
    df = spark.createDataFrame([(g, v) for g, v in data if v is None or abs(v) < 1e9], "g string, v double")
    got = {r.g: r for r in median_by(df, ["g"], "v", "m", {"all": F.count(F.lit(1))}, size="n", mean="mean").collect()}
    for g in got:
        values = finite([v for k, v in data if k == g and v is not None and abs(v) < 1e9])
        assert got[g].n == len(values) and got[g]["all"] >= len(values)
        assert got[g]["mean"] == (pytest.approx(sum(values) / len(values)) if values else None)
    whole = median_by(df, [], "v", "m", size="n").first()
    assert whole.n == sum(r.n for r in got.values())


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert median_by(empty, ["g"], "v").collect() == []
    assert median_by(empty, [], "v", "m", {"n": F.count(F.lit(1))}).first() == (None, 0)
    nulls = spark.createDataFrame([("a", None)], "g string, v double")
    assert [tuple(r) for r in median_by(nulls, ["g"], "v").collect()] == [("a", None)]


def test_integer_quantiles(spark):
    values = [random.Random(3).randint(-(2**62), 2**62) for _ in range(500)] + [7] * 300
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = rank_value(df, "v", F.floor(F.col("_n") / 3)).first().value
    assert got == sorted(values)[len(values) // 3]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=60))
def test_median_of_any_floats(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = sorted(values)
    low, high = want[(len(want) - 1) // 2], want[len(want) // 2]
    got = median_by(df, [], "v", "m").first().m
    assert got == (low + high) / 2 or (math.isinf(low + high) and got is not None)


def test_bucket_codes_never_decrease(spark):
    values = sorted(finite([v for _, v in skewed(6000, 9)]) + [2.0**k for k in range(-60, 60)] + [-(2.0**k) for k in range(-60, 60)])
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    b1, b2 = bucket_levels(F.col("v"), df.schema["v"].dataType)
    codes = [(r.b1, r.b2) for r in df.select("i", b1.alias("b1"), b2.alias("b2")).orderBy("i").collect()]
    assert codes == sorted(codes)


def test_prefix_sums(spark):
    values = sorted(set(finite([v for _, v in skewed()])))
    df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(values)], "v double, w int")
    got = {r.v: r.before for r in prefix_sums(df, "v", {"before": "w"}).collect()}
    total = 0
    for i, v in enumerate(values):
        assert got[v] == total
        total += i % 5


@pytest.mark.parametrize("ddl,values", [
    ("long", [5, -3, 10**18, 10**18 + 1, 0, 2**40, -(2**62)]),
    ("string", ["Old Town", "Old Port", "Old Tower", "", "Ärea", "Old Towns", "Z"]),
    ("date", None),
])
def test_surrogate_keys_are_dense_and_ordered(spark, ddl, values):
    if values is None:
        import datetime as dt

        values = [dt.date(2020, 1, 1) + dt.timedelta(days=37 * i) for i in range(9)]
    shuffled = random.Random(5).sample(values, len(values))
    df = spark.createDataFrame([(v,) for v in shuffled], f"v {ddl}")
    got = surrogate_key(df, "v", "k").collect()
    want = sorted(values, key=lambda v: v.encode() if isinstance(v, str) else v)
    assert [r.v for r in sorted(got, key=lambda r: r.k)] == want
    assert sorted(r.k for r in got) == list(range(1, len(values) + 1))


def test_surrogate_keys_with_copies_are_still_dense(spark):
    df = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id")
    keys = sorted(r.k for r in surrogate_key(df, "id", "k").collect())
    assert keys == list(range(1, 901))


def test_names_with_one_long_prefix_are_dealt_to_many_tasks(spark):
    df = spark.range(100_000).selectExpr("concat('the same long beginning of a name ', lpad(id * 7919 % 100000, 6, '0')) AS name")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    keyed = surrogate_key(df, "name", "k").cache()
    assert keyed.selectExpr("min(k)", "max(k)", "count(DISTINCT k)").first() == (1, 100_000, 100_000)
    assert keyed.where("k <> int(right(name, 6)) + 1").count() == 0
    tasks = [r[0] for r in keyed.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(tasks) > 1 and max(tasks) < 50_000
    keyed.unpersist()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_mid_ranks(spark):
    data = [("x", v) for v in (1.0, 1.0, 2.0, 9.0)] + [("y", v) for v in (1.0, 2.0, 3.0, None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.v: (r.ties, r.x, r.mid_rank) for r in mid_ranks(df, "v", {"x": F.col("g") == "x"}).collect()}
    assert got == {1.0: (3, 2, 2.0), 2.0: (2, 1, 4.5), 3.0: (1, 0, 6.0), 9.0: (1, 1, 7.0)}


@pytest.mark.parametrize("bins", [1, 7, 50])
def test_histogram_matches_numpy(spark, bins):
    values = [float(v) for v in np.random.default_rng(2).integers(0, 1000, 700)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = histogram(df, "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_constant_and_nothing(spark):
    same = spark.createDataFrame([(5.0,)] * 3, "v double")
    got = histogram(same, "v", 10).orderBy("bin").collect()
    assert [r["count"] for r in got] == np.histogram([5.0] * 3, bins=10)[0].tolist()
    assert histogram(spark.createDataFrame([], "v double"), "v", 10).collect() == []


def test_dedupe_keeps_the_first_row_per_key(spark):
    data = [("a", 3, "late"), ("a", 1, None), ("b", 2, "only"), (None, 9, "null key"), (None, 8, "first null")]
    df = spark.createDataFrame(data, "k string, o int, t string")
    got = sorted(map(tuple, dedupe_keep_first(df, ["k"], "o").collect()), key=str)
    assert got == [("a", 1, None), ("b", 2, "only"), (None, 8, "first null")]
    assert dedupe_keep_first(df, ["k"], "o", drop_null_keys=True).count() == 2


def test_lookup_takes_the_last_key_of_a_repeated_name(spark):
    left = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "n string")
    dim = spark.createDataFrame([("a", 1), ("a", 4), ("b", 2), (None, 3)], "name string, k long")
    got = sorted(map(tuple, lookup_key(left, dim, "n", "name", "k", unique=False).collect()), key=str)
    assert got == [("a", 4), ("b", 2), ("z", None), (None, None)]


def test_sampling_is_exact_and_repeatable(spark):
    df = spark.range(1000)
    first = sample_fixed_n(df, "id", 100).collect()
    again = sample_fixed_n(df.repartition(13), "id", 100).collect()
    assert len(first) == len(set(first)) == 100 and sorted(first) == sorted(again)
    assert sorted(first) != sorted(sample_fixed_n(df, "id", 100, seed=7).collect())
    assert sample_fixed_n(df, "id", 5000).count() == 1000


def test_top_k_argmax_and_numbering(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", None), ("c", 5.0), ("d", 5.0)], "n string, v double")
    assert [r.n for r in top_k(df, [F.desc_nulls_last("v"), F.asc("n")], 3).collect()] == ["c", "d", "a"]
    assert argmax_row(df.where("n <> 'd'"), "v").first().n == "c"
    assert argmax_row(df.where("v is null"), "v").collect() == []
    assert [tuple(r) for r in number_rows(df.select("n", F.col("n").alias("_o")), "_o", "i").collect()] == [
        (1, "a"), (2, "b"), (3, "c"), (4, "d"),
    ]


def test_quantiles_scan_the_source_once_and_keep_no_value_map(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 7 END AS g", "double(id % 1000) AS v")
    result = median_by(df, ["g"], "v")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Range (") == 1 and "ReusedExchange" in plan and "percentile" not in plan


def test_hot_key_of_a_lookup_is_split(spark):
    """A third of the rows share one key: adaptive execution splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 60000, 1, 8).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS host")
        dim = spark.range(0, 60000, 1, 4).selectExpr("id AS host_id", "id + 1 AS host_key")
        joined = lookup_key(left, dim, "host", "host_id", "host_key")
        assert joined.agg(F.sum("host_key")).first()[0] == sum((5 if i % 3 == 0 else i) + 1 for i in range(60000))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_hot_keys_are_numbered_by_pieces(spark, monkeypatch):
    """A million nulls, a million copies of one key and ids around them: dense, in order, no large window."""
    window_rows = 2**16
    df = spark.range(2_200_000, numPartitions=9).selectExpr(
        "CASE WHEN id < 1000000 THEN NULL WHEN id < 2000000 THEN 77 ELSE id - 2000000 END AS v", "id AS row"
    )
    largest = []
    pieces = ordering._key_by_pieces

    def watched(crowded, *rest):
        largest.append(crowded.groupBy("v", F.shiftright(F.monotonically_increasing_id(), 16)).count().agg(F.max("count")).first()[0])
        return pieces(crowded, *rest)

    monkeypatch.setattr(ordering, "_key_by_pieces", watched)
    keyed = surrogate_key(df, "v", "k", window_rows=window_rows).cache()
    assert largest and largest[0] <= window_rows
    assert keyed.columns == ["k", "v", "row"]
    assert keyed.selectExpr("min(k)", "max(k)", "count(DISTINCT k)", "count(DISTINCT row)").first() == (1, 2_200_000, 2_200_000, 2_200_000)
    assert keyed.where("v IS NULL").selectExpr("min(k)", "max(k)").first() == (1, 1_000_000)
    # 0..76 once each, 77 a million and one times, the rest once each.
    assert keyed.where("v = 77").selectExpr("min(k)", "max(k)").first() == (1_000_078, 2_000_078)
    assert keyed.where("v < 77 AND k <> 1000001 + v").count() == 0
    assert keyed.where("v > 77 AND k <> 2000001 + v").count() == 0
    keyed.unpersist()


@pytest.mark.parametrize("window_rows", [1, 3])
def test_pieces_number_like_windows(spark, window_rows):
    values = [None, None, None, 5.0, 5.0, -1.5, 0.0, -0.0, 1e300, 5.0, 7.25, 2.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.v for r in surrogate_key(df, "v", "k", window_rows=window_rows).orderBy("k").collect()]
    assert got == sorted(values, key=lambda v: (v is not None, v or 0.0))
    empty = surrogate_key(df.limit(0), "v", "k", window_rows=window_rows)
    assert empty.columns == ["k", "v"] and empty.isEmpty()
