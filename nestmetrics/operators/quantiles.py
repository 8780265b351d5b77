"""Exact interpolated quantiles per group that never hold a group in one place.

The built-in ``median``/``percentile`` keep a value-to-count map of a whole group in one task's
memory. Here the rows are counted per (group, value) first, and the wanted ranks are then located
by three narrowing steps over bounded bucket levels (see ``radix``). All steps are partial
aggregates, bounded windows and equi-joins with the few buckets that hold a wanted rank, so a
group with a third of the rows costs no more per task than any other. The counts are shuffled
once; the later steps reuse that exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.functions.exprs import finite
from nestmetrics.operators.radix import bucket_levels


def median_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "median",
    extras: Mapping[str, Column] | None = None,
    size: str | None = None,
    mean: str | None = None,
) -> DataFrame:
    return exact_quantiles(df, keys, value, {name: 0.5}, extras, size, mean)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    extras: Mapping[str, Column] | None = None,
    size: str | None = None,
    mean: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per group: the keys, one column per probability, the extra aggregates.

    ``probs`` maps an output name to a probability; the value is interpolated between the two
    nearest ranks. Nulls and non-finite values are ignored; a group without values gets null.
    Null keys form a group of their own. ``size`` and ``mean`` name the number and the mean of the
    values, which cost nothing extra. ``extras`` are other aggregate expressions over the same
    groups; they need a second pass over the source. ``weight`` names a column that says how many rows a
    row stands for.
    """
    wanted = {}
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("_n") - 1)
        low = F.floor(position)
        wanted[name] = (low, F.ceil(position), position - low)
    located = _order_statistics(df, keys, value, wanted, weight)

    def interpolated(name: str) -> Column:
        low, high = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        fraction, gap = wanted[name][2], high - low
        # Stepping from the nearer rank, as array libraries do.
        between = (
            F.when(fraction == 0.5, (low + high) / 2)
            .when(fraction < 0.5, low + gap * fraction)
            .otherwise(high - gap * (F.lit(1.0) - fraction))
        )
        return between.alias(name)

    summary = []
    if size:
        summary.append(F.coalesce(F.col("_n"), F.lit(0)).alias(size))
    if mean:
        summary.append(F.try_divide(F.col("_s"), F.col("_n").cast("double")).alias(mean))
    located = located.select(*(["_g"] if keys else []), *[interpolated(name) for name in probs], *summary)
    names = [c for c in located.columns if c != "_g"]
    aggregates = [column.alias(name) for name, column in (extras or {}).items()]
    if not keys:
        if not aggregates:
            return located
        # One row on either side: the quantiles enter as a scalar subquery.
        found = located.select(F.struct(*names).alias("_q")).scalar()
        return (
            df.agg(*aggregates)
            .withColumn("_q", found)
            .select(*[F.col("_q").getField(name).alias(name) for name in names], *(extras or {}))
        )
    if aggregates:
        located = located.join(df.groupBy(F.struct(*keys).alias("_g")).agg(*aggregates), "_g")
    return located.select(*[F.col("_g").getField(k).alias(k) for k in keys], *names, *(extras or {}))


def rank_value(df: DataFrame, value: str, rank_of_n: Column, name: str = "value") -> DataFrame:
    """One row: the value at a zero-based rank, the rank given as an expression of ``_n``."""
    found = _order_statistics(df, [], value, {name: (rank_of_n, rank_of_n, F.lit(0.0))})
    return found.select(F.col(f"_lo_{name}").alias(name))


def global_quantile(df: DataFrame, value: str, p: float) -> Column:
    """A whole-table quantile as a scalar subquery, usable in any expression."""
    return exact_quantiles(df, [], value, {"q": p}).scalar()


def _order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: Mapping[str, tuple[Column, Column, Column]],
    weight: str | None = None,
) -> DataFrame:
    """``_g`` (if there are keys), ``_n``, ``_s`` (the sum) and the values at both ranks of each name."""
    group = ["_g"] if keys else []
    v = F.col(value) if isinstance(df.schema[value].dataType, T.IntegralType) else finite(F.col(value))
    # A struct of the keys is never null, so plain equality joins keep null keys.
    base = df.select(*([F.struct(*keys).alias("_g")] if keys else []), v.alias("_v"), *([F.col(weight).alias("_w")] if weight else []))
    number = F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")).otherwise(0)) if weight else F.count("_v")
    b1, b2 = bucket_levels(F.col("_v"), base.schema["_v"].dataType)
    counted = (
        base.withColumns({"_b1": b1, "_b2": b2}).groupBy(*group, "_b1", "_b2", "_v").agg(number.alias("_c"))
    )
    ranks = [rank for low, high, _ in wanted.values() for rank in (low, high)]

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_c"))

    # A group without any value keeps its (only, null) row so that it is reported.
    useful = reduce(lambda a, b: a | b, [holds(r) for r in ranks]) | (F.col("_n") == 0)

    def running(partition: Sequence[str], order: str) -> Column:
        earlier = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_c").over(earlier), F.lit(0))

    everything = Window.partitionBy(*group)
    # Level 1: buckets of a group. Level 2: finer buckets inside those that hold a wanted rank.
    # Level 3: the values inside those. Each window runs over a bounded number of rows.
    level1 = (
        counted.groupBy(*group, "_b1")
        .agg(F.sum("_c").alias("_c"), F.sum(F.col("_v").cast("double") * F.col("_c")).alias("_s"))
        .withColumns({"_n": F.sum("_c").over(everything), "_s": F.sum("_s").over(everything), "_before": running(group, "_b1")})
        .where(useful)
        .select(*group, "_b1", F.col("_before").alias("_start"), "_n", "_s")
    )
    level2 = (
        counted.join(level1, [*group, "_b1"])
        .groupBy(*group, "_b1", "_b2")
        .agg(F.sum("_c").alias("_c"), *[F.max(c).alias(c) for c in ("_start", "_n", "_s")])
        .withColumn("_before", F.col("_start") + running([*group, "_b1"], "_b2"))
        .where(useful)
        .select(*group, "_b1", "_b2", F.col("_before").alias("_start"), "_n", "_s")
    )
    level3 = (
        counted.join(level2, [*group, "_b1", "_b2"])
        .withColumn("_before", F.col("_start") + running([*group, "_b1", "_b2"], "_v"))
        .where(useful)
    )
    return level3.groupBy(*group).agg(
        F.max("_n").alias("_n"),
        F.max("_s").alias("_s"),
        *[
            F.max(F.when(holds(rank), F.col("_v"))).alias(f"_{side}_{name}")
            for name, (low, high, _) in wanted.items()
            for side, rank in (("lo", low), ("hi", high))
        ],
    )
