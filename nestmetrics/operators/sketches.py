"""Sketches of quantiles and distinct counts, kept for small spans and merged for any larger one.

A table of sketches by month and area, say, answers for every range of months and every set of areas without
another look at the rows, and a new month adds its own rows of sketches. Sketches are Spark's: their size
depends on their accuracy, not on the rows they stand for, so they are aggregated before the shuffle like a sum.
Exact figures stay with ``quantiles`` and ``facts``; these are for where a stated error will do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions.exprs import finite

#: Accuracy of quantile sketches: ranks are off by less than RANK_ERROR of the rows, at this size with a wide margin.
QUANTILE_K = 800
RANK_ERROR = 0.01
#: Accuracy of distinct sketches, as a power of two: 2**14 registers give a standard error below 0.8 %.
DISTINCT_LG_K = 14
DISTINCT_ERROR = 0.03


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = QUANTILE_K) -> DataFrame:
    """The keys and ``sketch``, of the finite values of each group. A group without any has an empty sketch."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(finite(F.col(value).cast("double")), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], probs: Mapping[str, float], k: int = QUANTILE_K) -> DataFrame:
    """The keys, ``n`` and one column for each probability, over the merged sketches of each group.

    A quantile is a value that occurs, not interpolated. A group without values gets 0 and nulls. Sketches
    of different sizes can be merged.
    """
    n = F.kll_sketch_get_n_double("_all")
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("_all")).withColumn("n", n)
    # An empty sketch has no quantiles to ask for.
    full = F.when(F.col("n") > 0, F.col("_all"))
    return merged.select(
        *keys, "n", *[F.kll_sketch_get_quantile_double(full, F.lit(float(p))).alias(name) for name, p in probs.items()]
    )


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str], lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """The keys and, under each column's name, a sketch of its different values; nulls do not count."""

    def hashed(c: str) -> Column:
        # The 64-bit hash takes every type and holds 0.0 and -0.0 equal.
        return F.when(F.col(c).isNotNull(), F.xxhash64(c))

    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(hashed(c), F.lit(lg_k)).alias(c) for c in columns])


def merged_distinct(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The keys and, for each column, the estimated number of different values in the united sketches."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
