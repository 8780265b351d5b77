"""Equi-joins on unique right-hand keys.

No broadcast hints: the size of the right side is only known at run time, where adaptive execution
broadcasts it if it is small and splits hot (or null) left partitions of a sort-merge join if not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join that keeps every left row and drops the right key."""
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])


def lookup_key(
    left: DataFrame, dim: DataFrame, left_key: str, natural_key: str, out: str, unique: bool = True
) -> DataFrame:
    """Attach a surrogate key by natural key; unmatched rows get null.

    With ``unique=False`` the largest surrogate key counts where a natural key repeats. Such a side has as many
    rows as the left one; a merge join keeps two pruned columns of it from being taken for a small table.
    """
    keys = dim.where(F.col(natural_key).isNotNull()).select(F.col(natural_key).alias("_natural"), out)
    if not unique:
        keys = keys.groupBy("_natural").agg(F.max(out).alias(out)).hint("merge")
    return left.join(keys, left[left_key] == keys["_natural"], "left").drop("_natural")


def star_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Fact to dimension by surrogate key, the key kept once."""
    return fact.join(dim, key, how)
