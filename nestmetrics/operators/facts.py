"""Several grouped figures of a table from one pass over it.

A fact is a key and a value of each row, such as stay type and price. The facts of a row are inlined as
(fact, key, value) and counted together, with map-side combining, and the counts are written to the
shared folder. Medians, means, shares and sizes of all facts are then one exact-quantile run over the
counts, so the table is read once however many figures a report needs, and a lost executor never
sends the work back to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions.exprs import finite
from nestmetrics.operators.quantiles import exact_quantiles
from nestmetrics.sources.sinks import stored


@dataclass(frozen=True)
class Fact:
    """A named (key, value) of each row that meets the condition; without a key, the whole table is one group."""

    name: str
    value: Column = field(default_factory=lambda: F.lit(1.0))
    key: Column = field(default_factory=lambda: F.lit("all"))
    where: Column = field(default_factory=lambda: F.lit(True))


def count_facts(sources: Sequence[tuple[DataFrame, Sequence[Fact]]]) -> DataFrame:
    """fact, key, v, c: how often each value occurs, over all facts of all tables. Null keys and values count too."""
    parts = []
    for df, facts in sources:
        drawn = [
            F.struct(
                F.lit(fact.name).alias("fact"), fact.key.cast("string").alias("key"), fact.value.cast("double").alias("v"),
                F.coalesce(fact.where, F.lit(False)).alias("wanted"),
            )
            for fact in facts
        ]
        if drawn:
            parts.append(df.select(F.inline(F.array(*drawn))).where("wanted").drop("wanted"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return stored(rows.groupBy("fact", "key", "v").agg(F.count(F.lit(1)).alias("c")), "fact-counts")


def summarise(counts: DataFrame, medians: Sequence[str] | None = None) -> DataFrame:
    """fact, key, median, n and mean of each group of counted facts; n counts known values.

    Only the facts named, or all, are put in order for their medians; for the others that is null.
    """
    ranked = counts if medians is None else counts.where(F.col("fact").isin(*medians))
    found = exact_quantiles(ranked, ["fact", "key"], "v", {"median": 0.5}, size="n", mean="mean", weight="c")
    if medians is None:
        return found
    v = finite(F.col("v"))
    known = F.sum(F.when(v.isNotNull(), F.col("c")).otherwise(0))
    plain = counts.where(~F.col("fact").isin(*medians)).groupBy("fact", "key").agg(
        F.lit(None).cast("double").alias("median"), known.alias("n"), F.try_divide(F.sum(v * F.col("c")), known.cast("double")).alias("mean")
    )
    return found.unionByName(plain)


def distinct_values(counts: DataFrame) -> DataFrame:
    """fact, key and n_distinct, the number of different known values. Counts hold each value of a group once."""
    return counts.groupBy("fact", "key").agg(F.count("v").alias("n_distinct"))


def quantile_of(counts: DataFrame, fact: str, p: float) -> Column:
    """A quantile of one fact without a key, as a scalar subquery."""
    return exact_quantiles(counts.where(F.col("fact") == fact), [], "v", {"q": p}, weight="c").scalar()


# Aggregates over a summary: figures of one fact, in one row with those of the others.


def of(fact: str, figure: str, key: str = "all") -> Column:
    """The figure of one group."""
    return F.max(F.when((F.col("fact") == fact) & (F.col("key") == key), F.col(figure)))


def of_fact(fact: str, figure: str) -> Column:
    """The figure of the fact, in an aggregate by key."""
    return F.max(F.when(F.col("fact") == fact, F.col(figure)))


def leader(fact: str, figure: str) -> Column:
    """(name, figure) of the group with the largest figure, ties to the smallest name; groups without name or figure don't count."""
    counts = (F.col("fact") == fact) & F.col("key").isNotNull() & F.col(figure).isNotNull()
    return F.min_by(
        F.struct(F.col("key").alias("name"), F.col(figure).alias("figure")), F.when(counts, F.struct(-F.col(figure), F.col("key")))
    )
