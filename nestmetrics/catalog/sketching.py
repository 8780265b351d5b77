"""Quantiles and distinct counts from sketches by month and area, held against the exact figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.operators import sketches
from nestmetrics.operators.facts import Fact, count_facts, distinct_values
from nestmetrics.sources.sinks import stored

PROBS = {"p05": 0.05, "p50": 0.5, "p95": 0.95}


def _area_days(m) -> DataFrame:
    """Calendar days with their month and the area of their listing."""
    areas = m.enriched.select(F.col("id").alias("listing_id"), F.col("neighbourhood_cleansed").alias("area"), "host_id")
    month = F.date_format("date", "yyyy-MM").alias("month")
    return m.calendar.join(areas, "listing_id").select(month, "area", "listing_id", "host_id", "price")


def _spans(quarter: Column, area: Column) -> dict[str, Column]:
    """The spans that are asked for: each quarter, each area, and everything."""
    return {"quarter": quarter, "area": area, "all": F.lit("all")}


def _quarter(month: str) -> Column:
    return F.concat(F.substring(month, 1, 4), F.lit("-Q"), F.ceil(F.substring(month, 6, 2).cast("int") / 3).cast("string"))


def _over_spans(kept: DataFrame, merge) -> DataFrame:
    parts = [
        merge(kept.withColumns({"kind": F.lit(kind), "span": key}))
        for kind, key in _spans(_quarter("month"), F.col("area")).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _exact(m, days: DataFrame, value: str) -> DataFrame:
    return count_facts(
        [(days, [Fact(kind, F.col(value), key) for kind, key in _spans(_quarter("month"), F.col("area")).items()])]
    )


DAYS = """, days AS (
    SELECT strftime(date, '%Y-%m') AS month, year(date) || '-Q' || quarter(date) AS q, neighbourhood_cleansed AS area,
           listing_id, host_id, c.price
    FROM calendar c JOIN enriched e ON listing_id = id),
spans AS (
    SELECT 'quarter' AS kind, q AS span, * FROM days UNION ALL SELECT 'area', area, * FROM days
    UNION ALL SELECT 'all', 'all', * FROM days)"""


@query(
    "quantile_sketches",
    f"""{DAYS} SELECT kind, span, p, count(price) AS n, true AS within FROM spans, (VALUES ('p05'), ('p50'), ('p95')) v(p)
    GROUP BY ALL""",
)
def _(m):
    """Price quantiles of quarters, areas and everything, merged from sketches kept by month and area.

    ``within``: the share of prices below the estimate, and of those up to it, enclose the probability, give or
    take the rank error.
    """
    days = _area_days(m)
    kept = stored(sketches.quantile_sketches(days, ["month", "area"], "price"), "quantile-sketches")
    found = _over_spans(kept, lambda s: sketches.merged_quantiles(s, ["kind", "span"], PROBS))
    asked = found.select(
        "kind", "span", "n",
        F.inline(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(share).alias("share"), F.col(p).alias("estimate")) for p, share in PROBS.items()])),
    )
    counts = _exact(m, days, "price").withColumnsRenamed({"fact": "kind", "key": "span"})
    # Joined on a struct of the span, which is never null: days without a date are a span of their own.
    same = F.struct("kind", "span").alias("_g")
    below = (
        asked.select(same, "kind", "span", "n", "p", "share", "estimate")
        .join(counts.where(F.col("v").isNotNull()).select(same, "v", "c"), "_g", "left")
        .groupBy("kind", "span", "n", "p", "share")
        .agg(
            F.sum(F.when(F.col("v") < F.col("estimate"), F.col("c")).otherwise(0)).alias("_less"),
            F.sum(F.when(F.col("v") <= F.col("estimate"), F.col("c")).otherwise(0)).alias("_upto"),
        )
    )
    # One value is the finest step that a rank can be told to.
    slack = F.lit(sketches.RANK_ERROR) + F.try_divide(F.lit(1.0), F.col("n"))
    enclosed = (F.col("_less") <= (F.col("share") + slack) * F.col("n")) & (F.col("_upto") >= (F.col("share") - slack) * F.col("n"))
    return below.select("kind", "span", "p", "n", F.coalesce(enclosed, F.lit(True)).alias("within"))


@query(
    "count_distinct_sketches",
    f"""{DAYS} SELECT kind, span, count(DISTINCT listing_id) AS listings, true AS within FROM spans GROUP BY ALL""",
)
def _(m):
    """Listings on offer in quarters, areas and everything: counted, and whether sketches by month and area agree to 3 %."""
    days = _area_days(m)
    kept = stored(sketches.distinct_sketches(days, ["month", "area"], ["listing_id"]), "distinct-sketches")
    found = _over_spans(kept, lambda s: sketches.merged_distinct(s, ["kind", "span"], ["listing_id"]))
    exact = distinct_values(_exact(m, days, "listing_id")).withColumnsRenamed({"fact": "kind", "key": "span"})
    same = F.struct("kind", "span").alias("_g")
    joined = found.select(same, "kind", "span", F.col("listing_id").alias("estimate")).join(exact.select(same, "n_distinct"), "_g")
    error = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.lit(sketches.DISTINCT_ERROR) * F.col("n_distinct")
    return joined.select("kind", "span", F.col("n_distinct").alias("listings"), error.alias("within"))
