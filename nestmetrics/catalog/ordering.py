"""Keys, ranks, sorting, limits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.operators.ordering import (
    argmax_row,
    mid_ranks,
    number_rows,
    prefix_sums,
    sample_fixed_n,
    surrogate_key,
    top_k,
)
from nestmetrics.plans import quality


@query("surrogate_key", "SELECT row_number() OVER (ORDER BY id) AS listing_key, id, price FROM listings")
def _(m):
    return surrogate_key(m.listings.select("id", "price"), "id", "listing_key")


@query(
    "surrogate_key_copies",
    "SELECT row_number() OVER (ORDER BY price NULLS FIRST) AS price_key, price FROM calendar",
)
def _(m):
    """Keys of a column that many rows share, null among its values: full buckets are numbered by pieces."""
    return surrogate_key(m.calendar.select("price"), "price", "price_key", window_rows=2**12)


@query(
    "report_row_id",
    """SELECT CAST(row_number() OVER (ORDER BY room_type) AS INTEGER) AS row_id, room_type AS label, n FROM (
         SELECT room_type, count(*) AS n FROM listings GROUP BY room_type)""",
)
def _(m):
    counts = m.listings.groupBy("room_type").agg(F.count(F.lit(1)).alias("n"))
    labelled = counts.select(F.col("room_type").alias("_order"), F.col("room_type").alias("label"), "n")
    return number_rows(labelled, "_order", "row_id")


@query(
    "distributed_prefix_sum",
    """SELECT price, days, CAST(coalesce(sum(days) OVER (ORDER BY price ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
       AS BIGINT) AS days_before
       FROM (SELECT price, count(*) AS days FROM calendar WHERE price IS NOT NULL GROUP BY price)""",
)
def _(m):
    counts = m.calendar.where(F.col("price").isNotNull()).groupBy("price").agg(F.count(F.lit(1)).alias("days"))
    return prefix_sums(counts, "price", {"days_before": "days"})


@query(
    "average_rank_ties",
    """SELECT price, ties, weekend_days, before + (ties + 1) / 2.0::DOUBLE AS mid_rank FROM (
         SELECT price, count(*) AS ties, count(*) FILTER (WHERE isodow(date) IN (5, 6)) AS weekend_days,
                rank() OVER (ORDER BY price) AS dense, sum(count(*)) OVER (ORDER BY price) - count(*) AS before
         FROM calendar WHERE price IS NOT NULL GROUP BY price)""",
)
def _(m):
    weekend = F.coalesce(F.weekday("date").isin(4, 5), F.lit(False))
    return mid_ranks(m.calendar, "price", {"weekend_days": weekend})


@query("sort", "SELECT id, room_type, price FROM listings ORDER BY room_type, price DESC NULLS LAST, id")
def _(m):
    return m.listings.select("id", "room_type", "price").orderBy(
        F.asc_nulls_last("room_type"), F.desc_nulls_last("price"), F.asc("id")
    )


@query("top_k", "SELECT id, price FROM listings ORDER BY price DESC NULLS LAST, id LIMIT 15")
def _(m):
    return top_k(m.listings.select("id", "price"), [F.desc_nulls_last("price"), F.asc("id")], 15)


@query(
    "limit_unordered",
    "SELECT listing_id, date, available, price FROM calendar WHERE price IS NOT NULL",
)
def _(m):
    """All known prices: what a single machine shows the first rows of for want of memory."""
    return m.calendar.where(F.col("price").isNotNull()).select("listing_id", "date", "available", "price")


@query(
    "argmax_row",
    """SELECT host_id, rating FROM (SELECT host_id, sum(review_scores_rating) AS rating FROM listings GROUP BY host_id)
       ORDER BY rating DESC NULLS LAST, host_id DESC LIMIT 1""",
)
def _(m):
    totals = m.listings.groupBy("host_id").agg(F.sum("review_scores_rating").alias("rating"))
    return argmax_row(totals.withColumn("_by", F.struct("rating", "host_id")).where("rating is not null"), "_by").drop("_by")


@query(
    "append_rows",
    """SELECT 'listings' AS table_name, count(*) AS total_rows FROM listings
       UNION ALL SELECT 'calendar', count(*) FROM calendar UNION ALL SELECT 'reviews', count(*) FROM reviews""",
)
def _(m):
    report = None
    for name in ("listings", "calendar", "reviews"):
        part = quality.star_check(getattr(m, name), name, F.lit(False)).select(
            F.col("check_name").alias("table_name"), "total_rows"
        )
        report = part if report is None else report.unionByName(part)
    return report


@query(
    "sample_fixed_n",
    """SELECT id, price FROM listings
       ORDER BY ('0x' || substr(md5(id || ':42'), 1, 15))::BIGINT, id LIMIT 5000""",
)
def _(m):
    return sample_fixed_n(m.listings.select("id", "price"), "id", 5000)
