"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.operators.joins import lookup_key, star_join
from nestmetrics.plans import enrich
from nestmetrics.plans.warehouse import listings_from_star


@query(
    "join_calendar_agg",
    """SELECT id, calendar_days_total, calendar_days_unavailable, average_calendar_price,
       estimated_occupancy_rate_365d FROM enriched""",
)
def _(m):
    return enrich.join_calendar_aggregates(m.listings, m.calendar).select(
        "id",
        "calendar_days_total",
        "calendar_days_unavailable",
        "average_calendar_price",
        "estimated_occupancy_rate_365d",
    )


@query("join_review_agg", "SELECT id, total_review_count, review_first_date, review_last_date FROM enriched")
def _(m):
    return enrich.join_review_aggregates(m.listings, m.reviews).select(
        "id", "total_review_count", "review_first_date", "review_last_date"
    )


@query(
    "lookup_neighbourhood_key",
    """SELECT l.id, n.neighbourhood_key FROM listings l
       LEFT JOIN dim_neighbourhood n ON n.neighbourhood_name =
           CASE WHEN l.id % 13 = 0 THEN 'elsewhere' WHEN l.id % 17 <> 0 THEN l.neighbourhood_cleansed END""",
)
def _(m):
    """With names the dimension does not know, and missing names."""
    i = F.col("id")
    area = F.when(i % 13 == 0, "elsewhere").when(i % 17 != 0, F.col("neighbourhood_cleansed")).alias("area")
    rows = m.listings.select("id", area)
    return lookup_key(rows, m.star.dim_neighbourhood, "area", "neighbourhood_name", "neighbourhood_key").drop("area")


@query("lookup_host_key", "SELECT l.id, h.host_key FROM listings l LEFT JOIN dim_host h ON l.host_id = h.host_id")
def _(m):
    rows = m.listings.select("id", F.col("host_id").alias("host"))
    return lookup_key(rows, m.star.dim_host, "host", "host_id", "host_key").drop("host")


@query(
    "lookup_listing_key",
    """SELECT c.listing_id, c.date, k.listing_key FROM calendar c
       LEFT JOIN (SELECT listing_id // 2 AS half, max(listing_key) AS listing_key FROM dim_listing GROUP BY 1) k
       ON c.listing_id = k.half""",
)
def _(m):
    """Natural keys that repeat in the dimension: the largest surrogate key counts."""
    dim = m.star.dim_listing.select(F.floor(F.col("listing_id") / 2).alias("half"), "listing_key")
    rows = m.calendar.select("listing_id", "date")
    return lookup_key(rows, dim, "listing_id", "half", "listing_key", unique=False)


@query(
    "star_join_2",
    """SELECT l.room_type, f.price, f.listing_key FROM fact_listing_snapshot f
       JOIN dim_listing l ON f.listing_key = l.listing_key WHERE f.price > 0""",
)
def _(m):
    star = m.star
    fact = star.fact_listing_snapshot.where(F.col("price") > 0).select("listing_key", "price")
    return star_join(fact, star.dim_listing.select("listing_key", "room_type"), "listing_key")


@query(
    "star_join_3",
    """SELECT f.listing_key, f.price, n.neighbourhood_name FROM fact_listing_snapshot f
       JOIN dim_listing l ON f.listing_key = l.listing_key
       JOIN dim_neighbourhood n ON l.neighbourhood_key = n.neighbourhood_key""",
)
def _(m):
    star = m.star
    fact = star.fact_listing_snapshot.select("listing_key", "price")
    rows = star_join(fact, star.dim_listing.select("listing_key", "neighbourhood_key"), "listing_key")
    return star_join(rows, star.dim_neighbourhood, "neighbourhood_key").select(
        "listing_key", "price", "neighbourhood_name"
    )


@query(
    "star_join_mixed",
    """SELECT f.listing_key, f.number_of_reviews, n.neighbourhood_name FROM fact_listing_snapshot f
       JOIN dim_listing l ON f.listing_key = l.listing_key
       LEFT JOIN (SELECT * FROM dim_neighbourhood WHERE neighbourhood_key % 2 = 0) n
       ON l.neighbourhood_key = n.neighbourhood_key""",
)
def _(m):
    star = m.star
    even = star.dim_neighbourhood.where(F.col("neighbourhood_key") % 2 == 0)
    rows = star_join(
        star.fact_listing_snapshot.select("listing_key", "number_of_reviews"),
        star.dim_listing.select("listing_key", "neighbourhood_key"),
        "listing_key",
    )
    return star_join(rows, even, "neighbourhood_key", "left").select(
        "listing_key", "number_of_reviews", "neighbourhood_name"
    )


@query(
    "join_dim_fact_all",
    "SELECT * FROM dim_listing LEFT JOIN fact_listing_snapshot USING (listing_key)",
)
def _(m):
    return listings_from_star(m.star)
