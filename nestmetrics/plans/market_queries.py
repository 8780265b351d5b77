"""The eight market questions on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.operators.facts import Fact, count_facts, distinct_values, of_fact, summarise
from nestmetrics.operators.joins import star_join
from nestmetrics.operators.ordering import top_k
from nestmetrics.operators.quantiles import median_by
from nestmetrics.plans.warehouse import Star

PRICED = "price > 0"


def _round(c: Column, digits: int) -> Column:
    return F.round(c, digits)


def _priced_listings(star: Star, *columns: str) -> DataFrame:
    """Priced snapshots with the chosen columns of their listing."""
    return star_join(star.fact_listing_snapshot.where(PRICED), star.dim_listing.select("listing_key", *columns), "listing_key")


def _with_area(listings: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    areas = star.dim_neighbourhood.select("neighbourhood_key", "neighbourhood_name")
    return star_join(listings, areas, "neighbourhood_key", how)


def _priced_days(star: Star, *columns: str) -> DataFrame:
    return star_join(star.fact_calendar.where(PRICED), star.dim_date.select("date_key", *columns), "date_key")


def price_by_neighbourhood(star: Star) -> DataFrame:
    rows = _with_area(_priced_listings(star, "neighbourhood_key"), star)
    result = median_by(rows, ["neighbourhood_name"], "price", "median_price", size="listing_count")
    return result.orderBy(F.desc_nulls_last("median_price"), "neighbourhood_name")


def price_by_room_type(star: Star) -> DataFrame:
    rows = _priced_listings(star, "room_type")
    stats = median_by(rows, ["room_type"], "price", "median_price", size="listing_count", mean="avg_price")
    return stats.orderBy(F.desc_nulls_last("median_price"), "room_type")


def top_hosts(star: Star, k: int = 20) -> DataFrame:
    hosts = star.dim_host.select(
        "host_id", "host_name", "calculated_host_listings_count", "host_is_superhost", "host_tier"
    )
    return top_k(hosts, [F.desc_nulls_last("calculated_host_listings_count"), F.asc("host_id")], k)


def professional_vs_casual(star: Star) -> DataFrame:
    """Figures by kind of host, from one reading of the star join.

    Listings and hosts are counted by key first, so that no group is one task's set.
    """
    listings = star.dim_listing.select("listing_key", "host_key")
    hosts = star.dim_host.select("host_key", "host_id", "is_professional_host")
    rows = star_join(star_join(star.fact_listing_snapshot, listings, "listing_key"), hosts, "host_key")
    kind = F.col("is_professional_host")
    figures = ("price", "review_scores_rating", "availability_365")
    counts = count_facts([(rows, [Fact(c, F.col(c), kind) for c in (*figures, "listing_key", "host_id")])])
    is_figure = F.col("fact").isin(*figures)
    groups = summarise(counts.where(is_figure), ["price"]).unionByName(distinct_values(counts.where(~is_figure)), allowMissingColumns=True)
    return groups.groupBy(F.col("key").cast("boolean").alias("is_professional_host")).agg(
        of_fact("listing_key", "n_distinct").alias("listing_count"),
        of_fact("host_id", "n_distinct").alias("host_count"),
        of_fact("price", "median").alias("median_price"),
        of_fact("review_scores_rating", "mean").alias("avg_review_score"),
        of_fact("availability_365", "mean").alias("avg_availability_365"),
    )


def weekend_pricing(star: Star) -> DataFrame:
    rows = _priced_days(star, "is_weekend")
    return (
        median_by(rows, ["is_weekend"], "price", "median_price", size="record_count", mean="avg_price")
        .select(
            "is_weekend",
            F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
            "median_price",
            "avg_price",
            "record_count",
        )
        .orderBy(F.asc_nulls_last("is_weekend"))
    )


def monthly_price_availability(star: Star) -> DataFrame:
    rows = _priced_days(star, "year", "month", "month_name")
    return (
        rows.groupBy("year", "month", "month_name")
        .agg(
            _round(F.avg("price"), 2).alias("avg_price"),
            _round(F.avg(F.when(F.col("available"), 1.0).otherwise(0.0)) * 100, 1).alias("availability_pct"),
            F.count(F.lit(1)).alias("records"),
        )
        .orderBy("year", "month")
    )


def quality_concerns(star: Star, k: int = 30) -> DataFrame:
    """Much reviewed listings with a low score."""
    wanted = star.fact_listing_snapshot.where((F.col("number_of_reviews") >= 20) & (F.col("review_scores_rating") < 4.0))
    listings = star.dim_listing.select("listing_key", "listing_id", "name", "room_type", "neighbourhood_key")
    rows = _with_area(star_join(wanted, listings, "listing_key"), star, "left").select(
        "listing_id", "name", "room_type", "neighbourhood_name", "number_of_reviews", "review_scores_rating", "price"
    )
    return top_k(rows, [F.desc_nulls_last("number_of_reviews"), F.asc("listing_id")], k)


def neighbourhood_summary(star: Star) -> DataFrame:
    """Figures by area, from one reading of the star join."""
    rows = _with_area(_priced_listings(star, "neighbourhood_key"), star)
    area = F.col("neighbourhood_name")
    columns = ("price", "review_scores_rating", "availability_365", "estimated_occupancy_rate_365d")
    counts = count_facts([(rows, [Fact("listing", key=area), *(Fact(c, F.col(c), area) for c in columns)])])
    return (
        summarise(counts, ["price"])
        .groupBy(F.col("key").alias("neighbourhood_name"))
        .agg(
            of_fact("listing", "n").alias("listing_count"),
            of_fact("price", "median").alias("median_price"),
            _round(of_fact("review_scores_rating", "mean"), 2).alias("avg_rating"),
            _round(of_fact("availability_365", "mean"), 0).alias("avg_availability_365"),
            _round(of_fact("estimated_occupancy_rate_365d", "mean") * 100, 1).alias("avg_occupancy_pct"),
        )
        .orderBy(F.desc("listing_count"), "neighbourhood_name")
    )
