"""Listings with calendar and review aggregates and derived fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.operators.joins import attach


def aggregate_calendar(calendar: DataFrame) -> DataFrame:
    """Per listing: known days, unavailable days, mean price, occupancy.

    A day of unknown availability is not counted as a known day, but as an unavailable one.
    One shuffle of partial aggregates: a listing with most of the days is no hot spot.
    """
    free = F.coalesce(F.col("available"), F.lit(False))
    return (
        calendar.where(F.col("listing_id").isNotNull())
        .groupBy("listing_id")
        .agg(
            F.count("available").alias("calendar_days_total"),
            F.count_if(~free).alias("calendar_days_unavailable"),
            F.avg("price").alias("_mean_price"),
        )
        .select(
            "listing_id",
            "calendar_days_total",
            "calendar_days_unavailable",
            E.round_half_even(F.col("_mean_price"), 2).alias("average_calendar_price"),
            E.occupancy_rate(F.col("calendar_days_unavailable"), F.col("calendar_days_total")).alias(
                "estimated_occupancy_rate_365d"
            ),
        )
    )


def aggregate_reviews(reviews: DataFrame) -> DataFrame:
    """Per listing: reviews, first and last date. Without review ids, rows are counted."""
    counted = "id" if "id" in reviews.columns else "listing_id"
    return (
        reviews.where(F.col("listing_id").isNotNull())
        .groupBy("listing_id")
        .agg(
            F.count(counted).alias("total_review_count"),
            F.min("date").alias("review_first_date"),
            F.max("date").alias("review_last_date"),
        )
    )


def join_calendar_aggregates(listings: DataFrame, calendar: DataFrame) -> DataFrame:
    return attach(listings, aggregate_calendar(calendar), "id", "listing_id")


def join_review_aggregates(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    return attach(listings, aggregate_reviews(reviews), "id", "listing_id")


def add_derived_fields(df: DataFrame, snapshot_date: str) -> DataFrame:
    """Tenure, price per bedroom, professional flag, host tier, revenue proxy.

    Fields whose inputs are missing become null (flag: false, tier: the lowest).
    """
    have = set(df.columns)
    none = F.lit(None).cast("double")
    count = F.col("calculated_host_listings_count") if "calculated_host_listings_count" in have else None
    return df.withColumns(
        {
            "host_tenure_years": E.host_tenure_years(
                E.parse_date_lenient(F.col("host_since"), df.schema["host_since"].dataType), snapshot_date
            )
            if "host_since" in have
            else none,
            "price_per_bedroom": E.price_per_bedroom(F.col("price"), F.col("bedrooms"))
            if {"price", "bedrooms"} <= have
            else none,
            "is_professional_host": E.professional_flag(count) if count is not None else F.lit(False),
            "host_tier": E.host_tier(count) if count is not None else F.lit(E.HOST_TIERS[0][1]),
            "estimated_annual_revenue_proxy": E.revenue_proxy(
                F.col("average_calendar_price"), F.col("calendar_days_unavailable")
            )
            if {"average_calendar_price", "calendar_days_unavailable"} <= have
            else none,
        }
    )


def enrich_listings(
    listings: DataFrame,
    calendar: DataFrame | None = None,
    reviews: DataFrame | None = None,
    snapshot_date: str = "2025-09-26",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The listings master table. Calendar and reviews are optional.

    Both joins are left joins on keys that are unique on the right, so a query that uses none of
    the aggregates drops them, scan included. They shuffle the listings by id: columns that can be
    computed from others are better added by ``finish``, which gets the rows as joined and keeps
    their other columns, than carried through the shuffle.
    """
    df = listings
    if calendar is not None:
        df = join_calendar_aggregates(df, calendar)
    if reviews is not None:
        df = join_review_aggregates(df, reviews)
    if finish is not None:
        df = finish(df)
    return add_derived_fields(df, snapshot_date)
