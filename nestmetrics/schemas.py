"""Column names and types of the raw tables and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


# Raw tables as they arrive (text, except where a number is always given).
RAW_LISTINGS_DDL = """
    id long, name string, description string, host_id long, host_name string, host_since string,
    host_is_superhost string, host_total_listings_count double, neighbourhood_cleansed string,
    neighbourhood_group_cleansed string, latitude double, longitude double, property_type string,
    room_type string, accommodates int, bathrooms double, bathrooms_text string, bedrooms double,
    beds double, price string, minimum_nights int, maximum_nights int, availability_30 int,
    availability_60 int, availability_90 int, availability_365 int, number_of_reviews int,
    number_of_reviews_ltm int, last_review string, review_scores_rating double,
    review_scores_accuracy double, review_scores_cleanliness double, review_scores_checkin double,
    review_scores_communication double, review_scores_location double, review_scores_value double,
    instant_bookable string, calculated_host_listings_count int, reviews_per_month double
"""
RAW_CALENDAR_DDL = """
    listing_id long, date string, available string, price string, adjusted_price string,
    minimum_nights int, maximum_nights int
"""
RAW_REVIEWS_DDL = "listing_id long, id long, date string, reviewer_id long, reviewer_name string, comments string"
RAW_NEIGHBOURHOODS_DDL = "neighbourhood_group string, neighbourhood string"

# The star schema. Surrogate keys are long so that they outlast 2**31 rows.
STAR_DDL = {
    "dim_neighbourhood": "neighbourhood_key long, neighbourhood_name string, neighbourhood_group string",
    "dim_host": """
        host_key long, host_id long, host_name string, host_since date, host_tenure_years double,
        host_is_superhost boolean, host_total_listings_count int, calculated_host_listings_count int,
        is_professional_host boolean, host_tier string
    """,
    "dim_listing": """
        listing_key long, listing_id long, name string, description string, neighbourhood_key long,
        host_key long, latitude double, longitude double, property_type string, room_type string,
        accommodates int, bedrooms double, beds double, bathrooms_text string, minimum_nights int,
        maximum_nights int, instant_bookable boolean
    """,
    "dim_date": """
        date_key int, full_date date, year int, month int, day int, day_of_week int, day_name string,
        is_weekend boolean, month_name string, quarter int
    """,
    "fact_listing_snapshot": """
        listing_key long, price double, price_per_bedroom double, number_of_reviews int,
        number_of_reviews_ltm int, review_scores_rating double, review_scores_accuracy double,
        review_scores_cleanliness double, review_scores_checkin double,
        review_scores_communication double, review_scores_location double, review_scores_value double,
        reviews_per_month double, availability_30 int, availability_60 int, availability_90 int,
        availability_365 int, estimated_occupancy_rate_365d double, average_calendar_price double,
        estimated_annual_revenue_proxy double
    """,
    "fact_calendar": """
        listing_id long, date_key int, available boolean, price double, adjusted_price double,
        minimum_nights int, maximum_nights int
    """,
    "fact_reviews": "review_id long, listing_id long, date_key int, reviewer_id long, reviewer_name string",
}


def star_schema(table: str) -> T.StructType:
    return _schema(STAR_DDL[table])
