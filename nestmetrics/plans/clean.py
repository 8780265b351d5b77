"""Typed tables from raw text tables. Each cleaner is one projection: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E

# Columns by kind.
LISTING_DATES = ("host_since", "last_review", "first_review", "calendar_last_scraped", "last_scraped")
LISTING_FLAGS = (
    "host_is_superhost",
    "host_has_profile_pic",
    "host_identity_verified",
    "has_availability",
    "instant_bookable",
)
LISTING_TEXTS = ("neighbourhood_cleansed", "neighbourhood_group_cleansed", "room_type", "property_type")
AREA_TEXTS = ("neighbourhood", "neighbourhood_group")


def _is_price(name: str) -> bool:
    return "price" in name.lower()


def clean_listings(raw: DataFrame) -> DataFrame:
    df = E.apply_by_column(
        raw,
        [
            (_is_price, E.clean_price),
            (lambda n: n in LISTING_DATES, E.parse_date_lenient),
            (lambda n: n in LISTING_FLAGS, E.parse_bool),
            (lambda n: n in LISTING_TEXTS, E.standardise_text),
        ],
    )
    if {"reviews_per_month", "number_of_reviews"} <= set(df.columns):
        # Review scores stay null: only the rate of a listing without reviews is known to be 0.
        filled = E.conditional_fill(F.col("reviews_per_month"), F.col("number_of_reviews") == 0, 0.0)
        df = df.withColumn("reviews_per_month", filled)
    return df


def clean_calendar(raw: DataFrame) -> DataFrame:
    return E.apply_by_column(
        raw,
        [
            (lambda n: n == "date", E.parse_date_lenient),
            (_is_price, E.clean_price),
            (lambda n: n == "available", E.parse_bool),
        ],
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    return E.apply_by_column(raw, [(lambda n: n == "date", E.parse_date_lenient)])


def clean_neighbourhoods(raw: DataFrame) -> DataFrame:
    return E.apply_by_column(raw, [(lambda n: n in AREA_TEXTS, E.standardise_text)])
