"""Datasets behind the dashboard views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.operators.facts import Fact, count_facts, summarise
from nestmetrics.operators.histogram import histogram
from nestmetrics.operators.ordering import argmax_row, top_k
from nestmetrics.operators.quantiles import exact_quantiles, global_quantile, median_by
from nestmetrics.plans import eda
from nestmetrics.plans.warehouse import Star, listings_from_star

# Accepted names of a field, best first.
FIELD_NAMES = {
    "price": ("price", "listing_price", "nightly_price"),
    "area": ("neighbourhood_cleansed", "neighbourhood", "neighborhood"),
    "room": ("room_type", "stay_type"),
    "superhost": ("host_is_superhost", "is_superhost"),
    "professional": ("is_professional_host", "professional_host"),
    "host": ("host_id", "host_key"),
    "rating": ("review_scores_rating", "avg_review_score", "review_score_overall"),
    "reviews": ("number_of_reviews", "reviews_count"),
    "latitude": ("latitude", "lat"),
    "longitude": ("longitude", "lon", "lng"),
}
ID_NAMES = ("id", "listing_id")
CALENDAR_PRICE_NAMES = ("price", "calendar_price", "adjusted_price")
SEGMENTS = ("Professional", "Casual")
DAY_TYPES = ("Weekend (Fri-Sat)", "Weekday (Sun-Thu)")


def resolve_fields(df: DataFrame) -> dict[str, str | None]:
    return {field: E.first_existing_col(df, names) for field, names in FIELD_NAMES.items()}


def one_shape(df: DataFrame) -> DataFrame:
    """A listing table of any origin with ``id`` and each field under its best name; fields it lacks are null.

    The datasets below and the market filters then work on it whatever its columns were called.
    """
    types = {"area": "string", "room": "string", "superhost": "boolean", "professional": "boolean", "host": "long", "reviews": "int"}
    found = {"id": (E.first_existing_col(df, ID_NAMES), "long")}
    found |= {FIELD_NAMES[f][0]: (source, types.get(f, "double")) for f, source in resolve_fields(df).items()}
    return df.select(*[(F.lit(None).cast(dtype) if source is None else F.col(source)).alias(name) for name, (source, dtype) in found.items()])


def view_from_star(star: Star, area: bool = True, host: bool = True) -> DataFrame:
    """The listings of a warehouse in the one shape: what the views fall back on where no enriched table is stored.

    Only the dimensions that are asked for are joined; every listing is kept.
    """
    listings = listings_from_star(star)
    if area:
        names = star.dim_neighbourhood.select("neighbourhood_key", F.col("neighbourhood_name").alias("neighbourhood"))
        listings = listings.join(names, "neighbourhood_key", "left")
    if host:
        listings = listings.join(star.dim_host.select("host_key", "host_id", "host_is_superhost", "is_professional_host"), "host_key", "left")
    return one_shape(listings)


def market_filter(
    df: DataFrame,
    areas: Sequence[str] = (),
    rooms: Sequence[str] = (),
    price_range: tuple[float, float] | None = None,
    superhost: bool | None = None,
    professional: bool | None = None,
) -> DataFrame:
    """Listings that meet every chosen filter; an empty choice does not filter.

    Plain conjuncts, so that they reach the scan.
    """
    fields = resolve_fields(df)
    conditions: list[Column] = []
    if areas and fields["area"]:
        conditions.append(F.col(fields["area"]).isin(*areas))
    if rooms and fields["room"]:
        conditions.append(F.col(fields["room"]).isin(*rooms))
    if price_range and fields["price"]:
        conditions.append(F.col(fields["price"]).between(*price_range))
    if superhost is not None and fields["superhost"]:
        conditions.append(E.lenient_bool(F.col(fields["superhost"])) == F.lit(superhost))
    if professional is not None and fields["professional"]:
        conditions.append(E.lenient_bool(F.col(fields["professional"])) == F.lit(professional))
    for condition in conditions:
        df = df.where(condition)
    return df


def market_view(df: DataFrame, **choices) -> DataFrame:
    """The filtered listings, or all of them where nothing at all matches.

    The test is part of the plan, so building the view runs no job.
    """
    matching = market_filter(df, **choices)
    found = matching.select(F.lit(True).alias("_found")).limit(1)
    return matching.unionByName(df.where(~found.exists()))


def price_bounds(df: DataFrame) -> DataFrame:
    """One row: the slider bounds, whole numbers."""
    q = exact_quantiles(df, [], "price", {"q01": 0.01, "q99": 0.99})
    low = F.greatest(F.lit(0), F.coalesce(F.col("q01"), F.lit(0.0)).cast("long"))
    high = F.greatest(low + 1, F.coalesce(F.col("q99"), F.lit(10000.0)).cast("long"))
    return q.select(low.alias("low_price"), high.alias("high_price"))


def filter_options(df: DataFrame) -> DataFrame:
    """Every choice of every filter: distinct areas and rooms, then the price bounds."""
    parts = [
        df.select(F.lit(label).alias("filter"), F.col(column).cast("string").alias("option"))
        .where(F.col("option").isNotNull())
        .distinct()
        for label, column in (("neighbourhood", eda.area_column(df)), ("room_type", "room_type"))
    ]
    bounds = price_bounds(df)
    for name in ("low_price", "high_price"):
        parts.append(bounds.select(F.lit(name).alias("filter"), F.col(name).cast("string").alias("option")))
    options = parts[0]
    for part in parts[1:]:
        options = options.unionByName(part)
    return options.orderBy("filter", "option")


def room_mix(view: DataFrame) -> DataFrame:
    return eda.value_counts(view, "room_type")


def price_histogram(view: DataFrame, high_price: Column | float, bins: int = 50) -> DataFrame:
    high = high_price if isinstance(high_price, Column) else F.lit(high_price)
    return histogram(view.where((F.col("price") >= 0) & (F.col("price") <= high)), "price", bins)


def price_by_room(view: DataFrame) -> DataFrame:
    return median_by(view, ["room_type"], "price", "typical_price")


def neighbourhood_supply_price(view: DataFrame) -> DataFrame:
    """Priced listings and median per area; listings without an area form one row."""
    return median_by(view, [eda.area_column(view)], "price", "typical_price", size="listing_count")


def neighbourhood_matrix(view: DataFrame, k: int = 20) -> DataFrame:
    area = eda.area_column(view)
    return top_k(neighbourhood_supply_price(view), [F.desc("listing_count"), F.asc_nulls_last(area)], k)


def map_points(view: DataFrame) -> DataFrame:
    """All located listings."""
    return view.dropna(subset=["latitude", "longitude"]).select("id", "latitude", "longitude", "price", eda.area_column(view))


def host_segments(view: DataFrame) -> DataFrame:
    professional = E.lenient_bool(F.col("is_professional_host"))
    segment = F.when(professional, SEGMENTS[0]).otherwise(SEGMENTS[1])
    return median_by(
        view.withColumn("host_segment", segment), ["host_segment"], "price", "typical_price", {"listing_count": eda.row_count()}
    )


def rating_histogram(view: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(view, "review_scores_rating", bins)


def improvement_targets(view: DataFrame, k: int = 10, min_reviews: int = 10) -> DataFrame:
    """The most reviewed listings that score below the median."""
    middle = global_quantile(view, "review_scores_rating", 0.5)
    low = view.where((F.col("review_scores_rating") < middle) & (F.col("number_of_reviews") > min_reviews))
    return top_k(low, [F.desc("number_of_reviews"), F.asc("id")], k).select(
        "id", eda.area_column(view), "room_type", "price", "review_scores_rating", "number_of_reviews"
    )


def known_days(calendar: DataFrame) -> DataFrame:
    """Dated days with a price, which is the first of its accepted columns."""
    source = E.first_existing_col(calendar, CALENDAR_PRICE_NAMES)
    if source is None:
        raise ValueError("no price column")
    return calendar.withColumn("price", F.col(source)).dropna(subset=["date", "price"])


def monthly_median_price(calendar: DataFrame) -> DataFrame:
    days = known_days(calendar).withColumn("month", E.month_bucket(F.col("date")))
    return median_by(days, ["month"], "price", "typical_price").orderBy("month")


def seasonality(calendar: DataFrame) -> DataFrame:
    """Medians by day type and by month, over all known days, which are read and counted once."""
    weekend = E.weekend_flag(F.col("date"), E.WEEKEND_FRI_SAT)
    day_type = F.when(weekend, DAY_TYPES[0]).otherwise(DAY_TYPES[1])
    price = F.col("price")
    counts = count_facts([(known_days(calendar), [Fact("day_type", price, day_type), Fact("month", price, E.month_bucket(F.col("date")))])])
    return summarise(counts).select(F.col("fact").alias("series"), F.col("key").alias("period"), F.col("median").alias("typical_price"))


def best_model(results: DataFrame) -> DataFrame:
    numeric = results.withColumn("r2_score", E.to_numeric(F.col("r2_score"), results.schema["r2_score"].dataType))
    return argmax_row(numeric, "r2_score")


def boosted_rows(results: DataFrame, word: str = "XGBoost") -> DataFrame:
    return results.where(E.contains_ci(F.col("model"), word))
