"""Projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.catalog.registry import query
from nestmetrics.functions import exprs as E
from nestmetrics.operators.quantiles import global_quantile
from nestmetrics.plans import clean
from nestmetrics.plans.dashboard import market_view
from nestmetrics.plans.eda import trimmed_prices

LISTING_COLUMNS = "SELECT * FROM listings"


@query("clean_price", "SELECT id, price FROM listings")
def _(m):
    return m.raw_listings.select("id", E.clean_price(F.col("price"), T.StringType()).alias("price"))


@query("parse_bool", "SELECT id, host_is_superhost, instant_bookable FROM listings")
def _(m):
    flags = ("host_is_superhost", "instant_bookable")
    return m.raw_listings.select("id", *[E.parse_bool(F.col(c)).alias(c) for c in flags])


@query("parse_date_lenient", "SELECT id, host_since, last_review FROM listings")
def _(m):
    dates = ("host_since", "last_review")
    return m.raw_listings.select("id", *[E.parse_date_lenient(F.col(c)).alias(c) for c in dates])


@query("standardise_text", "SELECT id, neighbourhood_cleansed, room_type, property_type FROM listings")
def _(m):
    texts = ("neighbourhood_cleansed", "room_type", "property_type")
    return m.raw_listings.select("id", *[E.standardise_text(F.col(c)).alias(c) for c in texts])


@query("conditional_fill", "SELECT id, number_of_reviews, reviews_per_month FROM listings")
def _(m):
    filled = E.conditional_fill(F.col("reviews_per_month"), F.col("number_of_reviews") == 0, 0.0)
    return m.raw_listings.select("id", "number_of_reviews", filled.alias("reviews_per_month"))


@query(
    "apply_by_column_pattern",
    "SELECT listing_id, date, available, price, adjusted_price, minimum_nights, maximum_nights FROM calendar",
)
def _(m):
    return E.apply_by_column(
        m.raw_calendar,
        [
            (lambda n: "price" in n, E.clean_price),
            (lambda n: n in ("date",), E.parse_date_lenient),
            (lambda n: n in ("available",), E.parse_bool),
        ],
    )


@query("clean_listings", LISTING_COLUMNS)
def _(m):
    return clean.clean_listings(m.raw_listings)


@query("clean_calendar", "SELECT * FROM calendar")
def _(m):
    return clean.clean_calendar(m.raw_calendar)


@query("clean_reviews", "SELECT * FROM reviews")
def _(m):
    return clean.clean_reviews(m.raw_reviews)


@query("clean_neighbourhoods", "SELECT * FROM neighbourhoods")
def _(m):
    return clean.clean_neighbourhoods(m.raw_neighbourhoods)


@query("first_existing_col", "SELECT id, price AS value FROM listings")
def _(m):
    column = E.first_existing_col(m.listings, ["nightly_price", "price", "listing_price"])
    return m.listings.select("id", F.col(column).alias("value"))


@query(
    "project_existing",
    "SELECT listing_id, date, available, NULL::DOUBLE AS cleaning_fee FROM calendar",
)
def _(m):
    return E.project_schema(
        m.calendar, T.StructType.fromDDL("listing_id long, date date, available boolean, cleaning_fee double")
    )


@query("lenient_bool", "SELECT id, coalesce(host_is_superhost, false) AS flag FROM listings")
def _(m):
    return m.listings.select("id", E.lenient_bool(F.col("host_is_superhost")).alias("flag"))


@query("to_binary", "SELECT id, CASE WHEN instant_bookable THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag FROM listings")
def _(m):
    return m.raw_listings.select("id", E.to_binary(F.col("instant_bookable")).alias("flag"))


@query(
    "to_numeric_coerce",
    "SELECT id, try_cast(bathrooms_text AS DOUBLE) AS from_text, bedrooms AS from_number, "
    "try_cast(right(name, 2) AS DOUBLE) AS from_suffix FROM listings",
)
def _(m):
    return m.listings.select(
        "id",
        E.to_numeric(F.col("bathrooms_text")).alias("from_text"),
        E.to_numeric(F.col("bedrooms"), T.DoubleType()).alias("from_number"),
        E.to_numeric(F.right(F.col("name"), F.lit(2))).alias("from_suffix"),
    )


@query("host_tenure_years", "SELECT id, host_tenure_years FROM enriched")
def _(m):
    return m.listings.select("id", E.host_tenure_years(F.col("host_since"), "2001-12-31").alias("host_tenure_years"))


@query("price_per_bedroom", "SELECT id, price_per_bedroom FROM enriched")
def _(m):
    return m.listings.select("id", E.price_per_bedroom(F.col("price"), F.col("bedrooms")).alias("price_per_bedroom"))


@query("professional_flag", "SELECT id, is_professional_host FROM enriched")
def _(m):
    flag = E.professional_flag(F.col("calculated_host_listings_count"))
    return m.listings.select("id", flag.alias("is_professional_host"))


@query(
    "host_tier_bins",
    """SELECT id, CASE WHEN n <= 0 THEN NULL WHEN n <= 1 THEN 'Solo Host' WHEN n <= 2 THEN 'Small Portfolio'
       WHEN n <= 9 THEN 'Mid Portfolio' ELSE 'Commercial Operator' END AS host_tier
       FROM (SELECT id, coalesce(CASE WHEN id % 20 <> 0 THEN calculated_host_listings_count - 1 END, 1) AS n
             FROM listings)""",
)
def _(m):
    count = F.when(F.col("id") % 20 != 0, F.col("calculated_host_listings_count") - 1)
    return m.listings.select("id", E.host_tier(count).alias("host_tier"))


@query("revenue_proxy", "SELECT id, estimated_annual_revenue_proxy FROM enriched")
def _(m):
    revenue = E.revenue_proxy(F.col("average_calendar_price"), F.col("calendar_days_unavailable"))
    return m.enrich().select("id", revenue.alias("estimated_annual_revenue_proxy"))


@query("occupancy_rate", "SELECT id, estimated_occupancy_rate_365d FROM enriched")
def _(m):
    rate = E.occupancy_rate(F.col("calendar_days_unavailable"), F.col("calendar_days_total"))
    return m.enrich().select("id", rate.alias("estimated_occupancy_rate_365d"))


@query(
    "log_transform",
    "SELECT id, round(ln(price + 1), 9) AS log_price, round(exp(ln(price + 1)) - 1, 3) AS back FROM listings",
)
def _(m):
    logged = E.log_price(F.col("price"))
    return m.listings.select(
        "id", F.round(logged, 9).alias("log_price"), F.round(E.unlog_price(logged), 3).alias("back")
    )


@query(
    "date_parts",
    """SELECT listing_id, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date AS full_date,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
       coalesce(isodow(date) IN (6, 7), false) AS is_weekend, monthname(date) AS month_name,
       CAST(quarter(date) AS INTEGER) AS quarter FROM calendar""",
)
def _(m):
    return m.calendar.select("listing_id", *[c.alias(n) for n, c in E.date_parts(F.col("date")).items()])


@query(
    "weekend_flag",
    """SELECT listing_id, date, coalesce(isodow(date) IN (6, 7), false) AS sat_sun,
       coalesce(isodow(date) IN (5, 6), false) AS fri_sat FROM calendar""",
)
def _(m):
    return m.calendar.select(
        "listing_id",
        "date",
        E.weekend_flag(F.col("date"), E.WEEKEND_SAT_SUN).alias("sat_sun"),
        E.weekend_flag(F.col("date"), E.WEEKEND_FRI_SAT).alias("fri_sat"),
    )


@query("month_bucket", "SELECT listing_id, date, strftime(date, '%Y-%m') AS month FROM calendar")
def _(m):
    return m.calendar.select("listing_id", "date", E.month_bucket(F.col("date")).alias("month"))


@query("date_key_to_date", "SELECT listing_id, date_key, strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS date FROM fact_calendar")
def _(m):
    keyed = m.calendar.select("listing_id", E.date_key(F.col("date")).alias("date_key"))
    return keyed.withColumn("date", E.date_key_to_date(F.col("date_key")))


@query(
    "case_label",
    """SELECT id, CASE WHEN is_professional_host THEN 'Professional' ELSE 'Casual' END AS segment FROM enriched""",
)
def _(m):
    return m.enriched.select(
        "id", F.when(F.col("is_professional_host"), "Professional").otherwise("Casual").alias("segment")
    )


@query(
    "clip_upper",
    "SELECT id, CASE WHEN beds > 3 THEN 3.0::DOUBLE ELSE beds END AS beds_clipped FROM listings",
)
def _(m):
    return m.listings.select("id", E.clip_upper(F.col("beds"), 3).alias("beds_clipped"))


@query("filter_positive_price", "SELECT id, price FROM listings WHERE price > 0")
def _(m):
    return m.listings.where(F.col("price") > 0).select("id", "price")


@query("filter_contains_ci", "SELECT id, room_type FROM listings WHERE contains(lower(room_type), 'urg')")
def _(m):
    return m.listings.where(E.contains_ci(F.col("room_type"), "URG")).select("id", "room_type")


@query(
    "filter_isin_between",
    """SELECT id, room_type, price FROM listings
       WHERE room_type IN ('1-URGENT', '5-LOW') AND price BETWEEN 50000 AND 200000""",
)
def _(m):
    wanted = F.col("room_type").isin("1-URGENT", "5-LOW") & F.col("price").between(50000, 200000)
    return m.listings.where(wanted).select("id", "room_type", "price")


@query("drop_null_subset", "SELECT listing_id, date, price FROM calendar WHERE date IS NOT NULL AND price IS NOT NULL")
def _(m):
    return m.calendar.select("listing_id", "date", "price").dropna(subset=["date", "price"])


@query(
    "filter_percentile_cut",
    """SELECT id, price, price < (SELECT quantile_cont(price, 0.99) FROM listings) AS below_overall_cut
       FROM listings WHERE price > 0
       AND price < greatest((SELECT quantile_cont(price, 0.99) FROM listings),
                            (SELECT quantile_cont(price, 0.99) FROM listings WHERE price > 0))""",
)
def _(m):
    listings = m.listings.select("id", "price")
    positive = listings.where(F.col("price") > 0)
    overall = global_quantile(listings, "price", 0.99)
    of_positive = global_quantile(positive, "price", 0.99)
    kept = positive.where(F.col("price") < F.greatest(overall, of_positive))
    return kept.withColumn("below_overall_cut", F.col("price") < overall)


@query(
    "filter_market_view",
    """SELECT id, neighbourhood_cleansed, room_type, price FROM enriched
       WHERE neighbourhood_cleansed IN ('NATION_1', 'NATION_2', 'NATION_3') AND room_type IN ('1-URGENT', '5-LOW')
       AND price BETWEEN 10000 AND 400000 AND coalesce(host_is_superhost, false) AND is_professional_host""",
)
def _(m):
    view = market_view(
        m.enriched,
        areas=["NATION_1", "NATION_2", "NATION_3"],
        rooms=["1-URGENT", "5-LOW"],
        price_range=(10000, 400000),
        superhost=True,
        professional=True,
    )
    return view.select("id", "neighbourhood_cleansed", "room_type", "price")


@query(
    "filter_market_view_empty",
    "SELECT id, room_type, price FROM enriched",
)
def _(m):
    """No listing matches, so all of them are shown."""
    return market_view(m.enriched, rooms=["no such room"]).select("id", "room_type", "price")


@query(
    "filter_quality_targets",
    """SELECT id, number_of_reviews, review_scores_rating FROM listings
       WHERE number_of_reviews >= 20 AND review_scores_rating < 4.0""",
)
def _(m):
    low = (F.col("number_of_reviews") >= 20) & (F.col("review_scores_rating") < 4.0)
    return m.listings.where(low).select("id", "number_of_reviews", "review_scores_rating")


@query(
    "format_metrics",
    """SELECT id, coalesce('฿' || format('{:,.0f}', price), 'N/A') AS currency,
       coalesce(format('{:,.0f}', price / 8), 'N/A') AS number,
       coalesce(printf('%.1f', review_scores_rating / 5 * 100) || '%', 'N/A') AS percent FROM listings""",
)
def _(m):
    return m.listings.select(
        "id",
        E.format_currency(F.col("price")).alias("currency"),
        E.format_number(F.col("price") / 8).alias("number"),
        E.format_percent(F.col("review_scores_rating") / 5).alias("percent"),
    )


@query(
    "is_missing",
    """SELECT id, price IS NULL AS price_missing, id % 7 = 0 OR id % 7 = 1 OR price IS NULL AS odd_missing
       FROM listings""",
)
def _(m):
    odd = F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 7 == 1, float("inf")).otherwise(F.col("price"))
    return m.listings.select(
        "id", E.is_missing(F.col("price")).alias("price_missing"), E.is_missing(odd).alias("odd_missing")
    )


@query(
    "percent_difference",
    """SELECT listing_id, price, adjusted_price,
       CASE WHEN price > 0 THEN (adjusted_price - price) / price * 100 ELSE 0.0::DOUBLE END AS difference_pct
       FROM calendar""",
)
def _(m):
    difference = E.percent_difference(F.col("adjusted_price"), F.col("price"))
    return m.calendar.select("listing_id", "price", "adjusted_price", difference.alias("difference_pct"))


@query("rename_reorder", "SELECT id AS review_id, listing_id, date AS review_date, reviewer_name FROM reviews")
def _(m):
    return E.rename_reorder(
        m.reviews,
        {"id": "review_id", "listing_id": "listing_id", "date": "review_date", "reviewer_name": "reviewer_name"},
    )


@query("trimmed_prices", "SELECT id, price FROM listings WHERE price > 0 AND price < (SELECT quantile_cont(price, 0.99) FROM listings)")
def _(m):
    return trimmed_prices(m.listings.select("id", "price"))
