"""Aggregations."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from nestmetrics.catalog.oracle_views import VIEWS
from nestmetrics.catalog.registry import ORACLES, query
from nestmetrics.functions import exprs as E
from nestmetrics.operators.histogram import histogram
from nestmetrics.operators.ordering import dedupe_keep_first
from nestmetrics.operators.quantiles import exact_quantiles, median_by
from nestmetrics.plans import dashboard, eda, enrich, market_queries, profile, rules, stats
from nestmetrics.plans.warehouse import row_counts


def histogram_sql(source: str, value: str, bins: int) -> str:
    """Every bin of an equal-width histogram, in SQL."""
    return f""", v AS (SELECT {value}::DOUBLE AS v FROM {source} WHERE {value} IS NOT NULL),
    b AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {float(bins)}::DOUBLE AS w FROM v),
    c AS (SELECT least(floor((v - lo) / w), {bins - 1})::INTEGER AS bin, count(*) AS n FROM v, b GROUP BY 1)
    SELECT r.bin::INTEGER AS bin, lo + w * r.bin AS bin_start, lo + w * (r.bin + 1) AS bin_end,
           coalesce(n, 0) AS count
    FROM b, range({bins}) r(bin) LEFT JOIN c ON c.bin = r.bin"""


@query("agg_calendar", "SELECT * FROM calendar_agg")
def _(m):
    return enrich.aggregate_calendar(m.calendar)


@query("agg_reviews", "SELECT * FROM review_agg")
def _(m):
    return enrich.aggregate_reviews(m.reviews)


@query(
    "median_by_group",
    "SELECT bedrooms, median(price) AS median_price FROM listings GROUP BY bedrooms",
)
def _(m):
    """Listings without a bedroom count are a group of their own."""
    return median_by(m.listings, ["bedrooms"], "price", "median_price")


@query(
    "sql_price_by_neighbourhood",
    """SELECT n.neighbourhood_name, median(f.price) AS median_price, count(*) AS listing_count
       FROM fact_listing_snapshot f JOIN dim_listing l ON f.listing_key = l.listing_key
       JOIN dim_neighbourhood n ON l.neighbourhood_key = n.neighbourhood_key
       WHERE f.price > 0 GROUP BY n.neighbourhood_name""",
)
def _(m):
    return market_queries.price_by_neighbourhood(m.star)


@query(
    "sql_price_by_room_type",
    """SELECT l.room_type, median(f.price) AS median_price, avg(f.price) AS avg_price, count(*) AS listing_count
       FROM fact_listing_snapshot f JOIN dim_listing l ON f.listing_key = l.listing_key
       WHERE f.price > 0 GROUP BY l.room_type""",
)
def _(m):
    return market_queries.price_by_room_type(m.star)


@query(
    "sql_top_hosts",
    """SELECT host_id, host_name, calculated_host_listings_count, host_is_superhost, host_tier FROM dim_host
       ORDER BY calculated_host_listings_count DESC NULLS LAST, host_id LIMIT 20""",
)
def _(m):
    return market_queries.top_hosts(m.star)


@query(
    "sql_pro_vs_casual",
    """SELECT h.is_professional_host, count(DISTINCT l.listing_key) AS listing_count,
       count(DISTINCT h.host_id) AS host_count, median(f.price) AS median_price,
       avg(f.review_scores_rating) AS avg_review_score, avg(f.availability_365) AS avg_availability_365
       FROM fact_listing_snapshot f JOIN dim_listing l ON f.listing_key = l.listing_key
       JOIN dim_host h ON l.host_key = h.host_key GROUP BY h.is_professional_host""",
)
def _(m):
    return market_queries.professional_vs_casual(m.star)


@query(
    "sql_weekend_pricing",
    """SELECT d.is_weekend, CASE WHEN d.is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       median(c.price) AS median_price, avg(c.price) AS avg_price, count(*) AS record_count
       FROM fact_calendar c JOIN dim_date d ON c.date_key = d.date_key WHERE c.price > 0 GROUP BY d.is_weekend""",
)
def _(m):
    return market_queries.weekend_pricing(m.star)


@query(
    "sql_monthly_price_availability",
    """SELECT d.year, d.month, d.month_name, round(avg(c.price), 2) AS avg_price,
       round(avg(CASE WHEN c.available THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 1) AS availability_pct,
       count(*) AS records
       FROM fact_calendar c JOIN dim_date d ON c.date_key = d.date_key
       WHERE c.price > 0 GROUP BY d.year, d.month, d.month_name""",
)
def _(m):
    return market_queries.monthly_price_availability(m.star)


@query(
    "sql_quality_concerns",
    """SELECT l.listing_id, l.name, l.room_type, n.neighbourhood_name, f.number_of_reviews,
       f.review_scores_rating, f.price
       FROM fact_listing_snapshot f JOIN dim_listing l ON f.listing_key = l.listing_key
       LEFT JOIN dim_neighbourhood n ON l.neighbourhood_key = n.neighbourhood_key
       WHERE f.number_of_reviews >= 20 AND f.review_scores_rating < 4.0
       ORDER BY f.number_of_reviews DESC, l.listing_id LIMIT 30""",
)
def _(m):
    return market_queries.quality_concerns(m.star)


@query(
    "sql_neighbourhood_summary",
    """SELECT n.neighbourhood_name, count(*) AS listing_count, median(f.price) AS median_price,
       round(avg(f.review_scores_rating), 2) AS avg_rating, round(avg(f.availability_365), 0) AS avg_availability_365,
       round(avg(f.estimated_occupancy_rate_365d) * 100, 1) AS avg_occupancy_pct
       FROM fact_listing_snapshot f JOIN dim_listing l ON f.listing_key = l.listing_key
       JOIN dim_neighbourhood n ON l.neighbourhood_key = n.neighbourhood_key
       WHERE f.price > 0 GROUP BY n.neighbourhood_name""",
)
def _(m):
    return market_queries.neighbourhood_summary(m.star)


@query(
    "value_counts",
    "SELECT bedrooms, count(*) AS count FROM listings WHERE bedrooms IS NOT NULL GROUP BY bedrooms",
)
def _(m):
    return eda.value_counts(m.listings, "bedrooms")


@query(
    "quantiles",
    """SELECT round(quantile_cont(price, 0.01), 6) AS q01, quantile_cont(price, 0.5) AS q50,
       round(quantile_cont(price, 0.8), 6) AS q80, round(quantile_cont(price, 0.99), 6) AS q99 FROM listings""",
)
def _(m):
    found = exact_quantiles(m.listings, [], "price", {"q01": 0.01, "q50": 0.5, "q80": 0.8, "q99": 0.99})
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query(
    "calendar_quantiles",
    """SELECT strftime(date, '%Y-%m') AS month, round(quantile_cont(price, 0.01), 6) AS q01, median(price) AS q50,
       round(quantile_cont(price, 0.99), 6) AS q99, count(*) AS days FROM calendar GROUP BY 1""",
)
def _(m):
    months = m.calendar.withColumn("month", E.month_bucket(F.col("date")))
    found = exact_quantiles(
        months, ["month"], "price", {"q01": 0.01, "q50": 0.5, "q99": 0.99}, {"days": F.count(F.lit(1))}
    )
    return found.select("month", *[F.round(c, 6).alias(c) for c in ("q01", "q50", "q99")], "days")


@query(
    "quantile_of_group_medians",
    """SELECT round(quantile_cont(m, 0.8), 6) AS high_price, median(n) AS low_supply FROM (
         SELECT median(price) AS m, count(id) AS n FROM listings GROUP BY neighbourhood_cleansed)""",
)
def _(m):
    limits = rules.area_thresholds(rules.area_statistics(m.listings))
    return limits.select(F.round("high_price", 6).alias("high_price"), "low_supply")


@query("histogram", histogram_sql("listings", "price", 50))
def _(m):
    return histogram(m.listings, "price", 50)


@query("share_true", "SELECT avg(CASE WHEN host_is_superhost THEN 1.0::DOUBLE WHEN NOT host_is_superhost THEN 0.0::DOUBLE END) AS share FROM listings")
def _(m):
    return eda.share_true(m.listings, "host_is_superhost")


@query(
    "kpi_global",
    """SELECT count(*) AS total_listings, median(price) AS median_price,
       avg(CASE WHEN is_professional_host THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS professional_share,
       avg(review_scores_rating) AS avg_review FROM enriched""",
)
def _(m):
    return rules.market_kpis(m.enriched)


PRO_VS_CASUAL = """SELECT is_professional_host, round_even(median(price) * 100, 0) / 100 AS median_price,
       round_even(avg(review_scores_rating) * 100, 0) / 100 AS avg_review_score, count(id) AS count
       FROM enriched WHERE is_professional_host IS NOT NULL GROUP BY is_professional_host"""


@query("pro_vs_casual_eda", PRO_VS_CASUAL)
def _(m):
    return eda.professional_vs_casual(m.enriched)


MONTHLY_AVAILABILITY = """SELECT strftime(date, '%Y-%m') AS month,
       avg(CASE WHEN available THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS available_pct
       FROM calendar WHERE date IS NOT NULL GROUP BY 1"""


@query("availability_by_month", MONTHLY_AVAILABILITY)
def _(m):
    return eda.availability_by_month(m.calendar)


@query(
    "availability_range",
    f"SELECT min(available_pct) AS lowest_pct, max(available_pct) AS highest_pct FROM ({MONTHLY_AVAILABILITY})",
)
def _(m):
    return eda.availability_range(m.calendar)


WEEKEND_VS_WEEKDAY = """SELECT weekday_median, weekend_median,
       CASE WHEN weekday_median > 0 THEN (weekend_median - weekday_median) / weekday_median * 100
            ELSE 0.0::DOUBLE END AS difference_pct FROM (
         SELECT coalesce(median(price) FILTER (WHERE NOT w), 0) AS weekday_median,
                coalesce(median(price) FILTER (WHERE w), 0) AS weekend_median
         FROM (SELECT price, coalesce(isodow(date) IN (5, 6), false) AS w FROM calendar WHERE price > 0))"""


@query("weekend_vs_weekday_median", WEEKEND_VS_WEEKDAY)
def _(m):
    return eda.weekend_vs_weekday(m.calendar)


@query(
    "monthly_median_price",
    """SELECT strftime(date, '%Y-%m') AS month, median(price) AS typical_price FROM calendar
       WHERE date IS NOT NULL AND price IS NOT NULL GROUP BY 1""",
)
def _(m):
    return dashboard.monthly_median_price(m.calendar)


@query(
    "neighbourhood_supply_price",
    """SELECT area AS neighbourhood_cleansed, median(price) AS typical_price, count(price) AS listing_count
       FROM (SELECT CASE WHEN id % 19 <> 0 THEN neighbourhood_cleansed END AS area, price FROM listings)
       GROUP BY area ORDER BY listing_count DESC, area NULLS LAST LIMIT 20""",
)
def _(m):
    area = F.when(F.col("id") % 19 != 0, F.col("neighbourhood_cleansed"))
    return dashboard.neighbourhood_matrix(m.listings.withColumn("neighbourhood_cleansed", area))


@query(
    "count_distinct",
    """SELECT count(DISTINCT host_id) AS hosts, count(DISTINCT price) AS prices, count(DISTINCT bedrooms) AS bedrooms
       FROM listings""",
)
def _(m):
    return m.listings.agg(
        F.countDistinct("host_id").alias("hosts"),
        F.countDistinct("price").alias("prices"),
        F.countDistinct("bedrooms").alias("bedrooms"),
    )


@query(
    "conditional_sum",
    """SELECT room_type, CAST(sum(CASE WHEN price <= 0 OR price IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unpriced
       FROM listings GROUP BY room_type""",
)
def _(m):
    unpriced = (F.col("price") <= 0) | F.col("price").isNull()
    return m.listings.groupBy("room_type").agg(F.sum(F.when(unpriced, 1).otherwise(0)).alias("unpriced"))


def profile_sql(source: str, file_key: str, columns: list[tuple[str, str, str | None]]) -> str:
    """``columns``: name, type name, and the expression whose range is shown (or None)."""
    parts = []
    for name, dtype, ranged in columns:
        low = f"min({ranged})::VARCHAR" if ranged else "NULL::VARCHAR"
        high = f"max({ranged})::VARCHAR" if ranged else "NULL::VARCHAR"
        parts.append(
            f"""SELECT '{file_key}' AS file_key, '{file_key}.csv' AS file_name, '{name}' AS column_name,
            '{dtype}' AS dtype, count(*) AS row_count, {len(columns)}::BIGINT AS column_count,
            count(*) - count({name}) AS missing_count,
            round_even((count(*) - count({name}))::DOUBLE / count(*)::DOUBLE * 100 * 100, 0) / 100 AS missing_pct,
            count(DISTINCT {name}) AS unique_count,
            (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS duplicate_rows,
            {low} AS min_value, {high} AS max_value FROM {source}"""
        )
    return "\nUNION ALL ".join(parts)


@query(
    "profile_columns",
    profile_sql(
        "calendar",
        "calendar",
        [
            ("listing_id", "bigint", "listing_id"),
            ("date", "date", "date"),
            ("available", "boolean", None),
            ("price", "double", "price"),
            ("adjusted_price", "double", "adjusted_price"),
            ("minimum_nights", "int", "minimum_nights"),
            ("maximum_nights", "int", "maximum_nights"),
        ],
    )
    + "\nUNION ALL "
    + profile_sql(
        "reviews",
        "reviews",
        [
            ("listing_id", "bigint", "listing_id"),
            ("id", "bigint", "id"),
            ("date", "date", "date"),
            ("reviewer_id", "bigint", "reviewer_id"),
            ("reviewer_name", "string", None),
            ("comments", "string", None),
        ],
    ),
)
def _(m):
    return profile.profile_tables(
        m.spark, {"calendar": ("calendar.csv", m.calendar), "reviews": ("reviews.csv", m.reviews)}
    )


LISTING_TYPES = """id bigint, name string, description string, host_id bigint, host_name string, host_since date,
    host_is_superhost boolean, host_total_listings_count double, neighbourhood_cleansed string,
    neighbourhood_group_cleansed string, latitude double, longitude double, property_type string, room_type string,
    accommodates int, bathrooms double, bathrooms_text string, bedrooms double, beds double, price double,
    minimum_nights int, maximum_nights int, availability_30 int, availability_60 int, availability_90 int,
    availability_365 int, number_of_reviews int, number_of_reviews_ltm int, last_review date,
    review_scores_rating double, review_scores_accuracy double, review_scores_cleanliness double,
    review_scores_checkin double, review_scores_communication double, review_scores_location double,
    review_scores_value double, instant_bookable boolean, calculated_host_listings_count int,
    reviews_per_month double"""


def _opened(read):
    """The table, or what kept it from being opened; its path is left out of the message."""
    try:
        return read()
    except AnalysisException as error:
        return ValueError(error.getCondition())


@query(
    "profile_columns_all_tables",
    ORACLES["profile_columns"].removeprefix(VIEWS)
    + "\nUNION ALL "
    + profile_sql(
        "listings",
        "listings",
        [
            (name, dtype, None if dtype in ("string", "boolean") else name)
            for name, dtype in (column.split() for column in LISTING_TYPES.split(","))
        ],
    )
    + "\nUNION ALL "
    + profile_sql(
        "neighbourhoods", "neighbourhoods", [("neighbourhood_group", "string", None), ("neighbourhood", "string", None)]
    )
    + """\nUNION ALL SELECT 'missing', 'missing.csv', 'ERROR', 'PATH_NOT_FOUND', 0, 0, 0, 0.0, 0, 0,
            NULL::VARCHAR, NULL::VARCHAR""",
)
def _(m):
    """Every table, and one that cannot be opened."""
    tables = {
        "calendar": lambda: m.calendar,
        "reviews": lambda: m.reviews,
        "listings": lambda: m.listings,
        "neighbourhoods": lambda: m.neighbourhoods,
        "missing": lambda: m.table("no-such-table"),
    }
    return profile.profile_tables(m.spark, {key: (f"{key}.csv", _opened(read)) for key, read in tables.items()})


@query(
    "duplicate_rows",
    """, doubled AS (SELECT * FROM listings UNION ALL SELECT * FROM listings WHERE price > 100000)
       SELECT (SELECT count(*) FROM doubled) - (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS duplicate_rows""",
)
def _(m):
    """All columns, over the listings with the dear ones twice, so that there is something to find."""
    return profile.duplicate_rows(m.listings.unionByName(m.listings.where(F.col("price") > 100000)))


@query("distinct_values", "SELECT DISTINCT date FROM calendar WHERE date IS NOT NULL")
def _(m):
    return m.calendar.select("date").where(F.col("date").isNotNull()).distinct().orderBy("date")


@query("dedupe_keep_first", "SELECT DISTINCT ON (host_id) host_id, id, room_type, price FROM listings ORDER BY host_id, id")
def _(m):
    return dedupe_keep_first(m.listings.select("host_id", "id", "room_type", "price"), ["host_id"], "id")


@query(
    "mean_var",
    """SELECT room_type, count(price) AS n, round(avg(price), 4) AS mean, round(var_samp(price), 0) AS variance
       FROM listings GROUP BY room_type""",
)
def _(m):
    return stats.mean_var(m.listings, ["room_type"], "price").select(
        "room_type", "n", F.round("mean", 4).alias("mean"), F.round("variance", 0).alias("variance")
    )


@query(
    "table_row_counts",
    """SELECT 'dim_neighbourhood' AS table_name, count(*) AS row_count FROM dim_neighbourhood
       UNION ALL SELECT 'dim_host', count(*) FROM dim_host
       UNION ALL SELECT 'dim_listing', count(*) FROM dim_listing
       UNION ALL SELECT 'dim_date', count(*) FROM dim_date
       UNION ALL SELECT 'fact_listing_snapshot', count(*) FROM fact_listing_snapshot
       UNION ALL SELECT 'fact_calendar', count(*) FROM fact_calendar
       UNION ALL SELECT 'fact_reviews', count(*) FROM fact_reviews""",
)
def _(m):
    return row_counts(m.star)
