"""Dashboard datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmetrics.catalog.aggregates import histogram_sql
from nestmetrics.catalog.quality import REPORT
from nestmetrics.catalog.registry import ORACLES, VIEWS, query
from nestmetrics.plans import dashboard, quality


@query("dash_room_mix", "SELECT room_type, count(*) AS count FROM listings WHERE room_type IS NOT NULL GROUP BY room_type")
def _(m):
    return dashboard.room_mix(m.enriched)


BOUNDS = """SELECT low_price, greatest(low_price + 1, q99) AS high_price FROM (
    SELECT greatest(0, trunc(quantile_cont(price, 0.01))::BIGINT) AS low_price,
           trunc(quantile_cont(price, 0.99))::BIGINT AS q99 FROM enriched)"""


@query(
    "dash_price_histogram",
    histogram_sql(
        f"(SELECT price FROM listings WHERE price >= 0 AND price <= (SELECT high_price FROM ({BOUNDS})))", "price", 50
    ),
)
def _(m):
    high = dashboard.price_bounds(m.enriched).select("high_price").scalar()
    return dashboard.price_histogram(m.enriched, high)


@query(
    "dash_price_by_room",
    """SELECT room_type, median(price) AS typical_price FROM (
         SELECT CASE WHEN id % 23 <> 0 THEN room_type END AS room_type, price FROM enriched) GROUP BY room_type""",
)
def _(m):
    """Some stay types are missing; they form a bar of their own."""
    room = F.when(F.col("id") % 23 != 0, F.col("room_type"))
    return dashboard.price_by_room(m.enriched.withColumn("room_type", room))


@query(
    "dash_neighbourhood_matrix",
    """SELECT neighbourhood_cleansed, count(price) AS listing_count, median(price) AS typical_price FROM enriched
       GROUP BY 1 ORDER BY listing_count DESC, neighbourhood_cleansed LIMIT 20""",
)
def _(m):
    return dashboard.neighbourhood_matrix(m.enriched)


@query(
    "dash_map_points",
    """SELECT id, latitude, longitude, price, neighbourhood_cleansed FROM enriched
       WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
def _(m):
    return dashboard.map_points(m.enriched)


@query(
    "dash_host_segments",
    """SELECT CASE WHEN is_professional_host THEN 'Professional' ELSE 'Casual' END AS host_segment,
       count(*) AS listing_count, median(price) AS typical_price FROM enriched GROUP BY 1""",
)
def _(m):
    return dashboard.host_segments(m.enriched)


@query("dash_rating_histogram", histogram_sql("listings", "review_scores_rating", 20))
def _(m):
    return dashboard.rating_histogram(m.enriched)


@query(
    "dash_improvement_targets",
    """SELECT id, neighbourhood_cleansed, room_type, price, review_scores_rating, number_of_reviews FROM enriched
       WHERE review_scores_rating < (SELECT median(review_scores_rating) FROM enriched) AND number_of_reviews > 10
       ORDER BY number_of_reviews DESC, id LIMIT 10""",
)
def _(m):
    return dashboard.improvement_targets(m.enriched)


@query(
    "dash_seasonality",
    """, days AS (SELECT date, price, isodow(date) IN (5, 6) AS w FROM calendar
                  WHERE date IS NOT NULL AND price IS NOT NULL)
       SELECT 'day_type' AS series, CASE WHEN w THEN 'Weekend (Fri-Sat)' ELSE 'Weekday (Sun-Thu)' END AS period,
              median(price) AS typical_price FROM days GROUP BY 2
       UNION ALL SELECT 'month', strftime(date, '%Y-%m'), median(price) FROM days GROUP BY 2""",
)
def _(m):
    return dashboard.seasonality(m.calendar)


@query(
    "dash_failed_checks",
    f"""SELECT check_name, table_name, failed_rows FROM ({REPORT}
        UNION ALL SELECT 'price_not_null', 'listings', 'fail', count(*) FILTER (WHERE price IS NULL), count(*), 'ERROR',
        '' FROM listings) WHERE upper(status) = 'FAIL'""",
)
def _(m):
    """With one more check, whose status is in lower case."""
    more = quality.run_checks(m.listings, "listings", [quality.not_null("price")])
    report = quality.quality_report(m.listings, m.calendar, m.reviews).unionByName(
        more.withColumn("status", F.lower("status"))
    )
    return quality.failed_checks(report).select("check_name", "table_name", "failed_rows")


@query(
    "filter_options",
    f"""SELECT DISTINCT 'neighbourhood' AS filter, neighbourhood_cleansed AS option FROM enriched
        WHERE neighbourhood_cleansed IS NOT NULL
        UNION ALL SELECT DISTINCT 'room_type', room_type FROM enriched WHERE room_type IS NOT NULL
        UNION ALL SELECT 'low_price', low_price::VARCHAR FROM ({BOUNDS})
        UNION ALL SELECT 'high_price', high_price::VARCHAR FROM ({BOUNDS})""",
)
def _(m):
    return dashboard.filter_options(m.enriched)


# The same views where only the warehouse is there.


@query("dash_neighbourhood_matrix_from_star", ORACLES["dash_neighbourhood_matrix"].removeprefix(VIEWS))
def _(m):
    return dashboard.neighbourhood_matrix(dashboard.view_from_star(m.star, host=False))


@query("dash_map_points_from_star", ORACLES["dash_map_points"].removeprefix(VIEWS))
def _(m):
    return dashboard.map_points(dashboard.view_from_star(m.star, host=False))


@query("dash_host_segments_from_star", ORACLES["dash_host_segments"].removeprefix(VIEWS))
def _(m):
    return dashboard.host_segments(dashboard.view_from_star(m.star, area=False))


@query("dash_improvement_targets_from_star", ORACLES["dash_improvement_targets"].removeprefix(VIEWS))
def _(m):
    return dashboard.improvement_targets(dashboard.view_from_star(m.star, host=False))


@query("filter_options_from_star", ORACLES["filter_options"].removeprefix(VIEWS))
def _(m):
    return dashboard.filter_options(dashboard.view_from_star(m.star, host=False))


@query(
    "dash_seasonality_adjusted",
    ", priced AS (SELECT date, adjusted_price AS price FROM calendar)"
    + ORACLES["dash_seasonality"].removeprefix(VIEWS).replace("FROM calendar", "FROM priced"),
)
def _(m):
    """A calendar without the plain price: the next accepted column counts."""
    return dashboard.seasonality(m.calendar.drop("price"))
