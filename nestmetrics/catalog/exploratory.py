"""Exploratory datasets."""

from __future__ import annotations

from nestmetrics.catalog.aggregates import (
    MONTHLY_AVAILABILITY,
    PRO_VS_CASUAL,
    WEEKEND_VS_WEEKDAY,
    histogram_sql,
)
from nestmetrics.catalog.registry import query
from nestmetrics.plans import eda, texts

TRIMMED = "(SELECT price FROM listings WHERE price > 0 AND price < (SELECT quantile_cont(price, 0.99) FROM listings))"
ROOM_MEDIANS = """SELECT room_type, median(price) AS median_price FROM enriched WHERE room_type IS NOT NULL
    GROUP BY room_type HAVING median(price) IS NOT NULL"""
AREA_MEDIANS = """SELECT neighbourhood_cleansed, median(price) AS median_price FROM enriched
    WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1 HAVING median(price) IS NOT NULL
    ORDER BY median_price DESC, neighbourhood_cleansed LIMIT 15"""
AREA_COUNTS = """SELECT neighbourhood_cleansed, count(*) AS count FROM enriched
    WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1 ORDER BY count DESC, neighbourhood_cleansed LIMIT 15"""


@query("eda_price_distribution", histogram_sql(TRIMMED, "price", 50))
def _(m):
    return eda.price_distribution(m.enriched)


@query("eda_price_by_room_type", ROOM_MEDIANS)
def _(m):
    return eda.price_by_room_type(m.enriched)


@query("eda_top_neighbourhoods", AREA_MEDIANS)
def _(m):
    return eda.top_neighbourhoods(m.enriched)


@query("eda_listings_by_neighbourhood", AREA_COUNTS)
def _(m):
    return eda.listings_by_neighbourhood(m.enriched)


@query(
    "eda_host_listing_distribution",
    histogram_sql("(SELECT least(calculated_host_listings_count, 20) AS n FROM listings)", "n", 20),
)
def _(m):
    return eda.host_listing_distribution(m.enriched)


@query("eda_pro_vs_casual", PRO_VS_CASUAL)
def _(m):
    return eda.professional_vs_casual(m.enriched)


@query("eda_review_scores", histogram_sql("listings", "review_scores_rating", 30))
def _(m):
    return eda.review_scores(m.enriched)


@query("eda_availability_by_month", MONTHLY_AVAILABILITY)
def _(m):
    return eda.availability_by_month(m.calendar)


@query("eda_weekend_vs_weekday", WEEKEND_VS_WEEKDAY)
def _(m):
    return eda.weekend_vs_weekday(m.calendar)


# Findings in report order: name and the SQL of its sentence.
FINDINGS = {
    "price_distribution": f"""SELECT 'Median price is ' || format('{{:,.0f}}', median(price)) ||
        ' THB. Distribution is right-skewed with ' || format('{{:,}}', count(*)) || ' listings.' FROM {TRIMMED}""",
    "price_by_room_type": f"""SELECT '''' || arg_max(room_type, median_price) || ''' has the highest median price. ' ||
        count(*) || ' room types observed.' FROM ({ROOM_MEDIANS})""",
    "top_neighbourhoods_price": f"""SELECT 'Top neighbourhood: ' || neighbourhood_cleansed || ' (median ' ||
        format('{{:,.0f}}', median_price) || ' THB).' FROM ({AREA_MEDIANS}) LIMIT 1""",
    "listings_by_neighbourhood": f"""SELECT 'Most listings in ' || neighbourhood_cleansed || ' (' ||
        format('{{:,}}', count) || ' listings).' FROM ({AREA_COUNTS}) LIMIT 1""",
    "host_listing_distribution": """SELECT printf('%.1f',
        avg(CASE WHEN calculated_host_listings_count >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100) ||
        '% of listings belong to professional hosts (≥3 listings).' FROM listings""",
    "professional_vs_casual": """SELECT 'Professional hosts: ' ||
        format('{:,}', count(*) FILTER (WHERE is_professional_host)) || ' listings. Casual: ' ||
        format('{:,}', count(*) FILTER (WHERE NOT is_professional_host)) || ' listings.' FROM enriched""",
    "review_score_distribution": """SELECT 'Median review score: ' || printf('%.2f', median(review_scores_rating)) ||
        '. ' || format('{:,}', count(review_scores_rating)) || ' listings with reviews.' FROM listings""",
    "availability_by_month": f"""SELECT 'Availability ranges from ' || printf('%.1f', min(available_pct)) ||
        '% to ' || printf('%.1f', max(available_pct)) || '%.' FROM ({MONTHLY_AVAILABILITY})""",
    "weekend_vs_weekday_price": f"""SELECT 'Weekend median: ' || format('{{:,.0f}}', weekend_median) ||
        ' THB, Weekday: ' || format('{{:,.0f}}', weekday_median) || ' THB (' || printf('%+.1f', difference_pct) ||
        '% difference).' FROM ({WEEKEND_VS_WEEKDAY})""",
}


def insights_sql() -> str:
    rows = []
    for i, (chart, finding) in enumerate(FINDINGS.items(), 1):
        interpretation, limitation = texts.INSIGHTS[chart]
        rows.append(
            f"SELECT {i} AS insight_id, '{chart}' AS chart_name, ({finding}) AS finding, "
            f"'{interpretation}' AS business_interpretation, '{limitation}' AS limitation"
        )
    return "\nUNION ALL ".join(rows)


@query("eda_insights", insights_sql())
def _(m):
    return eda.eda_insights(m.enriched, m.calendar)


@query(
    "eda_insights_without_columns",
    """SELECT chart_name, finding FROM (VALUES
       ('price_by_room_type', 'n/a'), ('top_neighbourhoods_price', 'Column not found'),
       ('listings_by_neighbourhood', 'Column not found'), ('host_listing_distribution', 'Column not found'),
       ('professional_vs_casual', 'Column not found'), ('review_score_distribution', 'Column not found'))
       v(chart_name, finding) WHERE finding <> 'n/a' AND (SELECT count(*) FROM listings) > 0""",
)
def _(m):
    """A table with prices and room types only."""
    report = eda.eda_insights(m.listings.select("id", "price", "room_type"))
    return report.where("finding = 'Column not found'").select("chart_name", "finding")
