"""Star-schema builds."""

from __future__ import annotations

from nestmetrics.catalog.registry import query
from nestmetrics.plans import warehouse


@query("build_dim_neighbourhood", "SELECT * FROM dim_neighbourhood")
def _(m):
    return warehouse.dim_neighbourhood(m.neighbourhoods)


@query("build_dim_host", "SELECT * FROM dim_host")
def _(m):
    return warehouse.dim_host(m.enriched)


@query("build_dim_listing", "SELECT * FROM dim_listing")
def _(m):
    return warehouse.dim_listing(m.enriched, m.star.dim_neighbourhood, m.star.dim_host)


@query("build_dim_date", "SELECT * FROM dim_date")
def _(m):
    return warehouse.dim_date(m.calendar)


@query("build_fact_listing_snapshot", "SELECT * FROM fact_listing_snapshot")
def _(m):
    return warehouse.fact_listing_snapshot(m.enriched, m.star.dim_listing)


@query("build_fact_calendar", "SELECT * FROM fact_calendar")
def _(m):
    return warehouse.fact_calendar(m.calendar)


@query("build_fact_reviews", "SELECT * FROM fact_reviews")
def _(m):
    return warehouse.fact_reviews(m.reviews)


@query("enrich_listings", "SELECT * FROM enriched")
def _(m):
    return m.enrich()
