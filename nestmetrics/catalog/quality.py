"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.plans import quality

Q = quality


def check_sql(
    table: str, name: str, failed: str, bad: str, severity: str, note: str, good: str, source: str | None = None
) -> str:
    """One report row; ``failed`` is an aggregate, ``note`` an expression of ``failed``."""
    return f"""SELECT '{name}' AS check_name, '{table}' AS table_name,
        CASE WHEN failed = 0 THEN 'PASS' ELSE '{bad}' END AS status, failed AS failed_rows, total AS total_rows,
        '{severity}' AS severity, CASE WHEN failed > 0 THEN {note} ELSE '{good}' END AS notes
        FROM (SELECT CAST({failed} AS BIGINT) AS failed, count(*) AS total FROM {source or table})"""


def not_null_sql(table, column, severity="ERROR", source=None):
    return check_sql(
        table, f"{column}_not_null", f"count(*) FILTER (WHERE {column} IS NULL)", "FAIL", severity,
        f"'{column} has ' || failed || ' null values'", "All values present", source,
    )


def duplicates_sql(table, column, severity="WARNING", source=None):
    failed = f"count(*) - count(DISTINCT {column}) - max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)"
    return check_sql(
        table, f"{column}_no_duplicates", failed, "WARN", severity, f"failed || ' duplicate {column} values'",
        "No duplicates", source,
    )


def range_sql(table, column, low, high, severity="ERROR"):
    return check_sql(
        table, f"{column}_in_range_[{low},{high}]", f"count(*) FILTER (WHERE {column} < {low} OR {column} > {high})",
        "FAIL", severity, f"failed || ' values outside [{low}, {high}]'", "All in range",
    )


def positive_sql(table, column, severity="WARNING"):
    return check_sql(
        table, f"{column}_greater_than_0", f"count(*) FILTER (WHERE {column} <= 0)", "WARN", severity,
        "failed || ' values <= 0'", "All positive",
    )


def boolean_sql(table, column, failed="0", severity="WARNING", source=None):
    return check_sql(
        table, f"{column}_is_boolean", failed, "WARN", severity, "failed || ' non-boolean values'", "All boolean", source
    )


def date_sql(table, column, severity="WARNING"):
    return check_sql(
        table, f"{column}_valid_date", f"count(*) FILTER (WHERE {column} IS NULL)", "WARN", severity,
        "failed || ' invalid/missing dates'", "All dates valid",
    )


def stack(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


def absent_sql(table: str, name: str, severity: str, note: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS table_name, 'FAIL' AS status, count(*) AS failed_rows,
        count(*) AS total_rows, '{severity}' AS severity, {note} AS notes FROM {table}"""


@query("check_not_null", stack(*[not_null_sql("listings", c) for c in ("id", "price", "longitude")]))
def _(m):
    return Q.run_checks(m.listings, "listings", [Q.not_null(c) for c in ("id", "price", "longitude")])


@query("check_no_duplicates", stack(*[duplicates_sql("listings", c) for c in ("id", "host_id", "bedrooms")]))
def _(m):
    return Q.run_checks(m.listings, "listings", [Q.no_duplicates(c) for c in ("id", "host_id", "bedrooms")])


@query(
    "check_range",
    stack(range_sql("listings", "latitude", -90, 90), range_sql("listings", "longitude", 100, 100.5),
          range_sql("listings", "bedrooms", 1, 3, "WARNING")),
)
def _(m):
    checks = [
        Q.in_range("latitude", -90, 90),
        Q.in_range("longitude", 100, 100.5),
        Q.in_range("bedrooms", 1, 3, "WARNING"),
    ]
    return Q.run_checks(m.listings, "listings", checks)


@query("check_positive", stack(positive_sql("listings", "price"), positive_sql("listings", "accommodates")))
def _(m):
    return Q.run_checks(m.listings, "listings", [Q.positive("price"), Q.positive("accommodates")])


@query(
    "check_boolean",
    stack(
        boolean_sql("listings", "host_is_superhost"),
        boolean_sql("listings", "beds", "count(*) FILTER (WHERE beds NOT IN (0, 1))"),
        boolean_sql("listings", "room_type", "count(room_type)"),
    ),
)
def _(m):
    return Q.run_checks(m.listings, "listings", [Q.is_boolean(c) for c in ("host_is_superhost", "beds", "room_type")])


@query("check_valid_date", stack(date_sql("calendar", "date", "ERROR")))
def _(m):
    """On the raw text dates, of which some do not parse."""
    return Q.run_checks(m.raw_calendar, "calendar", [Q.valid_date("date", "ERROR")])


@query(
    "check_missing_column",
    stack(
        absent_sql("reviews", "score_not_null", "ERROR", "'score has ' || count(*) || ' null values'"),
        absent_sql("reviews", "score_no_duplicates", "WARNING", "'Column score not found in reviews'"),
        absent_sql("reviews", "score_range_0_5", "ERROR", "'Column score not found'"),
        absent_sql("reviews", "score_positive", "WARNING", "'Column score not found'"),
        absent_sql("reviews", "score_is_boolean", "WARNING", "'Column score not found'"),
        absent_sql("reviews", "score_valid_date", "WARNING", "'Column score not found'"),
    ),
)
def _(m):
    checks = [
        Q.not_null("score"),
        Q.no_duplicates("score"),
        Q.in_range("score", 0, 5),
        Q.positive("score"),
        Q.is_boolean("score"),
        Q.valid_date("score"),
    ]
    return Q.run_checks(m.reviews, "reviews", checks)


@query(
    "check_primary_key",
    stack(
        not_null_sql("dim_listing", "listing_key"),
        duplicates_sql("dim_listing", "listing_key", "ERROR"),
        not_null_sql("dim_host", "host_key"),
        duplicates_sql("dim_host", "host_key", "ERROR"),
        not_null_sql("dim_date", "date_key"),
        duplicates_sql("dim_date", "date_key", "ERROR"),
        not_null_sql("dim_neighbourhood", "neighbourhood_key"),
        duplicates_sql("dim_neighbourhood", "neighbourhood_key", "ERROR"),
    ),
)
def _(m):
    star = m.star
    keys = {
        "dim_listing": "listing_key",
        "dim_host": "host_key",
        "dim_date": "date_key",
        "dim_neighbourhood": "neighbourhood_key",
    }
    report = None
    for table, key in keys.items():
        part = Q.check_primary_key(getattr(star, table), key, table)
        report = part if report is None else report.unionByName(part)
    return report


def orphan_sql(label: str, child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""SELECT '{label}' AS check_name, count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_keys
        FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {parent})"""


@query(
    "check_foreign_key",
    stack(
        orphan_sql("dim_listing.host_key", "dim_listing", "host_key", "dim_host", "host_key"),
        orphan_sql("fact_calendar.date_key", "fact_calendar", "date_key", "dim_date", "date_key"),
        orphan_sql("fact_reviews.date_key", "fact_reviews", "date_key", "dim_date", "date_key"),
        orphan_sql("dim_listing.neighbourhood_key", "dim_listing", "neighbourhood_key", "dim_neighbourhood", "neighbourhood_key"),
        orphan_sql("fact_listing_snapshot.listing_key", "fact_listing_snapshot", "listing_key", "dim_listing", "listing_key"),
        orphan_sql("fact_calendar.listing_id", "fact_calendar", "listing_id", "dim_listing", "listing_id"),
        orphan_sql("fact_reviews.listing_id", "fact_reviews", "listing_id", "dim_listing", "listing_id"),
    ),
)
def _(m):
    """Review days need not be calendar days, so that check finds orphans."""
    s = m.star
    report = None
    for label, parent, parent_key in (
        ("dim_listing.host_key", s.dim_host, "host_key"),
        ("fact_calendar.date_key", s.dim_date, "date_key"),
        ("fact_reviews.date_key", s.dim_date, "date_key"),
        ("dim_listing.neighbourhood_key", s.dim_neighbourhood, "neighbourhood_key"),
        ("fact_listing_snapshot.listing_key", s.dim_listing, "listing_key"),
        ("fact_calendar.listing_id", s.dim_listing, "listing_id"),
        ("fact_reviews.listing_id", s.dim_listing, "listing_id"),
    ):
        child, key = label.split(".")
        part = Q.check_foreign_key(getattr(s, child), key, parent, parent_key, label)
        report = part if report is None else report.unionByName(part)
    return report


REPORT = stack(
    not_null_sql("listings", "id"),
    duplicates_sql("listings", "id", "ERROR"),
    positive_sql("listings", "price"),
    range_sql("listings", "latitude", -90, 90),
    range_sql("listings", "longitude", -180, 180),
    range_sql("listings", "availability_365", 0, 365, "WARNING"),
    not_null_sql("listings", "room_type"),
    not_null_sql("calendar", "listing_id"),
    date_sql("calendar", "date", "ERROR"),
    boolean_sql("calendar", "available"),
    not_null_sql("reviews", "listing_id"),
    date_sql("reviews", "date"),
)


@query("quality_report", REPORT)
def _(m):
    return Q.quality_report(m.listings, m.calendar, m.reviews)


@query(
    "quality_summary",
    f"""SELECT count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) AS checks,
        coalesce(string_agg(table_name || '.' || check_name, ', ' ORDER BY table_name || '.' || check_name)
                 FILTER (WHERE status = 'FAIL'), '') AS failures FROM ({REPORT})""",
)
def _(m):
    return Q.report_summary(Q.quality_report(m.listings, m.calendar, m.reviews))


def star_sql(name: str, table: str, failed: str, where: str = "true") -> str:
    return f"""SELECT '{name}' AS check_name, count(*) AS total_rows,
        CAST(sum(CASE WHEN {failed} THEN 1 ELSE 0 END) AS BIGINT) AS failed_rows FROM {table} WHERE {where}"""


@query(
    "sql_quality_nulls",
    stack(
        star_sql("listing_id_null", "dim_listing", "listing_id IS NULL"),
        star_sql("room_type_not_null", "dim_listing", "room_type IS NULL"),
        star_sql("calendar_listing_id_not_null", "fact_calendar", "listing_id IS NULL"),
        star_sql("calendar_date_valid", "fact_calendar", "date_key IS NULL"),
        star_sql("reviews_listing_id_not_null", "fact_reviews", "listing_id IS NULL"),
    ),
)
def _(m):
    return Q.star_null_checks(m.star.dim_listing, m.star.fact_calendar, m.star.fact_reviews)


@query(
    "sql_quality_duplicates",
    """SELECT 'duplicate_listing_ids' AS check_name, count(*) - count(DISTINCT listing_id) AS duplicate_count
       FROM (SELECT CASE WHEN listing_key % 31 <> 0 THEN listing_id // 3 END AS listing_id FROM dim_listing)""",
)
def _(m):
    """With ids that repeat and ids that are missing."""
    ids = F.when(F.col("listing_key") % 31 != 0, F.floor(F.col("listing_id") / 3))
    return Q.star_duplicate_check(m.star.dim_listing.select(ids.alias("listing_id")))


@query("sql_quality_price_positive", star_sql("price_positive", "fact_listing_snapshot", "price <= 0 OR price IS NULL"))
def _(m):
    return Q.star_price_check(m.star.fact_listing_snapshot)


@query(
    "sql_quality_ranges",
    stack(
        star_sql("latitude_range", "dim_listing", "latitude < -90 OR latitude > 90", "latitude IS NOT NULL"),
        star_sql("longitude_range", "dim_listing", "longitude < -180 OR longitude > 180", "longitude IS NOT NULL"),
        star_sql(
            "availability_365_range", "fact_listing_snapshot", "availability_365 < 0 OR availability_365 > 365",
            "availability_365 IS NOT NULL",
        ),
    ),
)
def _(m):
    return Q.star_range_checks(m.star.dim_listing, m.star.fact_listing_snapshot)
