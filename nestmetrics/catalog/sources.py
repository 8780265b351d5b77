"""Sources and sinks: tables are written to the shared folder and read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmetrics import schemas
from nestmetrics.catalog.registry import query
from nestmetrics.plans import clean, quality
from nestmetrics.plans.dashboard import market_filter
from nestmetrics.plans.warehouse import calendar_from_star, open_star, row_counts
from nestmetrics.session import scratch_path
from nestmetrics.sources import files, sinks


@query("scan_csv", "SELECT * FROM calendar")
def _(m):
    """Gzipped CSV with quoted text, read with a fixed schema, dealt out, then cleaned."""
    path = scratch_path(m.spark, "calendar-csv")
    m.raw_calendar.write.csv(path, header=True, quote='"', escape='"', compression="gzip")
    return clean.clean_calendar(files.read_csv(m.spark, path, schemas.RAW_CALENDAR_DDL, rebalance=True))


@query("scan_csv_multiline", "SELECT id, room_type, neighbourhood_cleansed, host_since, price FROM listings")
def _(m):
    """Listings whose text fields hold line breaks, tabs and blanks."""
    path = scratch_path(m.spark, "listings-csv")
    sinks.write_export(m.raw_listings, path)
    raw = files.read_csv(m.spark, path, m.raw_listings.schema, multi_line=True)
    return clean.clean_listings(raw).select("id", "room_type", "neighbourhood_cleansed", "host_since", "price")


@query("scan_parquet_optional", "SELECT o_orderkey, o_totalprice, false AS second_found FROM orders")
def _(m):
    first = files.read_parquet_optional(m.spark, f"{m.sf_dir}/orders.parquet")
    second = files.read_parquet_optional(m.spark, f"{m.sf_dir}/no-such-table.parquet")
    return first.select("o_orderkey", "o_totalprice", F.lit(second is not None).alias("second_found"))


@query("scan_pruned", "SELECT l_orderkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem")
def _(m):
    df = files.read_parquet_optional(m.spark, f"{m.sf_dir}/lineitem.parquet", ["l_orderkey", "l_shipdate"])
    return df.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("sink_parquet", "SELECT *, coalesce(strftime(date, '%Y-%m'), 'none') AS month FROM calendar")
def _(m):
    """The clean calendar by month; reading one month later opens one folder."""
    path = scratch_path(m.spark, "clean-calendar")
    month = F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none"))
    sinks.write_partitioned(m.calendar.withColumn("month", month), path, "month")
    schema = m.calendar.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    return m.spark.read.schema(f"{schema}, month string").parquet(path)


@query(
    "sink_csv_report",
    """SELECT 'availability' AS report, coalesce(strftime(date, '%Y-%m'), 'none') AS month, count(*) AS days
       FROM calendar GROUP BY 2""",
)
def _(m):
    path = scratch_path(m.spark, "report")
    report = m.calendar.groupBy(F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none")).alias("month")).agg(
        F.count(F.lit(1)).alias("days")
    )
    sinks.write_report(report.select(F.lit("availability").alias("report"), "month", "days"), path)
    return files.read_csv(m.spark, path, "report string, month string, days long")


@query(
    "sink_filtered_export",
    """SELECT id, room_type, price FROM enriched
       WHERE room_type = '1-URGENT' AND price BETWEEN 1000 AND 300000""",
)
def _(m):
    path = scratch_path(m.spark, "export")
    view = market_filter(m.enriched, rooms=["1-URGENT"], price_range=(1000, 300000))
    sinks.write_export(view.select("id", "room_type", "price"), path)
    return files.read_csv(m.spark, path, "id long, room_type string, price double")


@query("sink_filtered_export_empty", "SELECT id, room_type, price FROM enriched WHERE room_type = 'no such room'")
def _(m):
    """An export of a choice that nothing meets is empty."""
    path = scratch_path(m.spark, "export")
    view = market_filter(m.enriched, rooms=["no such room"])
    sinks.write_export(view.select("id", "room_type", "price"), path)
    return files.read_csv(m.spark, path, "id long, room_type string, price double")


@query(
    "warehouse_overwrite",
    """SELECT 'dim_neighbourhood' AS table_name, count(*) AS row_count FROM dim_neighbourhood
       UNION ALL SELECT 'dim_host', count(*) FROM dim_host
       UNION ALL SELECT 'dim_listing', count(*) FROM dim_listing
       UNION ALL SELECT 'dim_date', count(*) FROM dim_date
       UNION ALL SELECT 'fact_listing_snapshot', count(*) FROM fact_listing_snapshot
       UNION ALL SELECT 'fact_calendar', count(*) FROM fact_calendar
       UNION ALL SELECT 'fact_reviews', count(*) FROM fact_reviews""",
)
def _(m):
    """A second full load over the first leaves the same rows, in the declared columns."""
    from nestmetrics.plans.warehouse import build_star

    root = scratch_path(m.spark, "reload")
    for _attempt in range(2):
        build_star(m.spark, root, m.enriched, m.calendar, m.reviews, m.neighbourhoods)
    return row_counts(open_star(m.spark, root))


@query(
    "warehouse_versions",
    """, priced AS (SELECT * FROM calendar WHERE price IS NOT NULL),
       kept AS (
         SELECT 'dim_neighbourhood' AS table_name, count(*) AS row_count FROM dim_neighbourhood
         UNION ALL SELECT 'dim_host', count(*) FROM dim_host
         UNION ALL SELECT 'dim_listing', count(*) FROM dim_listing
         UNION ALL SELECT 'fact_listing_snapshot', count(*) FROM fact_listing_snapshot
         UNION ALL SELECT 'fact_reviews', count(*) FROM fact_reviews)
       SELECT 1 AS version, * FROM kept
       UNION ALL SELECT 2, * FROM kept
       UNION ALL SELECT 1, 'dim_date', count(*) FROM dim_date
       UNION ALL SELECT 1, 'fact_calendar', count(*) FROM fact_calendar
       UNION ALL SELECT 2, 'dim_date', count(DISTINCT date) FROM priced
       UNION ALL SELECT 2, 'fact_calendar', count(*) FROM priced""",
)
def _(m):
    """Two loads, the second of the priced days only: each version keeps its own rows."""
    from nestmetrics.plans.warehouse import build_star

    root = scratch_path(m.spark, "versions")
    for calendar in (m.calendar, m.calendar.where(F.col("price").isNotNull())):
        build_star(m.spark, root, m.enriched, calendar, m.reviews, m.neighbourhoods)
    first, second = (
        row_counts(open_star(m.spark, root, version)).select(F.lit(version).alias("version"), "table_name", "row_count")
        for version in (1, 2)
    )
    return first.unionByName(second)


@query(
    "scan_with_fallback",
    "SELECT strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS date, available, price, NULL::VARCHAR AS currency FROM fact_calendar",
)
def _(m):
    """No clean table, no warehouse table: the stored star is used and the date rebuilt."""
    root = scratch_path(m.spark, "fallback")
    sinks.write_parquet(m.star.fact_calendar, f"{root}/fact_calendar")
    sources = [f"{root}/clean_calendar", "no_such_table", f"{root}/fact_calendar"]
    return files.scan_with_fallback(m.spark, sources, ["date", "available", "price", "currency"])


@query(
    "calendar_from_warehouse",
    """SELECT strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS date, available, price
       FROM fact_calendar WHERE price IS NOT NULL""",
)
def _(m):
    return calendar_from_star(m.star)


@query("ingest_manifest")
def _(m):
    """Sizes and times of the table files, with one expected file that is absent."""
    root = m.sf_dir
    names = ["orders.parquet", "lineitem.parquet", "events.parquet", "customer.parquet", "absent.parquet"]
    registry = m.spark.createDataFrame(
        [(n.split(".")[0], f"file://{root}/{n}", n) for n in names],
        "file_key string, source_url string, local_name string",
    )
    return files.ingest_manifest(m.spark, root, registry, "test")


@query(
    "scan_reports",
    """SELECT check_name, status FROM (
         SELECT 'price_greater_than_0' AS check_name,
                CASE WHEN count(*) FILTER (WHERE price <= 0) = 0 THEN 'PASS' ELSE 'WARN' END AS status FROM listings
         UNION ALL SELECT 'room_type_not_null',
                CASE WHEN count(*) FILTER (WHERE room_type IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END FROM listings)""",
)
def _(m):
    root = scratch_path(m.spark, "reports")
    checks = [quality.positive("price"), quality.not_null("room_type")]
    sinks.write_report(quality.run_checks(m.listings, "listings", checks).select("check_name", "status"), f"{root}/quality")
    found = files.read_reports(
        m.spark,
        root,
        ["quality", "absent"],
        {"quality": "check_name string, status string", "absent": "check_name string, status string"},
    )
    return found["quality"].unionByName(found["absent"])
