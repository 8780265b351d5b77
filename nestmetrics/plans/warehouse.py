"""Star schema: three dimensions, a date dimension and three facts."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.operators.joins import lookup_key
from nestmetrics.operators.ordering import dedupe_keep_first, surrogate_key
from nestmetrics.schemas import star_schema
from nestmetrics.sources import sinks, versions

# Source column -> star column where the names differ.
LISTING_RENAMES = {"id": "listing_id"}
REVIEW_RENAMES = {"id": "review_id"}


def _shape(df: DataFrame, table: str) -> DataFrame:
    return E.project_schema(df, star_schema(table))


def dim_neighbourhood(neighbourhoods: DataFrame) -> DataFrame:
    if "neighbourhood_group" not in neighbourhoods.columns:
        neighbourhoods = neighbourhoods.withColumn("neighbourhood_group", F.lit(None).cast("string"))
    areas = dedupe_keep_first(
        neighbourhoods.select("neighbourhood", "neighbourhood_group"), ["neighbourhood"], "neighbourhood_group"
    )
    keyed = surrogate_key(areas, "neighbourhood", "neighbourhood_key")
    return _shape(keyed.withColumnRenamed("neighbourhood", "neighbourhood_name"), "dim_neighbourhood")


def dim_host(enriched: DataFrame) -> DataFrame:
    """One row per host with the attributes of its first listing; no tier reads 'nan'."""
    columns = [f.name for f in star_schema("dim_host").fields if f.name in enriched.columns]
    hosts = dedupe_keep_first(enriched.select("id", *columns), ["host_id"], "id")
    keyed = surrogate_key(hosts.drop("id"), "host_id", "host_key")
    if "host_tier" in columns:
        keyed = keyed.withColumn("host_tier", F.coalesce("host_tier", F.lit("nan")))
    return _shape(keyed, "dim_host")


def dim_listing(enriched: DataFrame, neighbourhoods: DataFrame, hosts: DataFrame) -> DataFrame:
    """One row per listing. ``neighbourhoods`` and ``hosts`` are the finished dimensions."""
    wanted = {f.name for f in star_schema("dim_listing").fields} | {"id", "host_id", "neighbourhood_cleansed"}
    df = surrogate_key(enriched.select(*[c for c in enriched.columns if c in wanted]), "id", "listing_key")
    if "neighbourhood_cleansed" in df.columns:
        df = lookup_key(df, neighbourhoods, "neighbourhood_cleansed", "neighbourhood_name", "neighbourhood_key")
    if "host_id" in df.columns:
        df = lookup_key(df, hosts, "host_id", "host_id", "host_key")
    return _shape(df.withColumnsRenamed(LISTING_RENAMES), "dim_listing")


def dim_date(calendar: DataFrame) -> DataFrame:
    days = calendar.select(F.col("date").alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    parts = E.date_parts(F.col("full_date"))
    return _shape(days.select(*[c.alias(n) for n, c in parts.items()]), "dim_date")


def fact_listing_snapshot(enriched: DataFrame, listings: DataFrame) -> DataFrame:
    """The measures of each listing. ``listings`` is the finished dimension."""
    keyed = lookup_key(enriched, listings, "id", "listing_id", "listing_key", unique=False)
    return _shape(keyed, "fact_listing_snapshot")


def fact_calendar(calendar: DataFrame) -> DataFrame:
    return _shape(calendar.withColumn("date_key", E.date_key(F.col("date"))), "fact_calendar")


def fact_reviews(reviews: DataFrame) -> DataFrame:
    keyed = reviews.withColumn("date_key", E.date_key(F.col("date")))
    return _shape(keyed.withColumnsRenamed(REVIEW_RENAMES), "fact_reviews")


@dataclass(frozen=True)
class Star:
    dim_neighbourhood: DataFrame
    dim_host: DataFrame
    dim_listing: DataFrame
    dim_date: DataFrame
    fact_listing_snapshot: DataFrame
    fact_calendar: DataFrame
    fact_reviews: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def build_star(
    spark: SparkSession,
    root: str,
    enriched: DataFrame,
    calendar: DataFrame,
    reviews: DataFrame,
    neighbourhoods: DataFrame,
    table_prefix: str | None = None,
    buckets: int | None = None,
) -> Star:
    """Write all seven tables as a new version below ``root`` (full reload) and return them as read back.

    The version is published after its last table is written, so a reload that fails leaves the star
    before it whole, and readers never see tables of two loads. Dimensions are written first: later tables
    look keys up in the stored ones. With a ``table_prefix`` and ``buckets`` the two listing-grain
    tables are bucketed by listing_key, so that joining them needs no shuffle; their names end with the
    load's. The calendar is laid out by month.
    """
    folder = versions.begin(root)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        if buckets and table_prefix and name in ("dim_listing", "fact_listing_snapshot"):
            load = folder.rsplit("-", 1)[-1]
            return sinks.write_bucketed(df, f"{table_prefix}_{name}_{load}", path, "listing_key", buckets)
        if name == "fact_calendar":
            month = F.coalesce(F.floor(F.col("date_key") / 100).cast("int"), F.lit(0))
            sinks.write_partitioned(df.withColumn("month_key", month), path, "month_key")
        else:
            sinks.write_parquet(df, path)
        return spark.read.schema(star_schema(name)).parquet(path)

    areas = stored(dim_neighbourhood(neighbourhoods), "dim_neighbourhood")
    hosts = stored(dim_host(enriched), "dim_host")
    listings = stored(dim_listing(enriched, areas, hosts), "dim_listing")
    star = Star(
        dim_neighbourhood=areas,
        dim_host=hosts,
        dim_listing=listings,
        dim_date=stored(dim_date(calendar), "dim_date"),
        fact_listing_snapshot=stored(fact_listing_snapshot(enriched, listings), "fact_listing_snapshot"),
        fact_calendar=stored(fact_calendar(calendar), "fact_calendar"),
        fact_reviews=stored(fact_reviews(reviews), "fact_reviews"),
    )
    versions.publish(spark, root, folder)
    return star


def open_star(spark: SparkSession, root: str, version: int | None = None) -> Star:
    """The seven tables of the newest version, or of one by its number, as plain Parquet.

    The version is resolved once, here: the frames keep to it when later loads are published.
    """
    folder = versions.resolve(spark, root, version).folder
    return Star(**{f.name: spark.read.schema(star_schema(f.name)).parquet(f"{folder}/{f.name}") for f in fields(Star)})


def row_counts(star: Star) -> DataFrame:
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in star.tables().items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def listings_from_star(star: Star) -> DataFrame:
    """Dimension and measures side by side, every listing kept."""
    return star.dim_listing.join(star.fact_listing_snapshot, "listing_key", "left")


def calendar_from_star(star: Star) -> DataFrame:
    """Priced days with their date rebuilt from the key."""
    return star.fact_calendar.where(F.col("price").isNotNull()).select(
        E.date_key_to_date(F.col("date_key")).alias("date"), "available", "price"
    )
