"""The market tables, derived from the generic test tables.

``listings``, ``calendar``, ``reviews`` and ``neighbourhoods`` are typed; the ``raw_`` forms are
the same rows as untidy text, so that cleaning them must give the typed tables back. Nulls, zero
prices and dates that do not parse are set by arithmetic on the keys. Prices are whole currency
units, so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmetrics.plans.enrich import enrich_listings
from nestmetrics.plans.ml import Prepared, prepare
from nestmetrics.plans.warehouse import Star, build_star
from nestmetrics.session import WIDE, scratch_path, settings
from nestmetrics.sources.sinks import write_parquet

SNAPSHOT_DATE = "2001-12-31"
# Room types standing for entire homes and private rooms.
ENTIRE, PRIVATE = "1-URGENT", "5-LOW"

_MARKETS: dict[tuple[str, str], Market] = {}


def _date_text(d: Column, us_style: Column) -> Column:
    text = F.when(us_style, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    return F.coalesce(text, F.lit("not-a-date"))


def _price_text(price: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(price, 2)), F.lit(""))


def _flag_text(flag: Column, shout: Column) -> Column:
    return (
        F.when(flag & shout, " TRUE ").when(flag, "t").when(~flag & shout, "0").when(~flag, "f").when(shout, "maybe")
    )


class Market:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ typed tables

    @cached_property
    def _listing_sources(self) -> DataFrame:
        """What the listings are computed from, a narrow row for each."""
        orders = self.table("orders")
        since = orders.groupBy(F.col("o_custkey").alias("_host")).agg(F.min("o_orderdate").cast("date").alias("_since"))
        rows = orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey")).join(
            since, F.col("o_custkey") == F.col("_host"), "left"
        )
        return rows.select(
            F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "c_name", "c_nationkey", "c_acctbal", "_since"
        )

    @cached_property
    def listings(self) -> DataFrame:
        return self._as_listings(self._listing_sources)

    def _as_listings(self, sources: DataFrame) -> DataFrame:
        """The listing columns, and the columns that the sources have besides their own."""
        rows = sources.join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        more = [c for c in sources.columns if c not in self._listing_sources.columns]
        i, host = F.col("id"), F.col("o_custkey")
        reviews = i * 13 % 50
        unrated = i % 3 == 0

        def score(factor: int) -> Column:
            return F.when(~unrated, F.lit(3.0) + (i * factor % 129) / F.lit(64.0))

        return rows.select(
            i,
            F.concat(F.lit("Listing "), i.cast("string")).alias("name"),
            F.concat(F.lit("Stay with "), F.col("c_name")).alias("description"),
            host.alias("host_id"),
            F.col("c_name").alias("host_name"),
            F.when(host % 29 != 0, F.col("_since")).alias("host_since"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") > 5000).alias("host_is_superhost"),
            (1 + host * 7 % 13 + host % 3).cast("double").alias("host_total_listings_count"),
            F.col("n_name").alias("neighbourhood_cleansed"),
            F.col("r_name").alias("neighbourhood_group_cleansed"),
            (F.lit(13.0) + (i % 1000) / F.lit(1000.0)).alias("latitude"),
            F.when(i % 71 != 0, F.lit(100.0) + (i % 700) / F.lit(1000.0)).alias("longitude"),
            F.col("o_orderstatus").alias("property_type"),
            F.col("o_orderpriority").alias("room_type"),
            (1 + i % 8).cast("int").alias("accommodates"),
            (F.lit(1.0) + (i % 4) / F.lit(2.0)).alias("bathrooms"),
            F.concat((1 + i % 4).cast("string"), F.lit(" baths")).alias("bathrooms_text"),
            F.when(i % 6 != 5, (i % 6).cast("double")).alias("bedrooms"),
            F.when(i % 17 != 0, (1 + i % 5).cast("double")).alias("beds"),
            F.when(i % 11 == 0, None)
            .when(i % 97 == 0, 0.0)
            .otherwise(F.floor("o_totalprice").cast("double"))
            .alias("price"),
            (1 + i % 30).cast("int").alias("minimum_nights"),
            (30 + i % 1000).cast("int").alias("maximum_nights"),
            (i * 7 % 31).cast("int").alias("availability_30"),
            (i * 11 % 61).cast("int").alias("availability_60"),
            (i * 17 % 91).cast("int").alias("availability_90"),
            (i * 31 % 366).cast("int").alias("availability_365"),
            reviews.cast("int").alias("number_of_reviews"),
            (reviews % 12).cast("int").alias("number_of_reviews_ltm"),
            F.when(reviews != 0, F.date_add(F.lit("2001-01-01").cast("date"), (i % 365).cast("int"))).alias("last_review"),
            score(37).alias("review_scores_rating"),
            score(41).alias("review_scores_accuracy"),
            score(43).alias("review_scores_cleanliness"),
            score(47).alias("review_scores_checkin"),
            score(53).alias("review_scores_communication"),
            score(59).alias("review_scores_location"),
            score(61).alias("review_scores_value"),
            F.when(i % 50 != 0, i % 4 == 0).alias("instant_bookable"),
            (1 + host * 7 % 13).cast("int").alias("calculated_host_listings_count"),
            F.when(reviews == 0, 0.0).when(i % 10 != 0, F.lit(0.25) + (i % 40) / F.lit(8.0)).alias("reviews_per_month"),
            *more,
        )

    @cached_property
    def calendar(self) -> DataFrame:
        key, line = F.col("l_orderkey"), F.col("l_linenumber")
        return self.table("lineitem").select(
            key.alias("listing_id"),
            F.when((key + line) % 211 != 0, F.col("l_shipdate").cast("date")).alias("date"),
            F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False).alias("available"),
            F.when(line == 7, None)
            .when(key % 89 == 0, 0.0)
            .otherwise(F.floor("l_extendedprice").cast("double"))
            .alias("price"),
            F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double").alias("adjusted_price"),
            F.col("l_quantity").cast("int").alias("minimum_nights"),
            F.lit(1125).alias("maximum_nights"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("listing_id"),
            F.col("event_id").alias("id"),
            F.col("ts").cast("date").alias("date"),
            (F.col("event_id") % 97).alias("reviewer_id"),
            F.col("event_type").alias("reviewer_name"),
            F.col("props").alias("comments"),
        )

    @cached_property
    def neighbourhoods(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("r_name").alias("neighbourhood_group"), F.col("n_name").alias("neighbourhood"))
        )

    # ------------------------------------------------------------ the same rows as raw text

    @cached_property
    def raw_listings(self) -> DataFrame:
        i = F.col("id")

        def padded(c: str) -> Column:
            text = F.when(i % 4 == 0, F.concat(F.lit("  "), F.col(c), F.lit(" ")))
            return text.when(i % 9 == 0, F.concat(F.lit("\t"), F.col(c), F.lit(" \n"))).otherwise(F.col(c))

        return self.listings.withColumns(
            {
                "price": _price_text(F.col("price")),
                "host_since": _date_text(F.col("host_since"), F.col("host_id") % 5 == 0),
                "last_review": F.date_format("last_review", "yyyy-MM-dd"),
                "host_is_superhost": _flag_text(F.col("host_is_superhost"), i % 2 == 0),
                "instant_bookable": _flag_text(F.col("instant_bookable"), i % 2 == 0),
                "neighbourhood_cleansed": padded("neighbourhood_cleansed"),
                "neighbourhood_group_cleansed": padded("neighbourhood_group_cleansed"),
                "room_type": padded("room_type"),
                "property_type": padded("property_type"),
                "reviews_per_month": F.when(F.col("number_of_reviews") != 0, F.col("reviews_per_month")),
            }
        )

    @cached_property
    def raw_calendar(self) -> DataFrame:
        return self.calendar.withColumns(
            {
                "date": _date_text(F.col("date"), F.col("listing_id") % 5 == 0),
                "available": _flag_text(F.col("available"), F.col("listing_id") % 2 == 0),
                "price": _price_text(F.col("price")),
                "adjusted_price": _price_text(F.col("adjusted_price")),
            }
        )

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return self.reviews.withColumn("date", _date_text(F.col("date"), F.col("listing_id") % 5 == 0))

    @cached_property
    def raw_neighbourhoods(self) -> DataFrame:
        return self.neighbourhoods.select(
            F.concat(F.lit(" "), F.col("neighbourhood_group")).alias("neighbourhood_group"),
            F.concat(F.col("neighbourhood"), F.lit("\t ")).alias("neighbourhood"),
        )

    # ------------------------------------------------------------ derived tables

    def enrich(self) -> DataFrame:
        return enrich_listings(self._listing_sources, self.calendar, self.reviews, SNAPSHOT_DATE, self._as_listings)

    @cached_property
    def enriched(self) -> DataFrame:
        """The enriched listings as stored: written once per session, then only scanned."""
        path = scratch_path(self.spark, "enriched")
        frame = self.enrich()
        with settings(self.spark, WIDE):
            write_parquet(frame, path)
        return self.spark.read.schema(frame.schema).parquet(path)

    @cached_property
    def star(self) -> Star:
        """The stored star schema of these tables, written once per session."""
        root = scratch_path(self.spark, "star")
        return build_star(
            self.spark,
            root,
            self.enriched,
            self.calendar,
            self.reviews,
            self.neighbourhoods,
        )

    @cached_property
    def prepared(self) -> Prepared:
        """Split, imputed and coded rows for the price models, prepared once per session."""
        return prepare(self.enriched)


def market(spark: SparkSession, sf_dir: str) -> Market:
    """The market of a folder. Its frames are plans, so one per session is enough."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MARKETS:
        _MARKETS[key] = Market(spark, sf_dir)
    return _MARKETS[key]
