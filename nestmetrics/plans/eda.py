"""Exploratory datasets and the findings drawn from them."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.operators.facts import Fact, count_facts, leader, of, quantile_of, summarise
from nestmetrics.operators.histogram import histogram
from nestmetrics.operators.ordering import number_rows, top_k
from nestmetrics.operators.quantiles import exact_quantiles, global_quantile, median_by
from nestmetrics.plans import texts

def row_count() -> Column:
    return F.count(F.lit(1))


def area_column(df: DataFrame) -> str:
    return "neighbourhood_cleansed" if "neighbourhood_cleansed" in df.columns else "neighbourhood"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(row_count().alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(column))


def share_true(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(F.col(column).cast("double")).alias("share"))


def trimmed_prices(df: DataFrame, q: float = 0.99) -> DataFrame:
    """Prices above 0 and below the quantile of all known prices."""
    return df.where((F.col("price") > 0) & (F.col("price") < global_quantile(df, "price", q)))


def price_distribution(df: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(trimmed_prices(df), "price", bins)


def price_by_room_type(df: DataFrame) -> DataFrame:
    medians = median_by(df.where(F.col("room_type").isNotNull()), ["room_type"], "price", "median_price")
    return medians.where(F.col("median_price").isNotNull()).orderBy(F.desc("median_price"), "room_type")


def top_neighbourhoods(df: DataFrame, k: int = 15) -> DataFrame:
    area = area_column(df)
    medians = median_by(df.where(F.col(area).isNotNull()), [area], "price", "median_price")
    return top_k(medians.where(F.col("median_price").isNotNull()), [F.desc("median_price"), F.asc(area)], k)


def listings_by_neighbourhood(df: DataFrame, k: int = 15) -> DataFrame:
    return value_counts(df, area_column(df)).limit(k)


def host_listing_distribution(df: DataFrame, bins: int = 20, limit: int = 20) -> DataFrame:
    counts = df.select(E.clip_upper(F.col("calculated_host_listings_count"), limit).alias("listings"))
    return histogram(counts, "listings", bins)


def professional_vs_casual(df: DataFrame) -> DataFrame:
    counted = F.count("id") if "id" in df.columns else row_count()
    stats = median_by(
        df.where(F.col("is_professional_host").isNotNull()),
        ["is_professional_host"],
        "price",
        "median_price",
        {"avg_review_score": F.avg("review_scores_rating"), "count": counted},
    )
    return stats.select(
        "is_professional_host",
        E.round_half_even(F.col("median_price"), 2).alias("median_price"),
        E.round_half_even(F.col("avg_review_score"), 2).alias("avg_review_score"),
        "count",
    ).orderBy("is_professional_host")


def review_scores(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df, "review_scores_rating", bins)


def availability_by_month(calendar: DataFrame) -> DataFrame:
    """Share of free days per month; a day of unknown availability counts as not free."""
    free = F.coalesce(F.col("available"), F.lit(False)).cast("double")
    return (
        calendar.where(F.col("date").isNotNull())
        .groupBy(E.month_bucket(F.col("date")).alias("month"))
        .agg((F.avg(free) * 100).alias("available_pct"))
        .orderBy("month")
    )


def availability_range(calendar: DataFrame) -> DataFrame:
    months = availability_by_month(calendar)
    return months.agg(F.min("available_pct").alias("lowest_pct"), F.max("available_pct").alias("highest_pct"))


def _day_medians(calendar: DataFrame) -> DataFrame:
    """One row: weekday and weekend median, null where a side has no price."""
    days = calendar.withColumn("is_weekend", E.weekend_flag(F.col("date"), E.WEEKEND_FRI_SAT))
    medians = median_by(days, ["is_weekend"], "price", "m")
    return medians.agg(
        F.max(F.when(~F.col("is_weekend"), F.col("m"))).alias("weekday_median"),
        F.max(F.when(F.col("is_weekend"), F.col("m"))).alias("weekend_median"),
    )


def weekend_vs_weekday(calendar: DataFrame) -> DataFrame:
    """Median of positive prices on both sides, 0 where there is none, and their difference."""
    sides = _day_medians(calendar.where(F.col("price") > 0))
    filled = sides.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in sides.columns])
    return filled.withColumn(
        "difference_pct", E.percent_difference(F.col("weekend_median"), F.col("weekday_median"))
    )


# ---------------------------------------------------------------- findings


def _insight(order: int, chart: str, finding: Column) -> Column:
    return _insight_row(order, chart, finding, *texts.INSIGHTS[chart])


def _absent(order: int, chart: str) -> Column:
    finding, interpretation, limitation = texts.COLUMN_NOT_FOUND
    return _insight_row(order, chart, F.lit(finding), interpretation, limitation)


def _insight_row(order: int, chart: str, finding: Column, interpretation: str, limitation: str) -> Column:
    return F.struct(
        F.lit(order).alias("_order"),
        F.lit(chart).alias("chart_name"),
        finding.alias("finding"),
        F.lit(interpretation).alias("business_interpretation"),
        F.lit(limitation).alias("limitation"),
    )


def _text(template: str, **parts: Column) -> Column:
    """A template with its fields filled in; a missing figure is written as nan."""
    pieces = []
    for words, name, _, _ in Formatter().parse(template):
        pieces.append(F.lit(words))
        if name:
            pieces.append(F.coalesce(parts[name], F.lit("nan")))
    return F.concat(*pieces)


def insight_facts(df: DataFrame) -> list[Fact]:
    """What the findings need of the listings, as far as there are columns for it."""
    have = set(df.columns)
    area = area_column(df)
    facts = [Fact("price", F.col("price")), Fact("room", F.col("price"), F.col("room_type"), F.col("room_type").isNotNull())]
    if area in have:
        facts += [Fact("area", F.col("price"), F.col(area)), Fact("area_listings", key=F.col(area))]
    if "calculated_host_listings_count" in have:
        facts.append(Fact("professional", (F.col("calculated_host_listings_count") >= E.PROFESSIONAL_MIN_LISTINGS).cast("double")))
    if "is_professional_host" in have:
        flag = F.col("is_professional_host")
        facts.append(Fact("host_kind", key=flag, where=flag.isNotNull()))
    if "review_scores_rating" in have:
        facts.append(Fact("score", F.col("review_scores_rating")))
    return facts


def day_facts(name: str, where: Column | None = None) -> Fact:
    """Prices by weekend (true) and weekday (false)."""
    weekend = E.weekend_flag(F.col("date"), E.WEEKEND_FRI_SAT)
    return Fact(name, F.col("price"), weekend, F.lit(True) if where is None else where)


def eda_insights(df: DataFrame, calendar: DataFrame | None = None, currency: str = "THB") -> DataFrame:
    """One finding per dataset, numbered from 1. Listings and calendar are read once each."""
    have = set(df.columns)
    area = area_column(df)
    sources = [(df, insight_facts(df))]
    if calendar is not None:
        date = F.col("date")
        free = Fact("free", F.coalesce(F.col("available"), F.lit(False)).cast("double"), E.month_bucket(date), date.isNotNull())
        sources.append((calendar, [free, day_facts("day", F.col("price") > 0)]))
    counts = count_facts(sources)
    # The price distribution leaves out what lies above the 99th percentile of all known prices.
    typical = (F.col("v") > 0) & (F.col("v") < quantile_of(counts, "price", 0.99))
    groups = summarise(counts.where((F.col("fact") != "price") | typical), ["price", "room", "area", "score", "day"])
    zero = F.lit(0)
    figures = groups.agg(
        of("price", "median").alias("price"),
        F.coalesce(of("price", "n"), zero).alias("priced"),
        leader("room", "median").alias("room"),
        F.count_if((F.col("fact") == "room") & F.col("median").isNotNull()).alias("rooms"),
        leader("area", "median").alias("area"),
        leader("area_listings", "n").alias("area_listings"),
        of("professional", "mean").alias("professional"),
        # Counts of the last and first group in flag order, which is what one group alone shows twice.
        F.max_by("n", F.when(F.col("fact") == "host_kind", F.col("key"))).alias("last_kind"),
        F.min_by("n", F.when(F.col("fact") == "host_kind", F.col("key"))).alias("first_kind"),
        of("score", "median").alias("score"),
        F.coalesce(of("score", "n"), zero).alias("scored"),
        F.min(F.when(F.col("fact") == "free", F.col("mean") * 100)).alias("lowest_free"),
        F.max(F.when(F.col("fact") == "free", F.col("mean") * 100)).alias("highest_free"),
        F.coalesce(of("day", "median", "true"), F.lit(0.0)).alias("weekend"),
        F.coalesce(of("day", "median", "false"), F.lit(0.0)).alias("weekday"),
    )
    unit = F.lit(currency)
    say = texts.FINDINGS
    rows = [
        _insight(
            1, "price_distribution",
            _text(say["price_distribution"], price=E.whole(F.col("price")), currency=unit, listings=E.whole(F.col("priced"))),
        ),
        _insight(
            2, "price_by_room_type",
            _text(say["price_by_room_type"], room=F.coalesce(F.col("room.name"), F.lit("N/A")), rooms=F.col("rooms").cast("string")),
        ),
    ]
    if area in have:
        price = E.whole(F.col("area.figure"))
        rows.append(_insight(3, "top_neighbourhoods_price", _text(say["top_neighbourhoods_price"], area=F.col("area.name"), price=price, currency=unit)))
        listings = E.whole(F.col("area_listings.figure"))
        rows.append(_insight(4, "listings_by_neighbourhood", _text(say["listings_by_neighbourhood"], area=F.col("area_listings.name"), listings=listings)))
    else:
        rows += [_absent(3, "top_neighbourhoods_price"), _absent(4, "listings_by_neighbourhood")]
    if "calculated_host_listings_count" in have:
        share = E.one_decimal(F.col("professional") * 100)
        rows.append(_insight(5, "host_listing_distribution", _text(say["host_listing_distribution"], share=share)))
    else:
        rows.append(_absent(5, "host_listing_distribution"))
    if "is_professional_host" in have:
        kinds = {"professional": E.whole(F.col("last_kind")), "casual": E.whole(F.col("first_kind"))}
        rows.append(_insight(6, "professional_vs_casual", _text(say["professional_vs_casual"], **kinds)))
    else:
        rows.append(_absent(6, "professional_vs_casual"))
    if "review_scores_rating" in have:
        scores = {"score": E.two_decimals(F.col("score")), "listings": E.whole(F.col("scored"))}
        rows.append(_insight(7, "review_score_distribution", _text(say["review_score_distribution"], **scores)))
    else:
        rows.append(_absent(7, "review_score_distribution"))
    if calendar is not None:
        free_days = {"lowest": E.one_decimal(F.col("lowest_free")), "highest": E.one_decimal(F.col("highest_free"))}
        rows.append(_insight(8, "availability_by_month", _text(say["availability_by_month"], **free_days)))
        difference = E.signed_one_decimal(E.percent_difference(F.col("weekend"), F.col("weekday")))
        prices = {"weekend": E.whole(F.col("weekend")), "weekday": E.whole(F.col("weekday"))}
        rows.append(
            _insight(9, "weekend_vs_weekday_price", _text(say["weekend_vs_weekday_price"], currency=unit, difference=difference, **prices))
        )
    return number_rows(figures.select(F.inline(F.array(*rows))), "_order", "insight_id")
