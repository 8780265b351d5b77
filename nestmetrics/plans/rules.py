"""Rule-based recommendations. A rule that does not fire is an empty frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.operators.facts import Fact, count_facts, of, summarise
from nestmetrics.operators.ordering import number_rows
from nestmetrics.operators.quantiles import global_quantile, median_by
from nestmetrics.plans import eda, texts
from nestmetrics.sources.sinks import stored

# When the rules fire.
HOST_SHARE = 0.3
PRICE_FACTOR = 1.5
POOR_LISTINGS = 100
BUSY_DAYS = 180


def _recommendation(df: DataFrame, rule: str, finding: Column, evidence: Column) -> DataFrame:
    return df.select(_row(rule, finding, evidence).alias("_row")).select("_row.*")


def _row(rule: str, finding: Column, evidence: Column) -> Column:
    theme, meaning, action, confidence, limitation = texts.RULES[rule]
    return F.struct(
        F.lit(list(texts.RULES).index(rule) + 1).alias("_order"),
        F.lit(theme).alias("theme"),
        finding.alias("finding"),
        F.lit(meaning).alias("business_meaning"),
        F.lit(action).alias("recommended_action"),
        evidence.alias("evidence_metric"),
        F.lit(confidence).alias("confidence_level"),
        F.lit(limitation).alias("limitation"),
    )


def _money(c: Column, symbol: str) -> Column:
    return F.concat(F.lit(symbol), E.whole(c))


# What each rule says, from the columns that hold its figures: finding and evidence.


def _host_strategy(share: Column) -> tuple[Column, Column]:
    text = E.percent_text(share)
    return (
        F.concat(text, F.lit(" of listings are managed by professional hosts (≥3 listings).")),
        F.concat(F.lit("Professional Host Share: "), text),
    )


def _pricing_gap(high: Column, low: Column, symbol: str) -> tuple[Column, Column]:
    return (
        F.concat(
            F.lit("Entire homes typically price at "), _money(high, symbol),
            F.lit(", while private rooms are "), _money(low, symbol), F.lit("."),
        ),
        F.concat(F.lit("Entire vs Private gap: +"), E.percent_text((high - low) / low, "0")),
    )


def _opportunity(best: Column, found: Column) -> tuple[Column, Column]:
    return (
        F.concat(F.lit("'"), best, F.lit("' has low supply but commands top-tier pricing.")),
        F.concat(F.lit("Opportunity Neighbourhoods: "), found.cast("string"), F.lit(" found")),
    )


def _guest_experience(n: Column) -> tuple[Column, Column]:
    return (
        F.concat(F.lit("Found "), E.whole(n), F.lit(" listings with below-average reviews but high implied occupancy.")),
        F.concat(F.lit("Sub-par listings: "), E.whole(n)),
    )


def _weekend_premium(weekend: Column, weekday: Column, symbol: str) -> tuple[Column, Column]:
    return (
        F.concat(
            F.lit("Weekend prices ("), _money(weekend, symbol),
            F.lit(") are higher than weekday prices ("), _money(weekday, symbol), F.lit(")."),
        ),
        F.concat(
            F.lit("Weekend Premium: +"),
            F.coalesce(E.percent_text(F.try_divide(weekend - weekday, weekday)), F.lit("inf%")),
        ),
    )


# When a rule fires.


def _wide_gap(high: Column, low: Column, factor: float) -> Column:
    return (high > 0) & (low > 0) & (high > low * factor)


def rule_host_strategy(enriched: DataFrame, threshold: float = HOST_SHARE) -> DataFrame:
    share = eda.share_true(enriched, "is_professional_host").where(F.col("share") > threshold)
    return _recommendation(share, "host_strategy", *_host_strategy(F.col("share")))


def rule_pricing_gap(
    enriched: DataFrame,
    entire: str = "Entire home/apt",
    private: str = "Private room",
    factor: float = PRICE_FACTOR,
    symbol: str = "฿",
) -> DataFrame:
    medians = median_by(enriched.where(F.col("room_type").isin(entire, private)), ["room_type"], "price", "m")
    pair = medians.agg(
        F.max(F.when(F.col("room_type") == entire, F.col("m"))).alias("entire"),
        F.max(F.when(F.col("room_type") == private, F.col("m"))).alias("private"),
    )
    high, low = F.col("entire"), F.col("private")
    return _recommendation(pair.where(_wide_gap(high, low, factor)), "pricing_gap", *_pricing_gap(high, low, symbol))


def area_statistics(enriched: DataFrame) -> DataFrame:
    """Listing count and median price per area."""
    area = eda.area_column(enriched)
    counted = F.count("id") if "id" in enriched.columns else F.count(area)
    return median_by(enriched.where(F.col(area).isNotNull()), [area], "price", "median_price", {"count": counted})


def area_thresholds(areas: DataFrame) -> DataFrame:
    """One row: 80th percentile of the area medians, median of the area counts.

    The input has one row per area, so the built-in percentile holds little.
    """
    return areas.agg(
        F.percentile("median_price", F.lit(0.8)).alias("high_price"), F.percentile("count", F.lit(0.5)).alias("low_supply")
    )


def opportunities(areas: DataFrame, area: str) -> DataFrame:
    """One row: the dearest area (best) of those with top prices and low supply, and their number (found)."""
    limits = area_thresholds(areas)
    zones = areas.withColumn("_limits", limits.select(F.struct("high_price", "low_supply")).scalar()).where(
        (F.col("median_price") >= F.col("_limits.high_price")) & (F.col("count") <= F.col("_limits.low_supply"))
    )
    return zones.agg(
        F.min_by(F.col(area), F.struct(-F.col("median_price"), F.col(area))).alias("best"),
        F.count(F.lit(1)).alias("found"),
    )


def rule_neighbourhood_opportunity(enriched: DataFrame) -> DataFrame:
    best = opportunities(area_statistics(enriched), eda.area_column(enriched)).where(F.col("found") > 0)
    return _recommendation(best, "neighbourhood_opportunity", *_opportunity(F.col("best"), F.col("found")))


def rule_guest_experience(enriched: DataFrame, minimum: int = POOR_LISTINGS) -> DataFrame:
    middle = global_quantile(enriched, "review_scores_rating", 0.5)
    poor = enriched.where((F.col("review_scores_rating") < middle) & (F.col("availability_365") < BUSY_DAYS))
    counted = poor.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > minimum)
    return _recommendation(counted, "guest_experience", *_guest_experience(F.col("n")))


def rule_weekend_premium(calendar: DataFrame, symbol: str = "฿") -> DataFrame:
    """Unlike the exploratory comparison, prices of 0 count here."""
    weekend, weekday = F.col("weekend_median"), F.col("weekday_median")
    fired = eda._day_medians(calendar).where(weekend > weekday)
    return _recommendation(fired, "weekend_premium", *_weekend_premium(weekend, weekday, symbol))


def recommendations(
    enriched: DataFrame,
    calendar: DataFrame | None = None,
    entire: str = "Entire home/apt",
    private: str = "Private room",
    symbol: str = "฿",
) -> DataFrame:
    """All rules that fire, numbered from 1. No listings, no recommendations.

    The figures of all rules are facts of one count: listings and calendar are read once each.
    """
    have = set(enriched.columns)
    area = eda.area_column(enriched)
    price, rating = F.col("price"), F.col("review_scores_rating")
    facts = [Fact("listing")]
    if "is_professional_host" in have:
        facts.append(Fact("professional", F.col("is_professional_host").cast("double")))
    if {"room_type", "price"} <= have:
        facts.append(Fact("room", price, F.col("room_type"), F.col("room_type").isin(entire, private)))
    with_areas = {"price", area} <= have
    if with_areas:
        known = F.col(area).isNotNull()
        counted = F.col("id" if "id" in have else area).isNotNull()
        facts += [Fact("area", price, F.col(area), known), Fact("area_listing", F.when(counted, 1.0), F.col(area), known)]
    if {"review_scores_rating", "availability_365"} <= have:
        facts += [Fact("score", rating), Fact("busy_score", rating, where=F.col("availability_365") < BUSY_DAYS)]
    sources = [(enriched, facts)]
    if calendar is not None and {"price", "date"} <= set(calendar.columns):
        sources.append((calendar, [eda.day_facts("day")]))
    counts = count_facts(sources)
    groups = stored(summarise(counts, ["room", "area", "score", "day"]), "fact-groups")

    figures = groups.agg(
        of("listing", "n").alias("listings"),
        of("professional", "mean").alias("share"),
        of("room", "median", entire).alias("entire"),
        of("room", "median", private).alias("private"),
        of("day", "median", "true").alias("weekend"),
        of("day", "median", "false").alias("weekday"),
    )
    middle = groups.where("fact = 'score'").select("median").scalar()
    poor = counts.where((F.col("fact") == "busy_score") & (F.col("v") < middle)).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    by_area = groups.where(F.col("fact").isin("area", "area_listing")).groupBy("key").agg(
        F.max(F.when(F.col("fact") == "area", F.col("median"))).alias("median_price"),
        F.max(F.when(F.col("fact") == "area_listing", F.col("n"))).alias("count"),
    )
    best = opportunities(by_area, "key").select(F.struct("best", "found"))
    figures = figures.withColumns({"poor": poor.scalar(), "zone": best.scalar()})

    f = {name: F.col(name) for name in figures.columns}
    rules = [
        (f["share"] > HOST_SHARE, _row("host_strategy", *_host_strategy(f["share"]))),
        (_wide_gap(f["entire"], f["private"], PRICE_FACTOR), _row("pricing_gap", *_pricing_gap(f["entire"], f["private"], symbol))),
        (F.col("zone.found") > 0, _row("neighbourhood_opportunity", *_opportunity(F.col("zone.best"), F.col("zone.found")))),
        (f["poor"] > POOR_LISTINGS, _row("guest_experience", *_guest_experience(f["poor"]))),
        ((f["listings"] > 0) & (f["weekend"] > f["weekday"]), _row("weekend_premium", *_weekend_premium(f["weekend"], f["weekday"], symbol))),
    ]
    fired = F.filter(F.array(*[F.when(fires, row) for fires, row in rules]), lambda row: row.isNotNull())
    return number_rows(figures.select(F.inline(fired)), "_order", "recommendation_id")


def market_kpis(view: DataFrame) -> DataFrame:
    """One row: listings, median price, professional share, mean rating. The view is read once."""
    professional = E.lenient_bool(F.col("is_professional_host")).cast("double")
    counts = count_facts([(view, [Fact("price", F.col("price")), Fact("listing"), Fact("professional", professional), Fact("rating", F.col("review_scores_rating"))])])
    return summarise(counts, ["price"]).agg(
        F.coalesce(of("listing", "n"), F.lit(0)).alias("total_listings"),
        of("price", "median").alias("median_price"),
        of("professional", "mean").alias("professional_share"),
        of("rating", "mean").alias("avg_review"),
    )


def executive_summary(view: DataFrame, recommended: DataFrame | None = None, market: str = "local") -> DataFrame:
    """One row of text: the key figures and the first recommended action."""
    action: Column = F.lit(texts.FALLBACK_ACTION)
    if recommended is not None:
        first = recommended.agg(F.min_by("recommended_action", "recommendation_id").alias("a"))
        action = F.coalesce(first.scalar(), action)
    return market_kpis(view).select(
        F.concat(
            F.lit(f"**Market Overview:** The {market} market currently has **"),
            E.format_number(F.col("total_listings")),
            F.lit("** listings in the selected view. The typical nightly price is **"),
            E.format_currency(F.col("median_price")),
            F.lit("**. Professional operators manage **"),
            E.format_percent(F.col("professional_share")),
            F.lit("** of listings where this field is available.\n\n**Key Recommended Action:** "),
            action,
        ).alias("summary")
    )
