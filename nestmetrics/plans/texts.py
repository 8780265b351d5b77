"""The wording of the reports."""

# Hypothesis tests, in report order: question, null hypothesis, alternative, interpretation, limitation.
HYPOTHESES = {
    "entire_vs_private": (
        "Do entire homes cost more than private rooms?",
        "There is no price difference between entire homes and private rooms.",
        "Entire homes and private rooms have different typical prices.",
        "Entire homes command a price premium. Pricing strategies should strictly segment by stay type.",
        "Medians and log-transforms reduce outlier impact. Correlation is not causation.",
    ),
    "superhost_scores": (
        "Do superhosts have higher review scores?",
        "Superhosts and non-superhosts have identical review scores.",
        "Superhosts have different review scores than non-superhosts.",
        "Superhosts tend to have higher scores, validating the Superhost badge as a proxy for guest satisfaction.",
        "Circular logic risk: Superhost status strictly requires high ratings.",
    ),
    "pro_vs_casual_price": (
        "Do professional hosts price differently from casual hosts?",
        "Professional and casual hosts price similarly.",
        "Professional hosts apply different pricing strategies.",
        "Professional hosts often use dynamic pricing or operate different property types, causing meaningful price gaps.",
        "Professional threshold defined loosely as ≥3 listings.",
    ),
    "weekend_price": (
        "Are weekend prices different from weekday prices?",
        "Calendar prices are identical on weekends and weekdays.",
        "There is a weekend pricing premium (or discount).",
        "A significant difference implies host recognition of leisure demand. Weekend pricing should be managed as a distinct strategy.",
        "Calendar prices are host intent, not realized bookings.",
    ),
    "neighbourhood_prices": (
        "Do neighbourhood prices differ?",
        "All top 5 neighbourhoods have the same median price.",
        "At least one neighbourhood has a different median price.",
        "Prices vary geographically. A city-wide pricing model is inadequate; hyper-local benchmarks are necessary.",
        "Omnibus test only confirms a difference exists, not which specific pairs differ.",
    ),
}
VERDICT_DIFFERENT = "The difference is unlikely to be random."
VERDICT_SAME = "The difference could easily be random chance."
OMNIBUS_EFFECT = "N/A (Omnibus test)"

# Recommendations, in report order: theme, business meaning, recommended action, confidence, limitation.
RULES = {
    "host_strategy": (
        "Host Strategy",
        "The market is heavily professionalized. Solo hosts may struggle to compete on operational efficiency.",
        "Develop separate operational and pricing playbooks for commercial operators vs. casual hosts.",
        "High",
        "Threshold for 'professional' is strictly defined as ≥3 listings.",
    ),
    "pricing_gap": (
        "Pricing",
        "There is a substantial premium for privacy and full-property access.",
        "Avoid using city-wide average pricing. Segment pricing strategies strictly by stay type.",
        "High",
        "Medians used to reduce outlier impact.",
    ),
    "neighbourhood_opportunity": (
        "Neighbourhood Strategy",
        "Premium, low-supply areas represent unfulfilled demand or high barrier-to-entry luxury markets.",
        "Investigate zoning and real estate availability in these areas for strategic investment.",
        "Medium",
        "Low supply means small sample sizes; pricing medians may be volatile.",
    ),
    "guest_experience": (
        "Demand / Reviews",
        "Location or price is overriding poor guest experience in these listings.",
        "Target these operators for property management services to immediately improve yield via better guest experience.",
        "Medium",
        "Availability is a proxy, not a direct booking metric.",
    ),
    "weekend_premium": (
        "Seasonality",
        "The market demonstrates leisure-driven demand peaks on weekends.",
        "Implement dynamic weekend pricing premiums if not already active.",
        "High",
        "Calendar prices reflect host intent, not necessarily realized bookings.",
    ),
}

# Exploratory findings, in report order: interpretation, limitation.
INSIGHTS = {
    "price_distribution": (
        "The market is dominated by affordable listings, with a long tail of luxury properties.",
        "Top 1% outliers excluded for visualisation. Currency is Thai Baht (THB).",
    ),
    "price_by_room_type": (
        "Entire homes/apartments command premium pricing. Shared/private rooms serve the budget segment.",
        "Median used to reduce impact of extreme values.",
    ),
    "top_neighbourhoods_price": (
        "Premium neighbourhoods likely correlate with tourist/CBD areas.",
        "Only top 15 shown. Small-sample neighbourhoods may have unreliable medians.",
    ),
    "listings_by_neighbourhood": (
        "High-density areas indicate popular tourist or business districts.",
        "Only top 15 shown.",
    ),
    "host_listing_distribution": (
        "Indicates the degree of market professionalisation.",
        "Threshold of ≥3 is arbitrary but commonly used in market research.",
    ),
    "professional_vs_casual": (
        "Professional hosts may operate differently in pricing and service quality.",
        "Professional defined as ≥3 listings per host. Does not account for multi-platform hosts.",
    ),
    "review_score_distribution": (
        "Scores are typically left-skewed (most hosts rated highly), reflecting selection bias in reviews.",
        "Only listings with reviews included. Listings without reviews are excluded.",
    ),
    "availability_by_month": (
        "Lower availability months may indicate higher demand or host blocking.",
        "available=False may mean host-blocked, not necessarily booked.",
    ),
    "weekend_vs_weekday_price": (
        "Weekend premiums suggest leisure-driven demand.",
        "Weekend defined as Friday–Saturday nights. Definition may vary by market.",
    ),
}
# Findings with their figures.
FINDINGS = {
    "price_distribution": "Median price is {price} {currency}. Distribution is right-skewed with {listings} listings.",
    "price_by_room_type": "'{room}' has the highest median price. {rooms} room types observed.",
    "top_neighbourhoods_price": "Top neighbourhood: {area} (median {price} {currency}).",
    "listings_by_neighbourhood": "Most listings in {area} ({listings} listings).",
    "host_listing_distribution": "{share}% of listings belong to professional hosts (≥3 listings).",
    "professional_vs_casual": "Professional hosts: {professional} listings. Casual: {casual} listings.",
    "review_score_distribution": "Median review score: {score}. {listings} listings with reviews.",
    "availability_by_month": "Availability ranges from {lowest}% to {highest}%.",
    "weekend_vs_weekday_price": "Weekend median: {weekend} {currency}, Weekday: {weekday} {currency} ({difference}% difference).",
}
COLUMN_NOT_FOUND = ("Column not found", "N/A", "Missing data")

FALLBACK_ACTION = (
    "Use the pricing, neighbourhood, host, and demand tabs "
    "to identify where pricing can be improved and where operational risk is concentrated."
)

MODEL_TARGET = "price via log1p transform"
MODEL_NOTE = "Baseline model for understanding price drivers; not production pricing advice."
