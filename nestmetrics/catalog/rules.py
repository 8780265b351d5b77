"""Recommendations and the executive summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.catalog.tables import ENTIRE, PRIVATE
from nestmetrics.plans import rules, texts


def fired_sql(order: int, rule: str, finding: str, evidence: str, source: str) -> str:
    """One recommendation row; the wording shared with the jobs is passed in as text."""
    theme, meaning, action, confidence, limitation = (t.replace("'", "''") for t in texts.RULES[rule])
    return f"""SELECT {order} AS _order, '{theme}' AS theme, {finding} AS finding, '{meaning}' AS business_meaning,
        '{action}' AS recommended_action, {evidence} AS evidence_metric, '{confidence}' AS confidence_level,
        '{limitation}' AS limitation FROM ({source})"""


HOST_STRATEGY = fired_sql(
    1,
    "host_strategy",
    "printf('%.1f', s * 100) || '% of listings are managed by professional hosts (≥3 listings).'",
    "'Professional Host Share: ' || printf('%.1f', s * 100) || '%'",
    """SELECT avg(CASE WHEN is_professional_host THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS s FROM enriched
       HAVING s > 0.3""",
)
# Stay types whose medians lie apart on these tables do not exist, so the rule is also checked on
# prices that differ by type.
PRICING_SOURCE = """SELECT * FROM (SELECT
    median({price}) FILTER (WHERE room_type = '1-URGENT') AS e,
    median({price}) FILTER (WHERE room_type = '5-LOW') AS p FROM enriched) WHERE e > 0 AND p > 0 AND e > p * 1.5"""


def pricing_sql(price: str) -> str:
    return fired_sql(
        2,
        "pricing_gap",
        "'Entire homes typically price at ฿' || format('{:,.0f}', e) || ', while private rooms are ฿' || "
        "format('{:,.0f}', p) || '.'",
        "'Entire vs Private gap: +' || printf('%.0f', (e - p) / p * 100) || '%'",
        PRICING_SOURCE.replace("{price}", price),
    )


AREAS = "SELECT neighbourhood_cleansed AS a, count(id) AS n, median(price) AS p FROM enriched GROUP BY 1"
OPPORTUNITY = fired_sql(
    3,
    "neighbourhood_opportunity",
    "'''' || a || ''' has low supply but commands top-tier pricing.'",
    "'Opportunity Neighbourhoods: ' || found || ' found'",
    f"""SELECT a, count(*) OVER () AS found FROM ({AREAS}) x
        WHERE p >= (SELECT quantile_cont(p, 0.8) FROM ({AREAS})) AND n <= (SELECT median(n) FROM ({AREAS}))
        ORDER BY p DESC, a LIMIT 1""",
)
EXPERIENCE = fired_sql(
    4,
    "guest_experience",
    "'Found ' || format('{:,}', n) || ' listings with below-average reviews but high implied occupancy.'",
    "'Sub-par listings: ' || format('{:,}', n)",
    """SELECT count(*) AS n FROM enriched WHERE availability_365 < 180
       AND review_scores_rating < (SELECT median(review_scores_rating) FROM enriched) HAVING n > 100""",
)


def weekend_sql(price: str) -> str:
    return fired_sql(
        5,
        "weekend_premium",
        "'Weekend prices (฿' || format('{:,.0f}', we) || ') are higher than weekday prices (฿' || "
        "format('{:,.0f}', wd) || ').'",
        "'Weekend Premium: +' || printf('%.1f', (we - wd) / wd * 100) || '%'",
        f"""SELECT * FROM (SELECT median({price}) FILTER (WHERE coalesce(isodow(date) IN (5, 6), false)) AS we,
            median({price}) FILTER (WHERE NOT coalesce(isodow(date) IN (5, 6), false)) AS wd FROM calendar)
            WHERE we > wd""",
    )


RECOMMENDATIONS = "\nUNION ALL ".join(
    [HOST_STRATEGY, pricing_sql("price"), f"SELECT * FROM ({OPPORTUNITY})", EXPERIENCE, weekend_sql("price")]
)


@query("rule_host_strategy", HOST_STRATEGY)
def _(m):
    return rules.rule_host_strategy(m.enriched)


GAP_PRICE = "CASE WHEN room_type = '1-URGENT' THEN price * 2 ELSE price END"


@query("rule_pricing_gap", pricing_sql(GAP_PRICE))
def _(m):
    """Prices of one stay type are doubled, so that the rule fires."""
    price = F.when(F.col("room_type") == ENTIRE, F.col("price") * 2).otherwise(F.col("price"))
    return rules.rule_pricing_gap(m.enriched.withColumn("price", price), ENTIRE, PRIVATE)


@query("rule_pricing_gap_silent", pricing_sql("price"))
def _(m):
    return rules.rule_pricing_gap(m.enriched, ENTIRE, PRIVATE)


@query("rule_neighbourhood_opportunity", OPPORTUNITY)
def _(m):
    return rules.rule_neighbourhood_opportunity(m.enriched)


@query("rule_guest_experience", EXPERIENCE)
def _(m):
    return rules.rule_guest_experience(m.enriched)


WEEKEND_PRICE = "CASE WHEN isodow(date) IN (5, 6) THEN price + 5000 ELSE price END"


@query("rule_weekend_premium", weekend_sql(WEEKEND_PRICE))
def _(m):
    """Weekend prices are raised, so that the rule fires."""
    raised = F.when(F.weekday("date").isin(4, 5), F.col("price") + 5000).otherwise(F.col("price"))
    return rules.rule_weekend_premium(m.calendar.withColumn("price", raised))


@query(
    "recommendations",
    f"SELECT CAST(row_number() OVER (ORDER BY _order) AS INTEGER) AS recommendation_id, * EXCLUDE (_order) FROM ({RECOMMENDATIONS})",
)
def _(m):
    return rules.recommendations(m.enriched, m.calendar, ENTIRE, PRIVATE)


@query(
    "executive_summary",
    f"""SELECT '**Market Overview:** The test market currently has **' || format('{{:,}}', count(*)) ||
        '** listings in the selected view. The typical nightly price is **฿' || format('{{:,.0f}}', median(price)) ||
        '**. Professional operators manage **' ||
        printf('%.1f', avg(CASE WHEN is_professional_host THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100) ||
        '%** of listings where this field is available.' || chr(10) || chr(10) || '**Key Recommended Action:** ' ||
        (SELECT recommended_action FROM ({RECOMMENDATIONS}) ORDER BY _order LIMIT 1) AS summary FROM enriched""",
)
def _(m):
    found = rules.recommendations(m.enriched, m.calendar, ENTIRE, PRIVATE)
    return rules.executive_summary(m.enriched, found, market="test")
