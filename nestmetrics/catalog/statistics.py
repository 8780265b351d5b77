"""Hypothesis tests.

The checking SQL ranks and sums on its own, and takes tail probabilities by quadrature or, for an even number
of degrees of freedom, in closed form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.plans import stats, texts


def two_sample_sql(source: str, value: str, first: str, second: str) -> str:
    """Common tables up to ``test``: one row with the moments, U, t and their p-value inputs."""
    return f""", s AS (SELECT ({value})::DOUBLE AS v, CASE WHEN {first} THEN 1 WHEN {second} THEN 2 END AS g
                    FROM {source}),
    obs AS (SELECT v, g FROM s WHERE v IS NOT NULL AND g IS NOT NULL),
    tied AS (SELECT v, count(*) AS t, count(*) FILTER (WHERE g = 1) AS c1 FROM obs GROUP BY v),
    ranked AS (SELECT c1, t, sum(t) OVER (ORDER BY v) - t + (t + 1) / 2.0::DOUBLE AS r FROM tied),
    ranks AS (SELECT sum(c1 * r) AS r1, sum(t::DOUBLE * t * t - t) AS ties FROM ranked),
    moments AS (SELECT count(*) FILTER (WHERE g = 1) AS n1, count(*) FILTER (WHERE g = 2) AS n2,
        avg(v) FILTER (WHERE g = 1) AS m1, avg(v) FILTER (WHERE g = 2) AS m2,
        var_samp(v) FILTER (WHERE g = 1) AS s1, var_samp(v) FILTER (WHERE g = 2) AS s2 FROM obs),
    u AS (SELECT *, r1 - n1 * (n1 + 1) / 2.0::DOUBLE AS u FROM moments, ranks),
    test AS (SELECT *, 1 - 2 * u / (n1::DOUBLE * n2) AS r,
        (greatest(u, n1::DOUBLE * n2 - u) - n1::DOUBLE * n2 / 2 - 0.5) /
            sqrt(n1::DOUBLE * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z,
        (m1 - m2) / sqrt(s1 / n1 + s2 / n2) AS t,
        (s1 / n1 + s2 / n2) ** 2 / ((s1 / n1) ** 2 / (n1 - 1) + (s2 / n2) ** 2 / (n2 - 1)) AS t_df,
        (m1 - m2) / sqrt(((n1 - 1) * s1 + (n2 - 1) * s2) / (n1 + n2 - 2)) AS d FROM u)
    """


ENTIRE_PRIVATE = two_sample_sql(
    "enriched WHERE price > 0", "ln(1 + price)", "contains(lower(room_type), 'urgent')", "contains(lower(room_type), 'low')"
)
SUPERHOST = two_sample_sql("enriched", "review_scores_rating", "host_is_superhost", "NOT host_is_superhost")
PRO_CASUAL = two_sample_sql("enriched WHERE price > 0", "ln(1 + price)", "is_professional_host", "NOT is_professional_host")
WEEKEND = two_sample_sql(
    "calendar WHERE price > 0",
    "ln(1 + price)",
    "coalesce(isodow(date) IN (5, 6), false)",
    "NOT coalesce(isodow(date) IN (5, 6), false)",
)
LABEL = """CASE WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small'
    WHEN abs(d) < 0.8 THEN 'medium' ELSE 'large' END"""


def simpson(f: Callable[[str], str], low: str, high: str, panels: int) -> str:
    """The integral of a function, given as SQL text for the text of its argument, by Simpson's rule, as a scalar subquery."""
    x = f"(({low}) + (({high}) - ({low})) * i / {panels}.0::DOUBLE)"
    weight = f"CASE WHEN i IN (0, {panels}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"((({high}) - ({low})) / {3 * panels} * (SELECT sum({weight} * {f(x)}) FROM range(0, {panels + 1}) g(i)))"


# Tail probabilities by quadrature; the jobs take them from series and continued fractions.
BEYOND_Z = simpson(lambda x: f"exp(-{x} * {x} / 2)", "z", "z + 12", 4000)
TAIL = f"CASE WHEN z <= 0 THEN 1.0 ELSE least(1.0, 2 / sqrt(2 * pi()) * {BEYOND_Z}) END"
# With t = sqrt(df) * tan(angle), the density is a power of the cosine.
ANGLE = "atan(abs(t) / sqrt(t_df))"


def _power(x: str) -> str:
    return f"cos({x}) ** (t_df - 1)"


T_TAIL = (
    f"{simpson(_power, ANGLE, f'least(pi() / 2, {ANGLE} + 14 / sqrt(t_df))', 8000)} / "
    f"{simpson(_power, '0', 'least(pi() / 2, 14 / sqrt(t_df))', 8000)}"
)


@query(
    "normality_gate",
    """SELECT g AS is_superhost, n, round(exp(-n / 6 * (s * s + k * k / 4) / 2), 9) AS p FROM (
         SELECT g, n::DOUBLE AS n, m3 / m2 ** 1.5 AS s, m4 / (m2 * m2) - 3 AS k FROM (
           SELECT g, count(*) AS n, avg((v - m) ** 2) AS m2, avg((v - m) ** 3) AS m3, avg((v - m) ** 4) AS m4 FROM (
             SELECT host_is_superhost AS g, review_scores_rating AS v,
                    avg(review_scores_rating) OVER (PARTITION BY host_is_superhost) AS m
             FROM listings WHERE host_is_superhost IS NOT NULL AND review_scores_rating IS NOT NULL)
           GROUP BY g))""",
)
def _(m):
    rated = m.listings.where(F.col("host_is_superhost").isNotNull() & F.col("review_scores_rating").isNotNull())
    shape = rated.groupBy(F.col("host_is_superhost").alias("is_superhost")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.skewness("review_scores_rating").alias("s"),
        F.kurtosis("review_scores_rating").alias("k"),
    )
    return shape.selectExpr("is_superhost", "n", f"round({stats.jarque_bera_p('n', 's', 'k')}, 9) AS p")


@query(
    "welch_t_test",
    f"{SUPERHOST} SELECT n1, n2, round(t, 6) AS t, round(t_df, 3) AS t_df, round({T_TAIL}, 9) AS p FROM test",
)
def _(m):
    return stats.superhost_sample(m.enriched).select(
        F.col("n_1").alias("n1"),
        F.col("n_2").alias("n2"),
        F.round("t", 6).alias("t"),
        F.round("t_df", 3).alias("t_df"),
        F.round("t_p", 9).alias("p"),
    )


@query(
    "mann_whitney_u",
    f"{WEEKEND} SELECT n1, n2, u, round(z, 6) AS z, round({TAIL}, 9) AS p FROM test",
)
def _(m):
    return stats.weekend_sample(m.calendar).select(
        F.col("n_1").alias("n1"),
        F.col("n_2").alias("n2"),
        "u",
        F.round("z", 6).alias("z"),
        F.round("u_p", 9).alias("p"),
    )


@query("rank_biserial", f"{ENTIRE_PRIVATE} SELECT round(r, 9) AS r FROM test")
def _(m):
    return stats.entire_vs_private_sample(m.enriched, "URGENT", "LOW").select(F.round("r", 9).alias("r"))


@query("cohens_d", f"{PRO_CASUAL} SELECT round(d, 9) AS d FROM test")
def _(m):
    return stats.pro_vs_casual_sample(m.enriched).select(F.round("d", 9).alias("d"))


@query(
    "effect_label",
    f"SELECT id, {LABEL} AS label FROM (SELECT id, review_scores_rating - 4 AS d FROM listings WHERE id % 3 <> 0)",
)
def _(m):
    rated = m.listings.where(F.col("review_scores_rating").isNotNull())
    return rated.select("id", stats.effect_label(F.col("review_scores_rating") - 4).alias("label"))


TOP_AREAS = """, top AS (SELECT neighbourhood_cleansed AS a, row_number() OVER (ORDER BY count(*) DESC, neighbourhood_cleansed)
        AS g FROM enriched WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1 ORDER BY g LIMIT 5),
    obs AS (SELECT price AS v, g FROM enriched JOIN top ON a = neighbourhood_cleansed WHERE price > 0),
    tied AS (SELECT v, count(*) AS t FROM obs GROUP BY v),
    ranked AS (SELECT v, t, sum(t) OVER (ORDER BY v) - t + (t + 1) / 2.0::DOUBLE AS r FROM tied),
    per_area AS (SELECT g, count(*) AS n, sum(r) AS s FROM obs JOIN ranked USING (v) GROUP BY g),
    pooled AS (SELECT sum(n)::DOUBLE AS total, sum(s * s / n) AS squares, count(*) AS k,
               max(n) FILTER (WHERE g = 1) AS n_first FROM per_area),
    kw AS (SELECT k, n_first, total, (12 / (total * (total + 1)) * squares - 3 * (total + 1)) /
        (1 - (SELECT sum(t::DOUBLE * t * t - t) FROM tied) / (total ** 3 - total)) AS h FROM pooled)
    """


@query(
    "kruskal_wallis",
    f"""{TOP_AREAS} SELECT round(h, 6) AS h, round(exp(-h / 2) * (1 + h / 2), 6) AS p, CAST(k AS INTEGER) AS groups, n_first,
        CAST(total - n_first AS BIGINT) AS n_rest FROM kw""",
)
def _(m):
    return stats.neighbourhood_sample(m.enriched).select(
        F.round("h", 6).alias("h"), F.round("p", 6).alias("p"), "groups", "n_first", "n_rest"
    )


def report_sql(order: int, key: str, test: str, n1: str, n2: str, stat: str, p: str, effect: str, source: str) -> str:
    question, null, alternative, interpretation, limitation = (t.replace("'", "''") for t in texts.HYPOTHESES[key])
    return f"""SELECT {order} AS _order, '{question}' AS business_question, '{null}' AS null_hypothesis,
        '{alternative}' AS alternative_hypothesis, '{test}' AS test_used, {n1} AS sample_size_group_1,
        {n2} AS sample_size_group_2, round({stat}, 4) AS statistic, round({p}, 6) AS p_value, {effect} AS effect_size,
        CASE WHEN {p} < 0.05 THEN '{texts.VERDICT_DIFFERENT}' ELSE '{texts.VERDICT_SAME}' END AS result_plain_english,
        '{interpretation}' AS business_interpretation, '{limitation}' AS limitation FROM {source}"""


def mann_whitney_sql(order: int, key: str, suffix: str) -> str:
    effect = "'Rank-biserial r = ' || printf('%.3f', r)"
    return report_sql(order, key, f"Mann-Whitney U{suffix}", "n1", "n2", "u", TAIL, effect, "test")


KRUSKAL = report_sql(
    5,
    "neighbourhood_prices",
    "Kruskal-Wallis H-test",
    "n_first",
    "CAST(total - n_first AS BIGINT)",
    "h",
    "exp(-h / 2) * (1 + h / 2)",
    f"'{texts.OMNIBUS_EFFECT}'",
    "kw",
)
LOGGED = " (log-transformed)"
TESTS = {
    "test_entire_vs_private": ENTIRE_PRIVATE + mann_whitney_sql(1, "entire_vs_private", LOGGED),
    "test_superhost_scores": SUPERHOST + mann_whitney_sql(2, "superhost_scores", ""),
    "test_pro_vs_casual_price": PRO_CASUAL + mann_whitney_sql(3, "pro_vs_casual_price", LOGGED),
    "test_weekend_price": WEEKEND + mann_whitney_sql(4, "weekend_price", LOGGED),
    "test_neighbourhood_prices": TOP_AREAS + KRUSKAL,
}


@query("test_entire_vs_private", TESTS["test_entire_vs_private"])
def _(m):
    return stats.test_entire_vs_private(m.enriched, "URGENT", "LOW")


@query("test_superhost_scores", TESTS["test_superhost_scores"])
def _(m):
    return stats.test_superhost_scores(m.enriched)


@query("test_pro_vs_casual_price", TESTS["test_pro_vs_casual_price"])
def _(m):
    return stats.test_pro_vs_casual_price(m.enriched)


@query("test_weekend_price", TESTS["test_weekend_price"])
def _(m):
    return stats.test_weekend_price(m.calendar)


@query("test_neighbourhood_prices", TESTS["test_neighbourhood_prices"])
def _(m):
    return stats.test_neighbourhood_prices(m.enriched)


def all_tests_sql() -> str:
    """The tests one below the other, each with its own common tables."""
    rows = "\nUNION ALL ".join(f"SELECT * FROM (WITH {sql.lstrip(', ')})" for sql in TESTS.values())
    return f"SELECT CAST(row_number() OVER (ORDER BY _order) AS INTEGER) AS hypothesis_id, * EXCLUDE (_order) FROM ({rows})"


@query("statistical_report", all_tests_sql())
def _(m):
    return stats.statistical_report(m.enriched, m.calendar, "URGENT", "LOW")
