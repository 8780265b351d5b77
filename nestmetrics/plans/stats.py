"""Hypothesis tests as one-row frames. Nothing is sampled and nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.functions.tails import chi_square_upper, normal_two_sided, with_student_t_tail
from nestmetrics.operators.ordering import mid_ranks, number_rows, top_k
from nestmetrics.plans import texts
from nestmetrics.plans.eda import area_column

MIN_GROUP = 10
MIN_NORMAL_GROUP = 30
ALPHA = 0.05

# The tests in report order, and what the report says behind the name of a two-sample test.
ORDER = list(texts.HYPOTHESES)
SUFFIXES = {
    "entire_vs_private": " (log-transformed)",
    "superhost_scores": "",
    "pro_vs_casual_price": " (log-transformed)",
    "weekend_price": " (log-transformed)",
}

# Upper bounds of |d| and their labels.
EFFECT_LABELS = ((0.2, "negligible"), (0.5, "small"), (0.8, "medium"))


def effect_label(d: Column) -> Column:
    size = F.abs(d)
    label = F.when(size < EFFECT_LABELS[0][0], EFFECT_LABELS[0][1])
    for bound, text in EFFECT_LABELS[1:]:
        label = label.when(size < bound, text)
    return label.otherwise("large")


def mean_var(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance")
    )


# The next three are SQL text over columns or expressions of type double.


def cohens_d(n1: str, mean1: str, var1: str, n2: str, mean2: str, var2: str) -> str:
    pooled = f"sqrt(try_divide(({n1} - 1) * {var1} + ({n2} - 1) * {var2}, {n1} + {n2} - 2))"
    return f"CASE WHEN {pooled} = 0 THEN 0D ELSE try_divide({mean1} - {mean2}, {pooled}) END"


def rank_biserial(u: str, n1: str, n2: str) -> str:
    """Negative when the first group is larger."""
    return f"(1D - try_divide({u} * 2, double({n1}) * double({n2})))"


def jarque_bera_p(n: str, skewness: str, excess: str) -> str:
    """Normality from the shape of all values: exp(-JB / 2) is the chi-square tail for two degrees."""
    return f"exp(-{n} / 12 * ({skewness} * {skewness} + {excess} * {excess} / 4))"


def observations(df: DataFrame, samples: Sequence[tuple[int, Column, Column]]) -> DataFrame:
    """(test, g, v): the observations of several tests from one pass over the rows.

    A sample is the test's number, the group of a row (1, 2, ...; null: none) and its value (null: none).
    """
    drawn = F.array(
        *[
            F.struct(F.lit(test).alias("test"), group.cast("int").alias("g"), value.cast("double").alias("v"))
            for test, group, value in samples
        ]
    )
    return df.select(F.inline(drawn)).where(F.col("g").isNotNull() & F.col("v").isNotNull())


def one_of_two(first: Column, second: Column) -> Column:
    return F.when(first, 1).when(second, 2)


def sample_figures(observed: DataFrame, k: int = 2) -> DataFrame:
    """One row for each test: size, moments and rank sum of each of k groups, and the tie correction.

    Observations are counted per (test, value) once. Ranks are sums over those counts; so are the
    moments, taken about means that come with the bucket totals.
    """
    numbers = range(1, k + 1)
    ranks = mid_ranks(
        observed,
        "v",
        {f"c{i}": F.col("g") == i for i in numbers},
        ["test"],
        {f"_{name}{i}": value for i in numbers for name, value in (("n", F.col(f"c{i}")), ("s", F.col(f"c{i}") * F.col("v")))},
        disjoint=True,
    )
    ties = F.col("ties").cast("double")
    off = {i: F.col("v") - F.try_divide(F.col(f"_s{i}"), F.col(f"_n{i}").cast("double")) for i in numbers}
    sums = ranks.groupBy("test").agg(
        F.sum(ties).alias("total"),
        F.sum(ties * ties * ties - ties).alias("tie_sum"),
        *[F.max(f"_n{i}").alias(f"n_{i}") for i in numbers],
        *[F.max(F.try_divide(F.col(f"_s{i}"), F.col(f"_n{i}").cast("double"))).alias(f"mean_{i}") for i in numbers],
        *[F.sum(F.col(f"c{i}") * F.col("mid_rank")).alias(f"rank_sum_{i}") for i in numbers],
        *[F.sum(F.col(f"c{i}") * F.pow(off[i], F.lit(p))).alias(f"_m{p}_{i}") for i in numbers for p in (2, 3, 4)],
    )
    shape = [
        column
        for i in numbers
        for column in (
            f"try_divide(_m2_{i}, double(n_{i} - 1)) AS var_{i}",
            f"try_divide(sqrt(double(n_{i})) * _m3_{i}, _m2_{i} * sqrt(_m2_{i})) AS skew_{i}",
            f"try_divide(n_{i} * _m4_{i}, _m2_{i} * _m2_{i}) - 3 AS excess_{i}",
        )
    ]
    return sums.selectExpr("*", *shape).drop(*[f"_m{p}_{i}" for i in numbers for p in (2, 3, 4)])


def two_sample(df: DataFrame, value: str, first: Column, second: Column) -> DataFrame:
    """One row with the moments of both groups and everything both tests need; no row without values."""
    observed = observations(df, [(1, one_of_two(first, second), F.col(value))])
    return with_tests(sample_figures(observed)).drop("test")


def with_tests(figures: DataFrame) -> DataFrame:
    """Both tests, both effect sizes and the choice between them, for the first two groups of each row."""
    m = figures.selectExpr("*", "rank_sum_1 - double(n_1) * (n_1 + 1) / 2 AS u")
    normal = " AND ".join(
        f"{jarque_bera_p(f'n{i}', f'skew_{i}', f'excess_{i}')} > {ALPHA}D AND n{i} >= {MIN_NORMAL_GROUP}"
        for i in (1, 2)
    )
    m = m.selectExpr("*", "double(n_1) AS n1", "double(n_2) AS n2").selectExpr(
        "*",
        "try_divide(var_1, n1) AS s1",
        "try_divide(var_2, n2) AS s2",
        "n1 * n2 / 12 * (n1 + n2 + 1 - try_divide(tie_sum, (n1 + n2) * (n1 + n2 - 1))) AS u_variance",
    )
    m = m.selectExpr(
        "*",
        "try_divide(mean_1 - mean_2, sqrt(s1 + s2)) AS t",
        "try_divide((s1 + s2) * (s1 + s2), try_divide(s1 * s1, n1 - 1) + try_divide(s2 * s2, n2 - 1)) AS t_df",
        "try_divide(greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5D, sqrt(u_variance)) AS z",
        f"{cohens_d('n1', 'mean_1', 'var_1', 'n2', 'mean_2', 'var_2')} AS d",
        f"{rank_biserial('u', 'n1', 'n2')} AS r",
        f"coalesce({normal}, false) AS is_normal",
    )
    # z may dip below 0 through the continuity correction: the two-sided tail is then 1.
    u_p = f"CASE WHEN z <= 0 THEN 1D ELSE least(1D, {normal_two_sided('z')}) END AS u_p"
    return with_student_t_tail(m.selectExpr("*", u_p), "t", "t_df", "t_p").drop("n1", "n2", "s1", "s2")


def _report_row(key: str, test: Column, n1: Column, n2: Column, stat: Column, p: Column, effect: Column) -> dict[str, Column]:
    question, null, alternative, interpretation, limitation = texts.HYPOTHESES[key]
    return {
        "_order": F.lit(ORDER.index(key) + 1),
        "business_question": F.lit(question),
        "null_hypothesis": F.lit(null),
        "alternative_hypothesis": F.lit(alternative),
        "test_used": test,
        "sample_size_group_1": n1.cast("long"),
        "sample_size_group_2": n2.cast("long"),
        "statistic": E.round_half_even(stat, 4),
        "p_value": E.round_half_even(p, 6),
        "effect_size": effect,
        "result_plain_english": F.when(p < ALPHA, texts.VERDICT_DIFFERENT).otherwise(texts.VERDICT_SAME),
        "business_interpretation": F.lit(interpretation),
        "limitation": F.lit(limitation),
    }


def _named(row: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in row.items()]


def _two_sample_columns(key: str) -> dict[str, Column]:
    """Welch's test where both groups look normal, Mann-Whitney otherwise."""
    normal = F.col("is_normal")
    d_text = F.concat(
        F.lit("Cohen's d = "), E.number_text(F.col("d"), "0.000"), F.lit(" ("), effect_label(F.col("d")), F.lit(")")
    )
    r_text = F.concat(F.lit("Rank-biserial r = "), E.number_text(F.col("r"), "0.000"))
    return _report_row(
        key,
        F.concat(F.when(normal, "Welch's t-test").otherwise("Mann-Whitney U"), F.lit(SUFFIXES[key])),
        F.col("n_1"),
        F.col("n_2"),
        F.when(normal, F.col("t")).otherwise(F.col("u")),
        F.when(normal, F.col("t_p")).otherwise(F.col("u_p")),
        F.when(normal, d_text).otherwise(r_text),
    )


def _enough_for_two() -> Column:
    return (F.col("n_1") >= MIN_GROUP) & (F.col("n_2") >= MIN_GROUP)


def _two_sample_row(sample: DataFrame, key: str) -> DataFrame:
    """The report's row; none if a group is too small."""
    return sample.where(_enough_for_two()).select(*_named(_two_sample_columns(key)))


def _log_prices(df: DataFrame) -> DataFrame:
    return df.where(F.col("price") > 0).withColumn("log_price", E.log_price(F.col("price")))


def entire_vs_private_sample(enriched: DataFrame, entire: str = "Entire", private: str = "Private") -> DataFrame:
    room = F.col("room_type")
    return two_sample(_log_prices(enriched), "log_price", E.contains_ci(room, entire), E.contains_ci(room, private))


def superhost_sample(enriched: DataFrame) -> DataFrame:
    flag = F.col("host_is_superhost")
    return two_sample(enriched, "review_scores_rating", flag, ~flag)


def pro_vs_casual_sample(enriched: DataFrame) -> DataFrame:
    flag = F.col("is_professional_host")
    return two_sample(_log_prices(enriched), "log_price", flag, ~flag)


def weekend_sample(calendar: DataFrame) -> DataFrame:
    """All priced days."""
    days = _log_prices(calendar).withColumn("weekend", E.weekend_flag(F.col("date"), E.WEEKEND_FRI_SAT))
    return two_sample(days, "log_price", F.col("weekend"), ~F.col("weekend"))


def test_entire_vs_private(enriched: DataFrame, entire: str = "Entire", private: str = "Private") -> DataFrame:
    sample = entire_vs_private_sample(enriched, entire, private)
    return _two_sample_row(sample, "entire_vs_private")


def test_superhost_scores(enriched: DataFrame) -> DataFrame:
    return _two_sample_row(superhost_sample(enriched), "superhost_scores")


def test_pro_vs_casual_price(enriched: DataFrame) -> DataFrame:
    return _two_sample_row(pro_vs_casual_sample(enriched), "pro_vs_casual_price")


def test_weekend_price(calendar: DataFrame) -> DataFrame:
    return _two_sample_row(weekend_sample(calendar), "weekend_price")


def kruskal_wallis(df: DataFrame, value: str, group: str, k: int) -> DataFrame:
    """One row: H with tie correction, its p, group count, the sizes. Groups are numbered 1..k."""
    figures = sample_figures(observations(df, [(1, F.col(group), F.col(value))]), k)
    return with_kruskal_wallis(figures, k).select("h", "groups", "n_first", "n_rest", "n_smallest", "p")


def with_kruskal_wallis(figures: DataFrame, k: int) -> DataFrame:
    """Each row of figures with H over its k groups, p, group count and sizes."""
    total = F.col("total")
    squares = sum(
        (
            F.coalesce(F.try_divide(F.col(f"rank_sum_{i}") * F.col(f"rank_sum_{i}"), F.col(f"n_{i}").cast("double")), F.lit(0.0))
            for i in range(1, k + 1)
        ),
        F.lit(0.0),
    )
    raw = F.try_divide(F.lit(12.0), total * (total + 1)) * squares - (total + 1) * 3
    correction = F.lit(1.0) - F.try_divide(F.col("tie_sum"), total * total * total - total)
    present = sum((F.when(F.col(f"n_{i}") > 0, 1).otherwise(0) for i in range(1, k + 1)), F.lit(0))
    sizes = [F.col(f"n_{i}") for i in range(1, k + 1)]
    smallest = F.array_min(F.filter(F.array(*sizes), lambda n: n > 0))
    result = figures.select(
        "*",
        F.try_divide(raw, correction).alias("h"),
        present.alias("groups"),
        F.col("n_1").alias("n_first"),
        (total - F.col("n_1")).cast("long").alias("n_rest"),
        smallest.alias("n_smallest"),
    )
    return result.selectExpr("*", f"{chi_square_upper('h', '(groups - 1)')} AS p")


def leading_areas(enriched: DataFrame, k: int) -> DataFrame:
    """The k areas with most listings, numbered from 1 (_group)."""
    area = area_column(enriched)
    counts = enriched.where(F.col(area).isNotNull()).groupBy(area).agg(F.count(F.lit(1)).alias("_n"))
    leaders = top_k(counts, [F.desc("_n"), F.asc(area)], k).withColumn("_o", F.struct(-F.col("_n"), F.col(area)))
    return number_rows(leaders, "_o", "_group").select(area, "_group")


def neighbourhood_sample(enriched: DataFrame, k: int = 5) -> DataFrame:
    """Kruskal-Wallis over the prices of the k areas with most listings."""
    leaders = leading_areas(enriched, k)
    # k rows.
    rows = enriched.where(F.col("price") > 0).join(F.broadcast(leaders), area_column(enriched))
    expected = leaders.agg(F.count(F.lit(1)).alias("n")).scalar()
    return kruskal_wallis(rows, "price", "_group", k).withColumn("expected", expected)


def _enough_for_all() -> Column:
    return (F.col("n_smallest") >= MIN_GROUP) & (F.col("groups") == F.col("expected")) & (F.col("groups") >= 2)


def _omnibus_columns() -> dict[str, Column]:
    return _report_row(
        "neighbourhood_prices",
        F.lit("Kruskal-Wallis H-test"),
        F.col("n_first"),
        F.col("n_rest"),
        F.col("h"),
        F.col("p"),
        F.lit(texts.OMNIBUS_EFFECT),
    )


def test_neighbourhood_prices(enriched: DataFrame, k: int = 5) -> DataFrame:
    return neighbourhood_sample(enriched, k).where(_enough_for_all()).select(*_named(_omnibus_columns()))


def statistical_report(
    enriched: DataFrame, calendar: DataFrame | None = None, entire: str = "Entire", private: str = "Private", k: int = 5
) -> DataFrame:
    """The tests whose columns exist and whose groups are large enough, numbered from 1.

    The observations of all tests are counted together: listings and calendar are read once each, and
    listings once more for the k leading areas.
    """
    have = set(enriched.columns)
    price = F.col("price")
    log_price = F.when(price > 0, E.log_price(price)) if "price" in have else None
    samples = []

    def add(key: str, group: Column, value: Column) -> None:
        samples.append((ORDER.index(key) + 1, group, value))

    if {"room_type", "price"} <= have:
        room = F.col("room_type")
        add("entire_vs_private", one_of_two(E.contains_ci(room, entire), E.contains_ci(room, private)), log_price)
    if {"host_is_superhost", "review_scores_rating"} <= have:
        flag = F.col("host_is_superhost")
        add("superhost_scores", one_of_two(flag, ~flag), F.col("review_scores_rating"))
    if {"is_professional_host", "price"} <= have:
        flag = F.col("is_professional_host")
        add("pro_vs_casual_price", one_of_two(flag, ~flag), log_price)
    leaders = None
    listings = enriched
    if "price" in have and have & {"neighbourhood_cleansed", "neighbourhood"}:
        area = area_column(enriched)
        leaders = leading_areas(enriched, k)
        listings = enriched.join(F.broadcast(leaders), area, "left")  # k rows
        add("neighbourhood_prices", F.col("_group"), F.when(price > 0, price))
    # Without any test the report has its columns and no rows.
    observed = observations(listings, samples or [(0, F.lit(None), F.lit(None))])
    if calendar is not None and {"date", "price"} <= set(calendar.columns):
        weekend = E.weekend_flag(F.col("date"), E.WEEKEND_FRI_SAT)
        days = [(ORDER.index("weekend_price") + 1, one_of_two(weekend, ~weekend), F.when(price > 0, E.log_price(price)))]
        observed = observed.unionByName(observations(calendar, days))

    figures = sample_figures(observed, k)
    both = with_tests(with_kruskal_wallis(figures, k)).withColumn("expected", _number_of(leaders))
    cases = [(_is_test(key) & _enough_for_two(), _two_sample_columns(key)) for key in SUFFIXES]
    cases.append((_is_test("neighbourhood_prices") & _enough_for_all(), _omnibus_columns()))
    # Only sizes decide which rows stay, so that no tail probability is worked out twice.
    kept = both.where(reduce(lambda a, b: a | b, [case for case, _ in cases]))
    report = kept.select(*[F.coalesce(*[F.when(case, row[name]) for case, row in cases]).alias(name) for name in cases[0][1]])
    return number_rows(report, "_order", "hypothesis_id")


def _is_test(key: str) -> Column:
    return F.col("test") == ORDER.index(key) + 1


def _number_of(leaders: DataFrame | None) -> Column:
    return leaders.agg(F.count(F.lit(1)).alias("n")).scalar() if leaders is not None else F.lit(0)
