"""Price models.

The feature frame, the split, the imputed values, the scaling, the one-hot levels and what least squares must
leave are checked in SQL; trees by row counts here and by properties in the unit tests.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from nestmetrics.catalog.registry import query
from nestmetrics.plans import dashboard, ml

FRAME = """, priced AS (SELECT * FROM enriched WHERE price > 0),
    kept AS (SELECT * FROM priced WHERE price < (SELECT quantile_cont(price, 0.99) FROM priced))
    """


@query(
    "ml_feature_frame",
    FRAME
    + """SELECT id, room_type, neighbourhood_cleansed, accommodates::DOUBLE AS accommodates, bedrooms, beds, bathrooms,
    review_scores_rating, number_of_reviews::DOUBLE AS number_of_reviews, reviews_per_month,
    availability_365::DOUBLE AS availability_365, host_tenure_years, price_per_bedroom, estimated_occupancy_rate_365d,
    CASE WHEN host_is_superhost THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS host_is_superhost,
    CASE WHEN is_professional_host THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_professional_host,
    round(ln(1 + price), 9) AS label FROM kept""",
)
def _(m):
    return ml.feature_frame(m.enriched).withColumn("label", F.round("label", 9))


@query("ml_split", FRAME + "SELECT count(*) AS n, CAST(ceil(count(*) * 0.2::DOUBLE) AS BIGINT) AS n_test FROM kept")
def _(m):
    marked = ml.split(ml.feature_frame(m.enriched))
    return marked.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"))


SPLIT = (
    FRAME
    + """, hashed AS (SELECT *, ('0x' || substr(md5(id || ':42'), 1, 15))::BIGINT AS h FROM kept),
    split AS (SELECT *, row_number() OVER (ORDER BY h) <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM hashed)
    """
)


@query("ml_split_rows", SPLIT + "SELECT id, is_test FROM split")
def _(m):
    return ml.split(ml.feature_frame(m.enriched)).select("id", "is_test")


@query(
    "ml_impute_numeric",
    SPLIT
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(median({c}::DOUBLE), 9) AS median FROM split WHERE NOT is_test HAVING count({c}) > 0"
        for c in ml.NUMERIC_FEATURES
    ),
)
def _(m):
    """The medians that stand in for missing numbers, from the training rows."""
    train = ml.split(ml.feature_frame(m.enriched)).where(~F.col("is_test"))
    found = ml.medians(train, ml.resolve_features(m.enriched).numeric)
    return found.where("median IS NOT NULL").withColumn("median", F.round("median", 9))


@query(
    "ml_impute_categorical",
    SPLIT
    + """SELECT (SELECT room_type FROM split WHERE NOT is_test AND room_type IS NOT NULL GROUP BY 1
       ORDER BY count(*) DESC, 1 LIMIT 1) AS room_type,
       (SELECT neighbourhood_cleansed FROM split WHERE NOT is_test AND neighbourhood_cleansed IS NOT NULL GROUP BY 1
       ORDER BY count(*) DESC, 1 LIMIT 1) AS neighbourhood_cleansed""",
)
def _(m):
    """The most frequent values among the training rows."""
    train = ml.split(ml.feature_frame(m.enriched)).where(~F.col("is_test"))
    return ml.most_frequent(train, ("room_type", "neighbourhood_cleansed"))


BOOLEANS = ("host_is_superhost", "is_professional_host")


def scaled_sql() -> str:
    """Mean and deviation of each feature over the training rows, missing numbers filled with their median."""
    train = "split WHERE NOT is_test"
    filled = {c: f"coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM {train}))" for c in ml.NUMERIC_FEATURES}
    filled |= {c: f"CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for c in BOOLEANS}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS deviation FROM (SELECT {v} AS v FROM {train}) HAVING count(v) > 0"
        for c, v in filled.items()
    )


@query("ml_scale", SPLIT + scaled_sql())
def _(m):
    """What each scaled feature is centred and divided by, as fitted on the training rows."""
    return ml.scaling(m.prepared).select("feature", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


def levels_sql() -> str:
    """The training rows of each level, missing ones filled with the most frequent."""
    parts = []
    for c in ("room_type", "neighbourhood_cleansed"):
        known = f"split WHERE NOT is_test AND {c} IS NOT NULL"
        mode = f"(SELECT {c} FROM {known} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
        parts.append(f"SELECT '{c}_' || coalesce({c}, {mode}) AS feature, count(*) AS n FROM split WHERE NOT is_test GROUP BY 1")
    return " UNION ALL ".join(parts)


@query("ml_one_hot", SPLIT + levels_sql())
def _(m):
    """Training rows per one-hot level."""
    return ml.one_hot_rows(m.prepared)


@cache
def _fitted(prepared, name: str):
    return ml.MODELS[name]().fit(prepared.train)


def _model(m, name: str):
    return _fitted(m.prepared, name)


def _result(m, name: str):
    return ml.result_row(m.prepared, name, _model(m, name).transform(m.prepared.test))


@query("ml_linear_regression")
def _(m):
    return _result(m, "Linear Regression")


@query(
    "ml_normal_equations",
    f"""{SPLIT}, features AS ({scaled_sql()}), levels AS ({levels_sql()})
    SELECT feature, true AS holds FROM features UNION ALL SELECT feature, true FROM levels
    UNION ALL SELECT '{ml.CONSTANT}', true UNION ALL SELECT '(r2)', true""",
)
def _(m):
    """Whether the linear fit is one of least squares.

    For each feature, the residuals of the training rows are orthogonal to it. (r2): one less the share of
    the variance left is the squared correlation of predictions and labels, which holds for least squares alone.
    """
    model = _model(m, "Linear Regression")
    orthogonal = ml.normal_equations(m.prepared, model).select("feature", (F.abs("cosine") < 1e-6).alias("holds"))
    fitted = model.transform(m.prepared.train)
    squared = fitted.agg(F.pow(F.corr(ml.LABEL, "prediction"), 2)).scalar()
    agreed = ml.evaluate(fitted).select("r2", squared.alias("squared"))
    return orthogonal.unionByName(agreed.select(F.lit("(r2)").alias("feature"), (F.abs(F.col("r2") - F.col("squared")) < 1e-6).alias("holds")))


@query("ml_random_forest")
def _(m):
    return _result(m, "Random Forest")


@query("ml_boosted_trees")
def _(m):
    return _result(m, "Gradient-Boosted Trees")


def _results(m, names=ml.MODELS):
    report = None
    for name in names:
        row = _result(m, name)
        report = row if report is None else report.unionByName(row)
    return report


@query(
    "ml_evaluate",
    """, p AS (SELECT ln(1 + price) AS label, ln(1 + price) * 0.9 + 1 AS prediction FROM listings WHERE price > 0)
    SELECT round(avg(abs((exp(label) - 1) - (exp(prediction) - 1))), 2) AS mae,
           round(sqrt(avg(((exp(label) - 1) - (exp(prediction) - 1)) ** 2)), 2) AS rmse,
           round(1 - sum((label - prediction) ** 2) / sum((label - (SELECT avg(label) FROM p)) ** 2), 6) AS r2 FROM p""",
)
def _(m):
    """The measures, on predictions that both sides can compute."""
    label = F.log1p("price")
    rows = m.listings.where(F.col("price") > 0).select(label.alias("label"), (label * 0.9 + 1).alias("prediction"))
    return ml.evaluate(rows).select(
        F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2")
    )


@query("ml_model_results")
def _(m):
    return _results(m)


@query("ml_feature_importance")
def _(m):
    """The weightiest features of the best model that has weights."""
    weighted = [name for name in ml.MODELS if hasattr(_model(m, name), "featureImportances")]
    best = ml.best_model(_results(m, weighted)).first()["model"]
    return ml.feature_importance(m.prepared, best, _model(m, best))


@query("dash_best_model")
def _(m):
    results = _results(m)
    best = dashboard.best_model(results).withColumn("view", F.lit("best"))
    boosted = dashboard.boosted_rows(results, "boosted").withColumn("view", F.lit("boosted"))
    return best.unionByName(boosted)
