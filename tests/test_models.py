"""Price models on a small table with a known price formula."""

import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from nestmetrics import catalog
from nestmetrics.catalog import models, registry
from nestmetrics.plans import ml


@pytest.fixture(scope="module")
def enriched(spark):
    return spark.range(600).selectExpr(
        "id",
        "CASE WHEN id % 40 = 0 THEN NULL WHEN id % 3 = 0 THEN 'Entire' ELSE 'Private' END AS room_type",
        "concat('area ', id % 4) AS neighbourhood_cleansed",
        "CASE WHEN id % 50 <> 0 THEN double(1 + id % 5) END AS bedrooms",
        "string(2 + id % 6) AS accommodates",
        "double(NULL) AS beds",
        "CASE WHEN id % 3 = 0 THEN 't' ELSE 'f' END AS host_is_superhost",
        "id % 2 = 0 AS is_professional_host",
        "exp(4 + 0.2 * (1 + id % 5) + CASE WHEN id % 3 = 0 THEN 0.5 ELSE 0 END) - 1 AS price",
    ).withColumn("price_per_bedroom", F.col("price") / F.col("bedrooms"))


@pytest.fixture(scope="module")
def prepared(enriched):
    return ml.prepare(enriched, leak_free=True)


def test_feature_frame_filters_and_types(enriched):
    frame = ml.feature_frame(enriched)
    assert dict(frame.dtypes)["accommodates"] == "double" and dict(frame.dtypes)["is_professional_host"] == "double"
    assert "price_per_bedroom" in frame.columns
    assert "price_per_bedroom" not in ml.feature_frame(enriched, leak_free=True).columns
    assert ml.feature_frame(enriched.withColumn("price", -F.col("price"))).count() == 0


def test_split_is_exact_and_independent_of_layout(enriched):
    frame = ml.feature_frame(enriched)
    n = frame.count()
    first = {r.id for r in ml.split(frame).where("is_test").collect()}
    again = {r.id for r in ml.split(frame.repartition(11)).where("is_test").collect()}
    assert first == again and len(first) == math.ceil(n * 0.2)


def test_preparation_imputes_scales_and_codes(prepared):
    assert "beds" not in prepared.scaled  # not one value
    names = ml.feature_names(prepared)
    assert "room_type_Entire" in names and "neighbourhood_cleansed_area 3" in names
    vectors = [r.features.toArray() for r in prepared.train.collect()]
    assert len(vectors) == prepared.train_rows and all(len(v) == len(names) for v in vectors)
    n = len(prepared.scaled)
    for i in range(n):
        column = [v[i] for v in vectors]
        assert sum(column) / len(column) == pytest.approx(0, abs=1e-9)
    # One level per categorical feature is set, also for rows whose room type was missing.
    assert all(v[n:].sum() == 2 for v in vectors)


def test_models_learn_the_formula(prepared):
    models = {"Linear Regression": ml.linear_regression, "Random Forest": lambda: ml.random_forest(5, 6)}
    report, fitted = ml.train_models(prepared, models)
    scores = {r.model: r for r in report.collect()}
    assert scores["Linear Regression"].r2_score > 0.97 and scores["Random Forest"].r2_score > 0.9
    assert scores["Linear Regression"].train_rows + scores["Linear Regression"].test_rows == prepared.rows
    assert ml.best_model(report).first().model == "Linear Regression"
    assert ml.feature_importance(prepared, "Linear Regression", fitted["Linear Regression"]) is None
    weights = ml.feature_importance(prepared, "Random Forest", fitted["Random Forest"], k=3).collect()
    assert len(weights) == 3 and "bedrooms" in {w.feature for w in weights}


@pytest.mark.parametrize("best", ["Random Forest", "Gradient-Boosted Trees"])
def test_importance_is_that_of_the_best_model(spark, prepared, monkeypatch, best):
    """The linear model is better still, but has no importances."""
    small = {"Random Forest": lambda: ml.random_forest(1, 1), "Gradient-Boosted Trees": lambda: ml.boosted_trees(1, 1)}
    small[best] = {"Random Forest": lambda: ml.random_forest(5, 6), "Gradient-Boosted Trees": lambda: ml.boosted_trees(5, 4)}[best]
    monkeypatch.setattr(ml, "MODELS", {"Linear Regression": ml.linear_regression, **small})
    query = catalog.queries()["ml_feature_importance"]
    monkeypatch.setattr(registry, "market", lambda spark, sf_dir: SimpleNamespace(prepared=prepared))
    models._fitted.cache_clear()
    assert {r.model for r in query(spark, "").collect()} == {best}
    models._fitted.cache_clear()


def test_boosting_settings():
    assert ml.boosted_trees.__defaults__ == (200, 6) and ml.random_forest.__defaults__ == (100, 10)


def test_boosting_beats_the_mean(prepared):
    report, _ = ml.train_models(prepared, {"Gradient-Boosted Trees": lambda: ml.boosted_trees(5, 3)})
    assert report.first().r2_score > 0.3


def test_too_few_rows(enriched):
    with pytest.raises(ValueError, match="at least 100"):
        ml.prepare(enriched.limit(50))


def test_measures_leave_out_infinite_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.5), (3.0, 900.0)], "label double, prediction double")
    row = ml.evaluate(df).first()
    error = abs(math.expm1(2.0) - math.expm1(2.5))
    assert row.mae == pytest.approx(error / 2) and row.rmse == pytest.approx(error / math.sqrt(2))
    assert row.r2 == pytest.approx(1 - (0.25 + 897.0**2) / 2)


def test_most_frequent_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "c string")
    assert ml.most_frequent(df, ("c",)).first().c == "a"


def test_normal_equations_tell_least_squares_from_other_fits(prepared):
    exact = ml.normal_equations(prepared, ml.linear_regression().fit(prepared.train)).collect()
    assert {r.feature for r in exact} <= {*ml.feature_names(prepared), ml.CONSTANT} and ml.CONSTANT in {r.feature for r in exact}
    assert all(abs(r.cosine) < 1e-6 for r in exact)
    shrunk = ml.linear_regression().setRegParam(0.5).fit(prepared.train)
    assert max(abs(r.cosine) for r in ml.normal_equations(prepared, shrunk).collect()) > 1e-3


def test_scaling_and_levels_are_those_of_the_training_rows(prepared):
    rows = ml.scaling(prepared).collect()
    assert [r.feature for r in rows] == list(prepared.scaled)
    levels = {r.feature: r.n for r in ml.one_hot_rows(prepared).collect()}
    by_column = {c: sum(n for f, n in levels.items() if f.startswith(f"{c}_")) for c in prepared.features.categorical}
    assert set(by_column.values()) == {prepared.train_rows}
