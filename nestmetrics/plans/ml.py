"""Price models on the enriched listings: Spark's own least squares, and trees by histograms."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestmetrics.functions import exprs as E
from nestmetrics.operators.ordering import argmax_row, top_k
from nestmetrics.operators.quantiles import exact_quantiles, global_quantile, rank_value
from nestmetrics.operators.trees import Boosting, Forest
from nestmetrics.plans import texts
from nestmetrics.plans.dashboard import FIELD_NAMES

# Numeric features, where present.
NUMERIC_FEATURES = (
    "accommodates",
    "bedrooms",
    "beds",
    "bathrooms",
    "review_scores_rating",
    "number_of_reviews",
    "reviews_per_month",
    "availability_365",
    "host_tenure_years",
    "price_per_bedroom",
    "estimated_occupancy_rate_365d",
)
LEAKING_FEATURES = ("price_per_bedroom",)
MIN_ROWS = 100
SEED = 42
LABEL = "label"
CONSTANT = "(constant)"


@dataclass(frozen=True)
class Features:
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    boolean: tuple[str, ...]

    @property
    def scaled(self) -> tuple[str, ...]:
        return self.numeric + self.boolean

    @property
    def all(self) -> tuple[str, ...]:
        return self.categorical + self.numeric + self.boolean


def resolve_features(df: DataFrame, leak_free: bool = False) -> Features:
    """The features a frame offers. ``leak_free`` leaves out those computed from the price."""
    field = {name: E.first_existing_col(df, names) for name, names in FIELD_NAMES.items()}
    dropped = LEAKING_FEATURES if leak_free else ()
    features = Features(
        categorical=tuple(c for c in (field["room"], field["area"]) if c),
        numeric=tuple(c for c in E.existing_columns(df, NUMERIC_FEATURES) if c not in dropped),
        boolean=tuple(c for c in (field["superhost"], field["professional"]) if c),
    )
    if not features.all:
        raise ValueError("no usable feature")
    return features


def feature_frame(df: DataFrame, leak_free: bool = False) -> DataFrame:
    """``id``, the features as text or double, ``label`` = log1p(price).

    Prices above 0 are kept, then those below their 99th percentile.
    """
    features = resolve_features(df, leak_free)
    price = E.first_existing_col(df, FIELD_NAMES["price"])
    if price is None:
        raise ValueError("no price column")
    priced = df.withColumn("_price", E.to_numeric(F.col(price), df.schema[price].dataType)).where(F.col("_price") > 0)
    kept = priced.where(F.col("_price") < global_quantile(priced, "_price", 0.99))
    return kept.select(
        "id",
        *features.categorical,
        *[E.finite(E.to_numeric(F.col(c), df.schema[c].dataType)).alias(c) for c in features.numeric],
        *[E.to_binary(F.col(c)).alias(c) for c in features.boolean],
        E.log_price(F.col("_price")).alias(LABEL),
    )


def split(frame: DataFrame, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``is_test`` for exactly ceil(n x share) rows: those with the smallest seeded id hash.

    Sixty bits of hash tell ids apart, so the cut is exact for unique ids, and it is found by rank
    selection instead of a global sort.
    """
    hashed = frame.withColumn("_h", E.seeded_hash(F.col("id"), seed))
    cut = rank_value(hashed, "_h", F.ceil(F.col("_n") * F.lit(test_share)) - 1).scalar()
    return hashed.withColumn("is_test", F.col("_h") <= cut).drop("_h")


def most_frequent(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: the most frequent value of each column (ties: the smallest)."""
    row = None
    for c in columns:
        counts = frame.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        best = counts.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias(c))
        row = best if row is None else row.withColumn(c, best.scalar())
    return row


def fill_categorical(frame: DataFrame, train: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    modes = {c: most_frequent(train, (c,)).scalar() for c in columns}
    return frame.withColumns({c: F.coalesce(F.col(c), mode) for c, mode in modes.items()})


def medians(train: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(feature, median) of each column, exact, from one pass over (feature, value) pairs."""
    pairs = train.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])))
    return exact_quantiles(pairs, ["feature"], "value", {"median": 0.5})


def fill_numeric(frame: DataFrame, train: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Missing numbers become the training rows' median; one value per column comes to the driver."""
    found = {r["feature"]: r["median"] for r in medians(train, columns).collect()} if columns else {}
    return frame.withColumns({c: F.coalesce(F.col(c), F.lit(found[c])) for c in columns})


def preprocessing(features: Features, scaled: tuple[str, ...]) -> list:
    """Scaling and one-hot coding of filled columns as pipeline stages.

    Unknown levels get the last index, which the encoder drops: they become all zeros.
    """
    indexed = [f"{c}_index" for c in features.categorical]
    coded = [f"{c}_onehot" for c in features.categorical]
    return [
        VectorAssembler(inputCols=list(scaled), outputCol="numeric_raw"),
        StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True),
        StringIndexer(
            inputCols=list(features.categorical),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=True),
        VectorAssembler(inputCols=["numeric_scaled", *coded], outputCol="features"),
    ]


def linear_regression():
    return LinearRegression(labelCol=LABEL)


def random_forest(trees: int = 100, depth: int = 10):
    return Forest(LABEL, trees=trees, depth=depth, seed=SEED)


def boosted_trees(rounds: int = 200, depth: int = 6):
    """Gradient-boosted trees with row and column sampling."""
    return Boosting(LABEL, rounds=rounds, depth=depth, step=0.1, rows_share=0.8, features_share=0.8, seed=SEED)


MODELS: dict[str, Callable] = {
    "Linear Regression": linear_regression,
    "Random Forest": random_forest,
    "Gradient-Boosted Trees": boosted_trees,
}


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    features: Features
    scaled: tuple[str, ...]
    stages: PipelineModel
    rows: int
    train_rows: int
    test_rows: int
    held: tuple[DataFrame, ...]

    def release(self) -> None:
        """Free the cached rows once no more models are trained on them."""
        for frame in self.held:
            frame.unpersist()


def prepare(enriched: DataFrame, leak_free: bool = False) -> Prepared:
    """Split, impute, scale and code once; every model trains on the same prepared rows."""
    features = resolve_features(enriched, leak_free)
    marked = split(feature_frame(enriched, leak_free)).persist(StorageLevel.MEMORY_AND_DISK)
    # One row of counts: numeric features without a single value are left out.
    counts = marked.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("is_test").alias("_test"),
        *[F.count(F.when(~F.col("is_test"), F.col(c))).alias(c) for c in features.scaled],
    ).first()
    if counts["_rows"] < MIN_ROWS:
        raise ValueError(f"{counts['_rows']} usable rows, at least {MIN_ROWS} are needed")
    scaled = tuple(c for c in features.scaled if counts[c] > 0)
    known = marked.where(~F.col("is_test"))
    filled = fill_numeric(fill_categorical(marked, known, features.categorical), known, scaled)
    train = filled.where(~F.col("is_test"))
    stages = Pipeline(stages=preprocessing(features, scaled)).fit(train)
    ready = stages.transform(filled).select("id", "is_test", "features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(
        train=ready.where(~F.col("is_test")),
        test=ready.where("is_test"),
        features=features,
        scaled=scaled,
        stages=stages,
        rows=counts["_rows"],
        train_rows=counts["_rows"] - counts["_test"],
        test_rows=counts["_test"],
        held=(marked, ready),
    )


def scaling(prepared: Prepared) -> DataFrame:
    """feature, mean, deviation: what each scaled feature is centred and divided by."""
    scaler = prepared.stages.stages[1]
    rows = [
        (name, float(mean), float(deviation))
        for name, mean, deviation in zip(prepared.scaled, scaler.mean.toArray(), scaler.std.toArray(), strict=True)
    ]
    return prepared.train.sparkSession.createDataFrame(rows, "feature string, mean double, deviation double")


def _cells(rows: DataFrame, prepared: Prepared, *carried: str) -> DataFrame:
    """feature and x of each entry of the feature vectors that is not 0, the constant 1 among them, and what is carried along."""
    names = F.array(*[F.lit(n) for n in [*feature_names(prepared), CONSTANT]])
    entries = F.concat(vector_to_array(F.col("features")), F.array(F.lit(1.0)))
    dealt = rows.select(*carried, F.posexplode(entries).alias("_at", "x")).where("x <> 0")
    return dealt.select(F.get(names, F.col("_at")).alias("feature"), "x", *carried)


def one_hot_rows(prepared: Prepared) -> DataFrame:
    """feature and n: the training rows of each one-hot level."""
    coded = feature_names(prepared)[len(prepared.scaled):]
    return _cells(prepared.train, prepared).where(F.col("feature").isin(coded)).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


def normal_equations(prepared: Prepared, model) -> DataFrame:
    """feature and cosine, for each feature and the constant: what the fit leaves of the normal equations.

    Least squares leaves residuals orthogonal to every feature. The products are summed by feature over all
    training rows, as partial sums before the shuffle; the cosine is the sum over the norms of both sides.
    """
    fitted = model.transform(prepared.train).withColumn("r", F.col(LABEL) - F.col("prediction"))
    sums = _cells(fitted, prepared, "r").groupBy("feature").agg(
        F.sum(F.col("r") * F.col("x")).alias("product"), F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("r") * F.col("r")).alias("rr")
    )
    # One row for each feature; the constant's holds the residuals of all rows.
    all_rows = F.max(F.when(F.col("feature") == CONSTANT, F.col("rr"))).over(Window.partitionBy(F.lit(1)))
    # Residuals of 0 are orthogonal to everything.
    cosine = F.coalesce(F.try_divide(F.col("product"), F.sqrt(F.col("xx") * all_rows)), F.lit(0.0))
    return sums.select("feature", cosine.alias("cosine"))


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: R2 on the log scale; MAE and RMSE in currency over finite predictions."""
    actual, predicted = E.unlog_price(F.col(LABEL)), E.unlog_price(F.col("prediction"))
    error = F.when(predicted.isNotNull(), actual - predicted)
    residual = F.col(LABEL) - F.col("prediction")
    return predictions.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(residual * residual), F.var_pop(LABEL) * F.count(LABEL))).alias("r2"),
    )


def result_row(prepared: Prepared, name: str, predictions: DataFrame) -> DataFrame:
    return evaluate(predictions).select(
        F.lit(name).alias("model"),
        F.lit(texts.MODEL_TARGET).alias("target"),
        F.lit(prepared.rows).cast("long").alias("rows_used"),
        F.lit(prepared.train_rows).cast("long").alias("train_rows"),
        F.lit(prepared.test_rows).cast("long").alias("test_rows"),
        F.lit(", ".join(prepared.features.all)).alias("features_used"),
        E.round_half_even(F.col("mae"), 2).alias("mae"),
        E.round_half_even(F.col("rmse"), 2).alias("rmse"),
        E.round_half_even(F.col("r2"), 4).alias("r2_score"),
        F.lit(texts.MODEL_NOTE).alias("business_interpretation"),
    )


def train_models(prepared: Prepared, models: Mapping[str, Callable] = MODELS) -> tuple[DataFrame, dict]:
    """One result row per model, and the fitted models."""
    fitted = {name: make().fit(prepared.train) for name, make in models.items()}
    report = None
    for name, model in fitted.items():
        row = result_row(prepared, name, model.transform(prepared.test))
        report = row if report is None else report.unionByName(row)
    return report, fitted


def feature_names(prepared: Prepared) -> list[str]:
    indexer = prepared.stages.stages[2]
    coded = [
        f"{column}_{label}"
        for column, labels in zip(prepared.features.categorical, indexer.labelsArray, strict=True)
        for label in labels
    ]
    return [*prepared.scaled, *coded]


def feature_importance(prepared: Prepared, name: str, model, k: int = 30) -> DataFrame | None:
    """The k weightiest features of a model, or None for a model that has no importances."""
    if not hasattr(model, "featureImportances"):
        return None
    spark = prepared.train.sparkSession
    weights = model.featureImportances.toArray()
    rows = [(name, feature, float(w)) for feature, w in zip(feature_names(prepared), weights, strict=True)]
    frame = spark.createDataFrame(rows, "model string, feature string, importance double")
    return top_k(frame, [F.desc("importance"), F.asc("feature")], k)


def best_model(report: DataFrame) -> DataFrame:
    return argmax_row(report, "r2_score")
