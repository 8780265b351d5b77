"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its lower-cased characters. Each feature has the
log ratio of its smoothed shares among toxic and other documents; present features enter a logistic
regression with that ratio as their value, so the regression starts from naive Bayes and corrects it.

Training takes at most ``TRAIN_ROWS`` labelled rows (those with the smallest id hash, one for each
text), which are stored once and read in at most ``TRAIN_TASKS`` tasks: a pass counts the n-grams, the
``FEATURES`` with the strongest association (likelihood ratio) are chosen, a pass lists each row's
chosen features, and one task fits the weights on that bounded table. Scoring is one pass over the
documents with a weight for each hash bucket, whatever the size of the corpus. Whole texts are used.

Defined cases: a null text is an empty one, which scores the intercept alone. Rows with a null id or
label are not trained on; of several labels of one id the toxic one counts. Without rows of both
labels every score is the smoothed share of toxic rows. Repeated rows get the same score. Extra columns
play no part: only the text is an input of a score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from nestmetrics.llm.common import col, releasing, ship_code, stored, table, text_of
from nestmetrics.session import LONG_TEXTS, settings

#: Most labelled rows that are trained on; about 100 MB of texts of ordinary length.
TRAIN_ROWS = 20_000
TRAIN_TASKS = 16
SIZES = (3, 4, 5)
BITS = 20
FEATURES = 500
#: Documents with a feature, below which it is not chosen.
LEAST_ROWS = 10
SMOOTHING = 1.0
RIDGE = 1e-4
STEPS = 400
THRESHOLD = 0.7
#: Characters hashed at a time.
SEGMENT = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of a text's n-grams, repeats included, in arrays of bounded size."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    most = max(SIZES)
    for at in range(0, max(1, len(codes)), SEGMENT):
        part = codes[at : at + SEGMENT + most - 1]
        value = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, most + 1):
            if n > len(part):
                break
            value = (value[: len(part) - n + 1] ^ part[n - 1 :]) * MULTIPLIER
            value ^= value >> np.uint64(29)
            if n in SIZES:
                starts = min(len(value), SEGMENT)  # the rest belongs to the next segment
                yield (((value[:starts] + np.uint64(n)) * MULTIPLIER) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """The distinct buckets of a text, of all or of those wanted."""
    found = [b if wanted is None else b[wanted[b]] for b in gram_buckets(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """text and toxic of at most so many labelled rows outside the held-out third; stored."""
    ship_code(docs.sparkSession)
    ids = labels.select(col(labels, "doc_id").cast("long").alias("doc_id"), col(labels, "toxic").cast("int").alias("toxic"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Bounded by the limit, so it may be broadcast.
    chosen = F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    texts = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).join(chosen, "doc_id")
    return stored(texts.groupBy("text").agg(F.max("toxic").alias("toxic")).repartition(TRAIN_TASKS), "training")


def gram_counts(rows: DataFrame) -> DataFrame:
    """bucket, toxic and other: documents of each label with the bucket; bucket -1 counts all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, (1 << BITS) + 1), dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[toxic, features(text.as_py())] += 1
                counts[toxic, -1] += 1
        some = np.flatnonzero(counts.any(axis=0))
        buckets = np.where(some == 1 << BITS, -1, some)
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(counts[1, some]), pa.array(counts[0, some])], names=["bucket", "toxic", "other"])

    parts = rows.mapInArrow(releasing(run), "bucket long, toxic long, other long")
    return parts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit_weights(lists: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on features valued by their ratio; weights of the values, and intercept.

    Gradient descent with momentum and a step for each feature by its own spread.
    """
    sizes = np.array([len(x) for x in lists])
    owner = np.repeat(np.arange(len(lists)), sizes)
    cols = np.concatenate(lists)
    values = ratio[cols]
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    weights, bias = np.zeros(len(ratio)), float(np.log(share / (1 - share)))
    spread = np.bincount(cols, weights=values**2, minlength=len(ratio)) / len(lists)
    rows = np.bincount(owner, weights=values**2, minlength=len(lists))
    # A bound of the curvature: a row's features share its error.
    rate = 1.0 / (0.25 * max(1.0, np.quantile(rows, 0.9)) * np.sqrt(np.maximum(spread, 1e-6)) + RIDGE)
    speed, bias_speed = np.zeros_like(weights), 0.0
    for step in range(STEPS):
        ahead, bias_ahead = weights + 0.9 * speed, bias + 0.9 * bias_speed
        score = np.bincount(owner, weights=ahead[cols] * values, minlength=len(lists)) + bias_ahead
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - toxic) / len(lists)
        slope = np.bincount(cols, weights=error[owner] * values, minlength=len(ratio)) + RIDGE * ahead
        speed = 0.9 * speed - rate * slope
        bias_speed = 0.9 * bias_speed - 0.5 * error.sum()
        weights, bias = weights + speed, bias + bias_speed
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """A weight for each hash bucket, and the intercept."""
    with settings(docs.sparkSession, LONG_TEXTS):
        return _trained(training_rows(docs, labels, most))


def _trained(rows: DataFrame) -> tuple[np.ndarray, float]:
    counts = stored(gram_counts(rows), "gram-counts")
    total = counts.where("bucket = -1").first()
    weights = np.zeros(1 << BITS, dtype=np.float32)
    toxic, other = (total["toxic"], total["other"]) if total else (0, 0)
    if not toxic or not other:
        share = (toxic + 1) / (toxic + other + 2)
        return weights, float(np.log(share / (1 - share)))
    # Likelihood ratio of a feature and the label, and the smoothed log-count ratio.
    have = F.col("toxic") + F.col("other")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    n = toxic + other
    strength = (
        part(F.col("toxic"), have * (toxic / n))
        + part(F.col("other"), have * (other / n))
        + part(toxic - F.col("toxic"), (n - have) * (toxic / n))
        + part(other - F.col("other"), (n - have) * (other / n))
    )
    chosen = (
        counts.where((F.col("bucket") >= 0) & (have >= LEAST_ROWS))
        .select("bucket", "toxic", "other", strength.alias("strength"))
        .orderBy(F.desc("strength"), "bucket")
        .limit(FEATURES)
        .toPandas()
    )
    buckets = chosen["bucket"].to_numpy()
    ratio = np.log((chosen["toxic"].to_numpy() + SMOOTHING) / (toxic + 2 * SMOOTHING)) - np.log(
        (chosen["other"].to_numpy() + SMOOTHING) / (other + 2 * SMOOTHING)
    )
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[buckets] = np.arange(len(buckets))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = place >= 0
        for batch in batches:
            found = [place[features(text.as_py(), wanted)] for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["found", "toxic"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, marks = [], []
        for batch in batches:
            lists.extend(np.asarray(x.values) for x in batch.column(0))
            marks.extend(batch.column(1).to_pylist())
        weight, bias = fit_weights(lists, np.array(marks, dtype=float), ratio)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(buckets, -1)), pa.array(np.append(weight * ratio, bias))], names=["bucket", "weight"])

    # At most TRAIN_ROWS short lists, so one task may hold them.
    model = stored(rows.mapInArrow(releasing(listed), "found array<int>, toxic int"), "features").coalesce(1).mapInArrow(releasing(fitted), "bucket long, weight double").toPandas()
    inner = model["bucket"] >= 0
    weights[model["bucket"][inner].to_numpy()] = model["weight"][inner].to_numpy()
    return weights, float(model["weight"][~inner].iloc[0])


def _with_score(frame: DataFrame, at: int, weights: np.ndarray, bias: float, first: int = 0) -> DataFrame:
    """The columns of a frame from the first on, and the score of its text column; weights go to the tasks (4 MB)."""
    ship_code(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        wanted = weight != 0
        for batch in batches:
            sums = np.array([float(weight[features(text.as_py() or "", wanted)].sum(dtype=np.float64)) for text in batch.column(at)]) + bias
            score = 1 / (1 + np.exp(-np.clip(sums, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], pa.array(score)], names=[*batch.schema.names[first:], "score"])

    return frame.mapInArrow(releasing(run), StructType([*frame.schema.fields[first:], StructField("score", DoubleType())]))


def scored(docs: DataFrame, weights: np.ndarray, bias: float, carried: list[Column]) -> DataFrame:
    """The carried columns and score."""
    frame = docs.select(text_of(docs).alias("text"), *carried)
    return _with_score(frame.toDF("text", *(f"c{i}" for i in range(len(carried)))), 0, weights, bias, first=1)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with their own columns; stored, so that they are scored in small batches."""
    weights, bias = train(docs, labels)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    kept = _with_score(plain, docs.columns.index("text"), weights, bias).where(F.col("score") < THRESHOLD).drop("score")
    with settings(docs.sparkSession, LONG_TEXTS):
        return stored(kept, "not-toxic").toDF(*docs.columns)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's score, stored: three numbers a row."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights, bias = train(docs, labels)
    doc_id = col(docs, "doc_id").cast("long")
    out = scored(docs, weights, bias, [doc_id.alias("doc_id"), F.coalesce(is_held_out(doc_id), F.lit(False)).alias("held_out")])
    with settings(spark, LONG_TEXTS):
        found = stored(out.toDF("doc_id", "held_out", "score"), "scores")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
