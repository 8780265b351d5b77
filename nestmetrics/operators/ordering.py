"""Running totals, dense keys and ranks over a whole table without one global window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.functions.exprs import seeded_hash
from nestmetrics.operators.radix import bucket_levels
from nestmetrics.session import scratch_path
from nestmetrics.sources.sinks import stored

_EARLIER = (Window.unboundedPreceding, -1)
# Below every bucket code.
_NULL_CODE = -(2**62)


def with_levels(df: DataFrame, order_by: str) -> DataFrame:
    """Bucket codes of the column, as ``_b1`` and ``_b2``; nulls are a bucket before all others."""
    b1, b2 = bucket_levels(F.col(order_by), df.schema[order_by].dataType)
    null = F.col(order_by).isNull()
    return df.withColumns({"_b1": F.when(null, _NULL_CODE).otherwise(b1), "_b2": F.when(null, _NULL_CODE).otherwise(b2)})


def bucket_offsets(
    leveled: DataFrame, weights: Mapping[str, Column], keys: Sequence[str] = (), totals: Mapping[str, Column] | None = None
) -> DataFrame:
    """Per key and (``_b1``, ``_b2``): the total of each weight over all earlier buckets of the key.

    ``totals`` are sums over all of the key's rows, which come along. The windows run over bucket totals
    only, whose number is bounded by the bucket codes.
    """
    totals = totals or {}
    sums = leveled.groupBy(*keys, "_b1", "_b2").agg(*[F.sum(w).alias(n) for n, w in {**weights, **totals}.items()])
    inner = Window.partitionBy(*keys, "_b1").orderBy("_b2").rowsBetween(*_EARLIER)
    outer = Window.partitionBy(*keys).orderBy("_b1").rowsBetween(*_EARLIER)
    zero = F.lit(0)
    within = sums.select(
        *keys, "_b1", "_b2", *[F.coalesce(F.sum(n).over(inner), zero).alias(f"_in_{n}") for n in weights]
    )
    before = (
        sums.groupBy(*keys, "_b1")
        .agg(*[F.sum(n).alias(n) for n in [*weights, *totals]])
        .select(
            *keys,
            "_b1",
            *[F.coalesce(F.sum(n).over(outer), zero).alias(f"_out_{n}") for n in weights],
            *[F.sum(n).over(Window.partitionBy(*keys)).alias(n) for n in totals],
        )
    )
    return within.join(before, [*keys, "_b1"]).select(
        *keys, "_b1", "_b2", *[(F.col(f"_in_{n}") + F.col(f"_out_{n}")).alias(f"_start_{n}") for n in weights], *totals
    )


def prefix_sums(
    df: DataFrame,
    order_by: str,
    weights: Mapping[str, str],
    keys: Sequence[str] = (),
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add, for each ``output: weight column``, the weight total of all of the key's rows before this one.

    ``order_by`` must be unique per key and row; group and sum first where it is not. Keys must not be
    null. ``totals`` adds sums over all of the key's rows.
    """
    leveled = with_levels(df, order_by)
    offsets = bucket_offsets(leveled, {n: F.col(w) for n, w in weights.items()}, keys, totals)
    here = Window.partitionBy(*keys, "_b1", "_b2").orderBy(order_by).rowsBetween(*_EARLIER)
    return (
        leveled.join(offsets, [*keys, "_b1", "_b2"])
        .withColumns(
            {
                n: F.col(f"_start_{n}") + F.coalesce(F.sum(w).over(here), F.lit(0))
                for n, w in weights.items()
            }
        )
        .drop("_b1", "_b2", *[f"_start_{n}" for n in weights])
    )


#: Most rows that one window of a numeric key numbers; a bucket of different whole numbers never holds more.
WINDOW_ROWS = 2**21
#: Rows of one piece of a bucket with more rows than that.
_PIECE_BITS = 16


def surrogate_key(
    df: DataFrame, order_by: str, name: str, tie_break: Sequence[str] = (), window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Dense 1..n integers in the order of a column, as the first column.

    Nulls come first. Numbers and dates are ordered by bucket codes. A bucket with more than ``window_rows``
    rows, as a key or null that many rows share makes one, is numbered by pieces instead (``_key_by_pieces``), so
    no window holds more than that. Strings, and orders with a tie-break, are ordered by sampled ranges of
    the whole order, so copies and nulls are split where a tie-break tells them apart.
    """
    if tie_break or isinstance(df.schema[order_by].dataType, T.StringType):
        return _key_by_ranges(df, [order_by, *tie_break], name)
    leveled = with_levels(df, order_by)
    # Stored, so that looking for full buckets and numbering read the table once for their sizes.
    totals = stored(leveled.groupBy("_b1", "_b2").agg(F.count(F.lit(1)).alias("_rows")), "key-buckets")
    offsets = bucket_offsets(totals, {"n": F.col("_rows")})
    full = totals.where(F.col("_rows") > window_rows).select("_b1", "_b2")
    split = not full.isEmpty()
    here = Window.partitionBy("_b1", "_b2").orderBy(order_by)
    key = (F.col("_start_n") + F.row_number().over(here)).cast("long").alias(name)
    plain = leveled.join(full, ["_b1", "_b2"], "left_anti") if split else leveled
    numbered = plain.join(offsets, ["_b1", "_b2"]).select(key, *df.columns)
    if not split:
        return numbered
    crowded = leveled.join(full, ["_b1", "_b2"], "left_semi")
    return numbered.unionByName(_key_by_pieces(crowded, offsets, order_by, name).select(name, *df.columns))


def _key_by_pieces(crowded: DataFrame, offsets: DataFrame, order_by: str, name: str) -> DataFrame:
    """Rows of full buckets, numbered by value and, among copies of a value, by where they are stored.

    A piece is 2**16 rows in a row of one stored partition, so a window over a (value, piece) is no larger.
    The windows over totals hold the values of one bucket (2**21 at most) or the pieces of one value. The
    rows are stored first, because their places would change if they were computed again.
    """
    placed = stored(crowded.withColumn("_at", F.monotonically_increasing_id()), "key-pieces")
    # A struct of the value is never null, so plain equality joins keep nulls.
    rows = placed.withColumns({"_v": F.struct(order_by), "_piece": F.shiftright("_at", _PIECE_BITS)})
    bucket, value = ["_b1", "_b2"], ["_b1", "_b2", "_v"]
    sizes = rows.groupBy(*value, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*value).orderBy("_piece").rowsBetween(*_EARLIER)
    by_piece = sizes.select(*value, "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before_piece"))
    smaller = Window.partitionBy(*bucket).orderBy("_v").rowsBetween(*_EARLIER)
    by_value = sizes.groupBy(*value).agg(F.sum("_n").alias("_n")).select(
        *value, F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_before_value")
    )
    starts = by_piece.join(by_value, value).join(offsets, bucket).select(
        *value, "_piece", (F.col("_start_n") + F.col("_before_value") + F.col("_before_piece")).alias("_start")
    )
    here = Window.partitionBy(*value, "_piece").orderBy("_at")
    inside = rows.withColumn("_inside", F.row_number().over(here))
    return inside.join(starts, [*value, "_piece"]).withColumn(name, (F.col("_start") + F.col("_inside")).cast("long"))


def _key_by_ranges(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows dealt to ranges of the order by sampled bounds, numbered inside and offset by range.

    The ranges are stored, because sampling them again could draw other bounds.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    # One row for each range, of which there are as many as shuffle partitions at most.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranged.withColumn("_inside", inside).join(F.broadcast(before), "_range")
    return numbered.select((F.col("_start") + F.col("_inside")).cast("long").alias(name), *df.columns)


def mid_ranks(
    df: DataFrame,
    value: str,
    groups: Mapping[str, Column],
    keys: Sequence[str] = (),
    totals: Mapping[str, Column] | None = None,
    disjoint: bool = False,
) -> DataFrame:
    """Distinct values with their tie-averaged rank in the pooled sample, one sample for each key.

    Columns: the keys, the value, ``ties`` (rows with it), one count per named group, ``mid_rank``, and
    ``totals``: sums of expressions of the former over the sample. Rows are counted per value before
    anything is ordered, so all samples together are one scan. With ``disjoint``, each row is in exactly
    one group: ties are then the sum of the groups' counts, and every use of the counts reads the same
    columns of them, so that their exchange is reused.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(
            *([] if disjoint else [F.count(F.lit(1)).alias("ties")]),
            *[F.sum(F.when(flag, 1).otherwise(0)).alias(name) for name, flag in groups.items()],
        )
    )
    if disjoint:
        counts = counts.select(*keys, value, reduce(add, map(F.col, groups)).alias("ties"), *groups)
    ranked = prefix_sums(counts, value, {"_before": "ties"}, keys, totals)
    return ranked.withColumn("mid_rank", F.col("_before") + (F.col("ties") + 1) / F.lit(2.0)).drop("_before")


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order_by: str, drop_null_keys: bool = False) -> DataFrame:
    """The row with the smallest ``order_by`` per key.

    An aggregate, not a window: copies collapse before the shuffle, whatever their number.
    """
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.col(order_by)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col("_first").getField(c).alias(c) for c in df.columns]
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of a total order: a bounded heap per task, then one merge of k rows each."""
    return df.orderBy(*order).limit(k)


def argmax_row(df: DataFrame, by: str) -> DataFrame:
    """The row with the largest value of a column, as one aggregate."""
    whole = F.struct(*df.columns)
    return df.where(F.col(by).isNotNull()).agg(F.max_by(whole, by).alias("_r")).where("_r is not null").select("_r.*")


def number_rows(df: DataFrame, order_by: str, name: str) -> DataFrame:
    """1..n in front of a report. Reports hold one row per finding, so one window is enough."""
    key = F.row_number().over(Window.orderBy(order_by)).alias(name)
    return df.select(key, *[c for c in df.columns if c != order_by])


def sample_fixed_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer) without replacement, repeatable for a seed.

    Rows are taken in the order of a seeded hash of their key.
    """
    return df.orderBy(seeded_hash(F.col(key), seed), F.col(key)).limit(n)
