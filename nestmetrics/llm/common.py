"""What the corpus operators share: tables, stored steps, private column names, text as bytes."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmetrics.session import scratch_path, ship_code, write_bytes  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    Cuts the lineage: what follows never computes the frame again, also after lost executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Delete the shuffle files of steps that are over, on all executors.

    Spark deletes those that no frame can read again when the driver's collector comes by, which a long job with
    small plans may put off until the disk is full. The listeners hold the last query, so a small one is run first.
    """
    spark.sql("SELECT 1").collect()
    spark._jvm.System.gc()


def release() -> None:
    """Hand memory that is not in use back to the system; workers live on between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same task over batches, its memory handed back at the end."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not use, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    return base if base not in taken else f"{base}_{uuid.uuid4().hex[:12]}"


def col(df: DataFrame, name: str) -> Column:
    """A column by its plain name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def text_of(df: DataFrame, name: str = "text") -> Column:
    """Text as a string; null counts as empty."""
    return F.coalesce(col(df, name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: A key is hot from one row in so many on, so at most so many keys are.
HOT_SHARE = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Each row with the columns of its group, no key being hot in the shuffle.

    Groups hold each key once, with its number of rows. Those over one in HOT_SHARE of all rows are
    at most HOT_SHARE, so they are broadcast; rows of the others meet theirs in a shuffle.
    """
    hot = F.broadcast(groups.where(F.col(size) * HOT_SHARE > total))
    cold = rows.join(hot.select(key), key, "left_anti").join(groups.hint("merge"), key)
    return rows.join(hot, key).unionByName(cold)


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose id and text digest are listed in kept (doc_id, digest), each once.

    Ids and digests, not groups, are the keys of the join, so no key is hot.
    """
    key, digest = free_name(docs, "kept_id"), free_name(docs, "kept_digest")
    listed = stored(
        kept.select(F.col("doc_id").alias(key), F.col("digest").alias(digest)).distinct(), "kept"
    )
    marked = docs.withColumns({key: col(docs, "doc_id").cast("long"), digest: digest_of(text_of(docs))})
    pairs = stored(marked.groupBy(key, digest).agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    found = marked.join(
        listed.hint("merge"), marked[key].eqNullSafe(listed[key]) & (marked[digest] == listed[digest]), "left_semi"
    )
    if not pairs.isEmpty():  # rows that share id and text
        found = found.dropDuplicates([key, digest])
    return found.drop(key, digest)
