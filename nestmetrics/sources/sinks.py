"""Writers. All of them overwrite: every job is a full reload. Groups of tables are replaced as a whole by ``versions``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from nestmetrics.session import scratch_path

#: Tables are written once and read a few times, so the smaller files are worth the time.
CODEC = "zstd"

def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as read back from a fresh place in the shared folder: computed once, whatever reads them."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_partitioned(df: DataFrame, path: str, column: str) -> None:
    """One folder per value. The rebalance keeps files large and splits a hot value."""
    df.hint("rebalance", column).write.mode("overwrite").option("compression", CODEC).partitionBy(column).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """A bucketed, sorted table at a path, one file per bucket; returns it as read back."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("compression", CODEC)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_report(df: DataFrame, path: str) -> None:
    """A report (a handful of rows) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_export(df: DataFrame, path: str) -> None:
    """A table of any size as CSV files with headers, one per task."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
