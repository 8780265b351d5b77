"""Readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.functions.exprs import date_key_to_date, round_half_even


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, rebalance: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV or gzipped CSV with a header and quoted fields.

    Plain files are split among tasks unless fields may span lines (``multi_line=True``). A gzip file
    is one task; ``rebalance`` deals its rows out afterwards, by their measured size.
    """
    df = spark.read.schema(schema).csv(path, header=True, multiLine=multi_line, quote='"', escape='"')
    return df.hint("rebalance") if rebalance else df


def read_parquet_optional(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame | None:
    """A Parquet table (chosen columns only), or None where there is none."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df.select(*columns) if columns else df


def read_reports(spark: SparkSession, root: str, names: Sequence[str], schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """Report CSVs by name; a missing report is empty."""
    reports = {}
    for name in names:
        try:
            reports[name] = spark.read.schema(schemas[name]).csv(f"{root}/{name}", header=True, quote='"', escape='"')
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            reports[name] = spark.createDataFrame([], schemas[name])
    return reports


def scan_with_fallback(spark: SparkSession, candidates: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first of the tables or Parquet paths that exists, with absent columns as null.

    A date is rebuilt from ``date_key`` where only that is stored.
    """
    for source in candidates:
        if "/" in source:
            df = read_parquet_optional(spark, source)
        else:
            df = spark.table(source) if spark.catalog.tableExists(source) else None
        if df is None:
            continue
        have = df.columns
        picked = []
        for c in columns:
            if c in have:
                picked.append(F.col(c))
            elif c == "date" and "date_key" in have:
                picked.append(date_key_to_date(F.col("date_key")).alias("date"))
            else:
                picked.append(F.lit(None).cast("string").alias(c))
        return df.select(*picked)
    raise FileNotFoundError(f"none of {list(candidates)} exists")


def ingest_manifest(spark: SparkSession, root: str, registry: DataFrame, city: str) -> DataFrame:
    """One row per expected file: size, time and whether it is there.

    ``registry`` has file_key, source_url and local_name, the path below the root. Sizes come from the file listing; file
    contents are not read.
    """
    folder = root.rstrip("/").split("://")[-1].removeprefix("file:")
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(
            F.substring_index("path", f"{folder}/", -1).alias("local_name"),
            F.col("path").alias("_path"),
            F.col("length").alias("_bytes"),
            F.col("modificationTime").alias("_at"),
        )
    )
    return registry.join(found, "local_name", "left").select(
        F.lit(city).alias("city"),
        "file_key",
        "source_url",
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("local_name")).alias("local_path"),
        F.coalesce(round_half_even(F.col("_bytes") / F.lit(1024.0 * 1024.0), 2), F.lit(0.0)).alias("file_size_mb"),
        F.date_format("_at", "yyyy-MM-dd'T'HH:mm:ss").alias("downloaded_at"),
        F.when(F.col("_path").isNull(), "failed").otherwise("skipped_existing").alias("status"),
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count_if(F.col("status").isin("success", "skipped_existing")).alias("available"),
        F.count(F.lit(1)).alias("total"),
    )
