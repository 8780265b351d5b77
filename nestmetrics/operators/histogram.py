"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bin`` (0-based), ``bin_start``, ``bin_end``, ``count``; empty bins are listed with 0.

    Bins span [min, max], each closed on the left, the last one on both sides. A constant column
    is spread over [value - 0.5, value + 0.5]. No values, no rows.
    """
    values = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    extent = values.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    bounds = extent.select(
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    ).where(F.col("lo").isNotNull())
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    counts = (
        values.select(F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    frame = bounds.select("lo", step.alias("_w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    # At most ``bins`` rows on either side.
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("_w") * F.col("bin")).alias("bin_start"),
        (F.col("lo") + F.col("_w") * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce(F.col("_n"), F.lit(0)).alias("count"),
    )
