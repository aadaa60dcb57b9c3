"""Fixed-edge histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def bucket_of(c: Column, low: float, high: float, bins: int) -> Column:
    """1-based bin; the last bin takes its upper edge, outliers go to the edge bins."""
    raw = F.floor((c - F.lit(float(low))) / F.lit((high - low) / bins)) + 1
    return F.least(F.greatest(raw, F.lit(1)), F.lit(bins)).cast("int")


def histogram(df: DataFrame, c: Column, low: float, high: float, bins: int, by=()) -> DataFrame:
    """Rows per non-empty bin (and per value of ``by``) with the bin's lower edge."""
    width = (high - low) / bins
    binned = df.where(c.isNotNull()).withColumn("bin", bucket_of(c, low, high, bins))
    return (
        binned.groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("edge", F.lit(float(low)) + (F.col("bin") - 1) * F.lit(width))
    )
