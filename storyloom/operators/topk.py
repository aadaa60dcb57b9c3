"""Counts and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Rows per non-null value. Partial counts are made before the shuffle."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, col: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values; ties by value."""
    return value_counts(df, col, name).orderBy(F.desc(name), F.asc(col)).limit(k)


def cross_counts(df: DataFrame, a: str, b: str, name: str = "n") -> DataFrame:
    """Rows per pair of non-null values."""
    kept = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return kept.groupBy(a, b).agg(F.count(F.lit(1)).alias(name))


def keep_top(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose value is among the k most frequent; the k values are broadcast."""
    top = top_k(df, col, k).select(col)
    return df.join(F.broadcast(top), col, "left_semi")


def top_term_weights(df: DataFrame, tokens: str, k: int, stop=(), min_length: int = 1) -> DataFrame:
    """Top tokens with their count and their weight against the most frequent one."""
    words = long_tokens(df, tokens)
    if stop:
        words = words.where(~F.col("token").isin(*sorted(stop)))
    if min_length > 1:
        words = words.where(F.length("token") >= min_length)
    top = top_k(words, "token", k)
    peak = top.agg(F.max("n").alias("m")).scalar()
    return top.withColumn("weight", F.col("n") / peak)


def long_tokens(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row per token."""
    return df.select(F.explode(tokens).alias("token"))
