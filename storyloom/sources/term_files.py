"""Term tables from files, for lexicons and lists larger than the seed tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from storyloom import lexicons
from storyloom.functions.lookup import MAX_LITERAL_ENTRIES


def read_valence_file(spark: SparkSession, path: str) -> DataFrame:
    """The published lexicon layout: word, mean valence, deviation and ratings, tab-separated.

    The scorer looks up lower-case words. A word with one capital in front is read as lower case; other
    entries with capitals (emoticons such as ``:D``) would match what they do not mean and are left out.
    A word listed with two different valences is an error.
    """
    raw = spark.read.csv(path, sep="\t", schema="word string, valence double, deviation double, ratings string", quote="")
    word = F.when(F.col("word").rlike("^[A-Z][a-z]+$"), F.lower("word")).otherwise(F.col("word"))
    kept = raw.withColumn("word", word).where((F.col("word") == F.lower("word")) & F.col("valence").isNotNull())
    ends = kept.groupBy("word").agg(F.min("valence").alias("valence"), F.max("valence").alias("other"))
    conflict = F.raise_error(F.concat(F.lit("two valences for "), F.col("word"))).cast("double")
    return ends.select("word", F.when(F.col("valence") == F.col("other"), F.col("valence")).otherwise(conflict).alias("valence"))


def as_dict(table: DataFrame, key: str, value: str, limit: int = MAX_LITERAL_ENTRIES) -> dict:
    """A small term table on the driver; a larger one is refused, not cut."""
    rows = table.select(key, value).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} terms: join the table with lookup_join instead")
    return {r[0]: r[1] for r in rows}


def with_valence_file(
    spark: SparkSession, path: str, base: lexicons.SentimentLexicon = lexicons.SENTIMENT
) -> lexicons.SentimentLexicon:
    """The scorer's tables with the valences of a file in place of the seed ones."""
    return replace(base, valence=as_dict(read_valence_file(spark, path), "word", "valence"))
