"""Entity counts over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storyloom.operators.joins import lookup_join, lookup_table, word_table
from storyloom.operators.topk import top_k


def entity_mentions(df: DataFrame, label: str, blacklist=(), keep=()) -> DataFrame:
    """One row per document and entity of a label, trimmed, without blacklisted ones."""
    rows = df.select(*keep, F.explode(F.try_element_at("entities", F.lit(label))).alias("entity"))
    rows = rows.withColumn("entity", F.trim("entity")).where(F.col("entity") != "")
    if not len(blacklist):
        return rows
    table = word_table(df.sparkSession, blacklist, "entity")
    return lookup_join(rows, table, "entity", "left_anti")


def rename_entities(mentions: DataFrame, names: dict) -> DataFrame:
    """Canonical names where listed, else as found."""
    table = lookup_table(mentions.sparkSession, names, "entity", "_name")
    joined = lookup_join(mentions, table, "entity", "left")
    return joined.withColumn("entity", F.coalesce("_name", "entity")).drop("_name")


def top_entities(df: DataFrame, label: str, k: int = 15, blacklist=(), names: dict | None = None) -> DataFrame:
    """The k most frequent entities of a label: blacklist first, then renaming."""
    mentions = entity_mentions(df, label, blacklist)
    if names:
        mentions = rename_entities(mentions, names)
    return top_k(mentions, "entity", k)
