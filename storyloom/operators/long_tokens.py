"""Token rows, for lookups in tables too large for a plan literal."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storyloom.functions.tokens import split_letters
from storyloom.operators.joins import lookup_join


def tokens_long(df: DataFrame, key: str, clean: str) -> DataFrame:
    """(key, pos, token) for every letter run of a cleaned text."""
    return df.select(key, F.posexplode(split_letters(F.col(clean))).alias("pos", "token"))


def lemmatise_long(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Join token rows with a (token, lemma) table of any size; unlisted tokens stay."""
    joined = lookup_join(tokens, lemmas, "token", "left")
    return joined.withColumn("lemma", F.coalesce("lemma", "token"))


def drop_stop_words(lemmas: DataFrame, stop: DataFrame, min_length: int = 2) -> DataFrame:
    """Remove lemmas listed in a (lemma) table of any size, and single letters."""
    kept = lemmas.where(F.length("lemma") >= min_length)
    return lookup_join(kept, stop, "lemma", "left_anti")


def regroup(lemmas: DataFrame, key: str) -> DataFrame:
    """Token rows back to one array per document, in text order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "lemma")))
    return lemmas.groupBy(key).agg(F.transform(ordered, lambda s: s["lemma"]).alias("tokens"))
