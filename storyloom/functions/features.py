"""Text features of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storyloom import lexicons
from storyloom.functions.text import mask_redactions


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words_in(text))


def unique_words(text: Column) -> Column:
    return F.size(F.array_distinct(words_in(text)))


def lexical_diversity(unique: Column, count: Column) -> Column:
    return unique.cast("double") / (count + 1)


def legal_term_count(text: Column, terms=lexicons.LEGAL_TERMS) -> Column:
    """Number of listed terms contained, ignoring case. Lower-cased once per row."""
    wanted = F.array(*[F.lit(t.lower()) for t in terms])
    folded = F.array(F.lower(text))
    per_text = F.transform(folded, lambda low: F.size(F.filter(wanted, lambda t: F.contains(low, t))))
    return F.coalesce(F.get(per_text, F.lit(0)), F.lit(0))


def uppercase_ratio(text: Column) -> Column:
    upper = F.length(F.regexp_replace(text, r"\P{IsUppercase}++", ""))
    return upper.cast("double") / (F.length(text) + 1)


def mask_count(text: Column, source: str = "raw") -> Column:
    """Count of ``[MASK]``: in the text as it is, or after redactions are masked."""
    return F.regexp_count(mask_redactions(text) if source == "masked" else text, F.lit(r"\[MASK\]"))


def add_features(df: DataFrame, text: str = "narrative", terms=lexicons.LEGAL_TERMS, masks: str = "raw") -> DataFrame:
    """Add the six feature columns. Needs ``tokens``."""
    c = F.col(text)
    return df.withColumns(
        {"word_count": F.size("tokens"), "unique_words": F.size(F.array_distinct("tokens"))}
    ).withColumns(
        {
            "lexical_diversity": lexical_diversity(F.col("unique_words"), F.col("word_count")),
            "legal_term_count": legal_term_count(c, terms),
            "uppercase_ratio": uppercase_ratio(c),
            "mask_count": mask_count(c, masks),
        }
    )
