"""Tokens as arrays inside the row: no explode, no shuffle."""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F

from storyloom import lexicons
from storyloom.functions.lookup import hash_lookup
from storyloom.functions.text import clean_text


def split_letters(clean: Column) -> Column:
    """Letter runs of a cleaned text, in order: between its letters are only spaces and brackets."""
    return F.array_remove(F.split(F.translate(clean, "[]", "  "), " "), "")


def _ending(pattern: str) -> str:
    """The letters that a rule's matches end in."""
    end = re.search(r"([a-z]*)\$$", pattern)
    return end[1] if end else ""


def suffix_lemma(word: Column, rules=lexicons.LEMMA_SUFFIXES) -> Column:
    """Lemma by the first suffix rule that matches, else the word.

    Rules are tried by the word's ending, so most words meet none: of neighbouring rules that end in the same letter, the
    patterns are only looked at for words that do.
    """
    out = word
    groups = [(k, list(g)) for k, g in groupby(rules, lambda r: _ending(r[0])[-1:])]
    for letter, group in reversed(groups):
        rest = out
        for pattern, replacement in reversed(group):
            ending = _ending(pattern)
            hit = word.rlike(pattern)
            hit = F.endswith(word, F.lit(ending)) & hit if len(ending) > 1 else hit
            rest = F.when(hit, F.regexp_replace(word, pattern, replacement)).otherwise(rest)
        out = F.when(F.endswith(word, F.lit(letter)), rest).otherwise(out) if letter else rest
    return out


def stop_list(keep=(), base=lexicons.STOP_WORDS) -> list[str]:
    """Stop words without those in ``keep``, e.g. polarity words."""
    return sorted(set(base) - set(keep))


def tokens_of(
    clean: Column,
    stop=lexicons.STOP_WORDS,
    lemmas: dict | None = None,
    suffix_rules=None,
    min_length: int = 2,
) -> Column:
    """Lemmas of a cleaned text without stop words and single letters.

    The stop test runs on the lemma. ``lemmas`` is looked up first, then
    ``suffix_rules``. Membership in ``stop`` is one hash-set probe per token.
    """
    words = split_letters(clean)
    table = lexicons.LEMMAS if lemmas is None else lemmas
    if table or suffix_rules:
        find = hash_lookup(table, "string")

        def lemma(w):
            fallback = suffix_lemma(w, suffix_rules) if suffix_rules else w
            return F.coalesce(find(w), fallback)

        words = F.transform(words, lemma)
    stop = sorted(stop)

    def keep(w):
        ok = F.length(w) >= min_length
        return ok & ~w.isin(*stop) if stop else ok

    return F.filter(words, keep)


def add_tokens(df: DataFrame, text: str = "narrative", normalise: bool = True, **options) -> DataFrame:
    """Add ``tokens`` and ``processed_text``."""
    clean = clean_text(F.col(text), normalise=normalise)
    return df.withColumn("tokens", tokens_of(clean, **options)).withColumn(
        "processed_text", F.array_join("tokens", " ")
    )


def processed_text(text: Column, **options) -> Column:
    """The single-text form: cleaned, tokenised and joined by spaces."""
    return F.array_join(tokens_of(clean_text(text), **options), " ")
