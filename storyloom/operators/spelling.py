"""Spelling correction by deletion neighbourhoods: no word is compared with words that share no deletion with it."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from storyloom.operators.joins import lookup_join
from storyloom.session import scratch_dir, spread
from storyloom.sources.files import kept_table

# Letters of a word that deletions are taken from. Words within a distance share a deletion of their first letters too.
PREFIX = 7
# Known words that share a deletion, above which both sides of that deletion are dealt over SALTS tasks.
HOT, SALTS = 256, 32
# Tasks that the words are dealt over before their deletions are taken.
WORD_TASKS = 64
# A run of letters, or what stands between two runs.
WORD = "[A-Za-z]+"
PIECE = "[A-Za-z]+|[^A-Za-z]+"


def _words(text: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n): how often each lower-case run of letters occurs in the texts."""
    words = df.select(F.explode(_words(text)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def deletions(word: Column, distance: int = 2, prefix: int = PREFIX) -> Column:
    """The first letters of a word, and all they leave when up to ``distance`` letters go; each once."""

    def without(gone: tuple) -> Column:
        # what stands between the letters that go
        ends = [0, *gone, prefix + 1]
        kept = [F.substring(word, a + 1, b - a - 1) for a, b in zip(ends, ends[1:]) if b - a > 1]
        rest = F.concat(*kept) if kept else F.lit("")
        return F.when(F.length(word) >= gone[-1], rest) if gone else rest

    places = [gone for n in range(min(distance, prefix) + 1) for gone in combinations(range(1, prefix + 1), n)]
    return F.array_distinct(F.array_compact(F.array(*map(without, places))))


def near_words(words: DataFrame, known: DataFrame, distance: int = 2) -> DataFrame:
    """(word, known, n, distance): the known words (word, n) within ``distance`` edits of each word.

    Both sides are indexed by their deletions and joined on them, which finds every such pair; the edit distance
    is then taken once per pair. A deletion that very many known words share is salted: its words are dealt by hash
    over ``SALTS`` tasks, its known words are copied to all of them.
    """
    # Few bytes of words make many keys: without being dealt out they would lie in one or two tasks.
    spark = words.sparkSession
    words = spread(words.select("word"), "word", max(spark.sparkContext.defaultParallelism, WORD_TASKS))
    left = words.select("word", deletions(F.col("word"), distance).alias("keys")).select("word", F.explode("keys").alias("key"))
    right = spread(known.select("word", "n"), "word").select(F.col("word").alias("known"), "n", deletions(F.col("word"), distance).alias("keys"))
    # read twice: for the hot keys and for the pairs
    right = kept_table(right.select("known", "n", F.explode("keys").alias("key")), scratch_dir(spark, "known-deletions"))
    hot = right.groupBy("key").count().filter(F.col("count") > HOT).select("key", F.lit(SALTS).alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    left = lookup_join(left, hot, "key").select("word", "key", F.pmod(F.xxhash64("word"), salts).cast("int").alias("salt"))
    right = lookup_join(right, hot, "key").select("known", "n", "key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    pairs = left.join(right, ["key", "salt"]).filter(F.abs(F.length("word") - F.length("known")) <= distance)
    pairs = pairs.withColumn("distance", F.levenshtein("word", "known", distance)).filter(F.col("distance") >= 0)
    return pairs.groupBy("word", "known").agg(F.first("n").alias("n"), F.first("distance").alias("distance"))


def corrections(words: DataFrame, known: DataFrame, distance: int = 2, min_length: int = 4) -> DataFrame:
    """(word, correction, distance): for each (word) that is not known the best known word (word, n).

    The nearest comes first, then the most frequent, then the smallest. Words shorter than ``min_length``, words that
    are known, and words without a neighbour have no row.
    """
    unknown = words.select("word").filter(F.length("word") >= min_length).distinct().join(known.select("word"), "word", "left_anti")
    near = near_words(unknown, known.filter(F.length("word") >= min_length - distance), distance)
    best = near.groupBy("word").agg(F.min(F.struct("distance", (-F.col("n")).alias("n"), "known")).alias("best"))
    return best.select("word", F.col("best.known").alias("correction"), F.col("best.distance").alias("distance"))


def corpus_corrections(df: DataFrame, text: str, known_from: int = 20, distance: int = 2, min_length: int = 4) -> DataFrame:
    """``corrections`` of the words that the texts hold fewer than ``known_from`` times, by those they hold more often."""
    # written: all that follows reads the counts, not the texts
    counts = kept_table(word_counts(df, text), scratch_dir(df.sparkSession, "word-counts"))
    return corrections(counts, counts.filter(F.col("n") >= known_from), distance, min_length)


def _as_written(word: Column, correction: Column) -> Column:
    """The correction in capitals where the word is, or with a capital in front."""
    capital = F.concat(F.upper(F.substring(correction, 1, 1)), F.substring(correction, F.lit(2), F.length(correction)))
    first = F.substring(word, 1, 1)
    return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(correction)).when(first == F.upper(first), capital).otherwise(correction)


def correct_spelling(df: DataFrame, key: str, text: str, corrected: DataFrame) -> DataFrame:
    """(key, texto_corregido, cantidad_errores): every text with its listed words replaced, and how many there were.

    ``corrected`` has (word, correction). Only the different words of a text are joined with it, and only the replacements go back to
    the text, which is not taken apart in the shuffle. Null texts are dropped, blank ones stay as they are; ``key`` names rows.
    """
    filled = df.dropna(subset=[text])
    words = filled.select(key, F.explode(F.array_distinct(_words(text))).alias("word"))
    found = lookup_join(words, corrected.select("word", "correction"), "word", "inner")
    tables = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "correction"))).alias("_t"))
    joined = filled.join(tables, key, "left")
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    new = lambda p: F.try_element_at("_t", F.lower(p))
    fixed = F.array_join(F.transform(pieces, lambda p: F.coalesce(_as_written(p, new(p)), p)), "")
    hits = F.size(F.filter(pieces, lambda p: new(p).isNotNull()))
    return joined.select(
        key,
        F.when(F.col("_t").isNull(), F.col(text)).otherwise(fixed).alias("texto_corregido"),
        F.when(F.col("_t").isNull(), 0).otherwise(hits).alias("cantidad_errores"),
    )
