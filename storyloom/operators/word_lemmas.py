"""Lemmas by distinct words: a table of any size, then suffix rules, worked out once per word and joined to the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storyloom import lexicons
from storyloom.functions.let import let
from storyloom.functions.lookup import hash_lookup
from storyloom.functions.text import clean_text
from storyloom.functions.tokens import split_letters, suffix_lemma
from storyloom.operators.joins import lookup_join, lookup_table, word_table
from storyloom.session import scratch_dir
from storyloom.sources.files import kept_table

# Words of a text that are looked up together; it bounds the table that a row carries.
RUN = 512
# Words that are looked up on the row, and the letters that one of them may have: what the driver holds of them.
FREQUENT, LONGEST = 8_192, 64


def word_lemmas(words: DataFrame, lemmas: DataFrame, suffix_rules=lexicons.LEMMA_SUFFIXES) -> DataFrame:
    """(token, lemma) of the distinct words (token) whose lemma is another word: by the table (token, lemma), else by rule."""
    # each word once on either side: no word is frequent here, and nothing need be broadcast
    found = words.select("token").distinct().join(lemmas.select("token", "lemma").hint("merge"), "token", "left")
    # as one expression: the filter below would copy all rules into generated code that is too long to compile
    by_rule = let(F.col("token"), lambda w: suffix_lemma(w, suffix_rules)) if suffix_rules else F.col("token")
    return found.select("token", F.coalesce("lemma", by_rule).alias("lemma")).filter("token != lemma")


def _kept(lemma: Column, stop, min_length: int) -> Column:
    ok = F.length(lemma) >= min_length
    return ok & ~lemma.isin(*sorted(stop)) if stop else ok


def count_tokens(df: DataFrame, tables, text: str = "narrative", min_length: int = 2) -> DataFrame:
    """(token, n): how often each token occurs in all texts, as ``add_all_tokens`` makes them from the same tables.

    The words are counted first, so that lemma, rules and stop test run once per different word.
    """
    spark, lemmas = df.sparkSession, tables.lemmas
    if not isinstance(lemmas, DataFrame):
        lemmas = lookup_table(spark, lemmas, "token", "lemma")
    words = df.select(F.explode(split_letters(clean_text(F.col(text), normalise=tables.normalise))).alias("token"))
    counts = kept_table(words.groupBy("token").agg(F.count(F.lit(1)).alias("n")), scratch_dir(spark, "word-counts"))
    changed = word_lemmas(counts, lemmas, tables.suffix_rules)
    lemma = F.coalesce("lemma", "token")
    named = counts.join(changed.hint("merge"), "token", "left").select(lemma.alias("token"), "n").filter(_kept(F.col("token"), tables.stop, min_length))
    return named.groupBy("token").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, changed: DataFrame) -> dict[str, str]:
    """The ``FREQUENT`` most frequent words with their lemmas, themselves where they do not change. Very long words stay out."""
    short = lambda c: F.length(c) <= LONGEST
    words = [r["token"] for r in counts.filter(short("token")).orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").collect()]
    found = changed.join(F.broadcast(word_table(changed.sparkSession, words, "token")), "token")
    # a word with two lemmas is left to the join, which refuses it
    rows = found.groupBy("token").agg(F.when((F.count(F.lit(1)) == 1) & short(F.max("lemma")), F.max("lemma")).alias("lemma")).collect()
    lemmas = {w: w for w in words} | {r["token"]: r["lemma"] for r in rows}
    return {w: x for w, x in lemmas.items() if x is not None}


def add_tokens_by_words(
    df: DataFrame, key: str, lemmas: DataFrame, text: str = "narrative", normalise: bool = True, stop=lexicons.STOP_WORDS,
    suffix_rules=lexicons.LEMMA_SUFFIXES, min_length: int = 2,
) -> DataFrame:
    """Add ``tokens`` and ``processed_text`` as ``functions.tokens.add_tokens`` does, with a lemma table of any size.

    The texts' words are written, then counted, and one pass over the different words gives the lemmas, written as well. The
    ``FREQUENT`` most frequent words are looked up by an expression on the row; what is left are words of which none holds
    more than one in ``FREQUENT``, so that the distinct words of each run of ``RUN`` words are joined with the lemmas without
    salt, by broadcast or by merge as the table's bytes say. A text gets the lemmas of its runs by ``key``; rows without a key are dropped.
    """
    spark = df.sparkSession
    words = split_letters(clean_text(F.col(text), normalise=normalise))
    # words hold letters only, and a string takes less room than an array
    texts = kept_table(df.select(key, F.array_join(words, " ").alias("w")).filter(F.col(key).isNotNull() & (F.col("w") != "")), scratch_dir(spark, "text-words"))
    texts = texts.select(key, F.split("w", " ").alias("w"))
    counts = texts.select(F.explode("w").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = kept_table(counts, scratch_dir(spark, "word-counts"))
    table = kept_table(word_lemmas(counts, lemmas, suffix_rules), scratch_dir(spark, "word-lemmas"))
    frequent = hash_lookup(_frequent(counts, table), "string")
    starts = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(RUN))
    run = lambda w, at: F.slice(w, at + 1, F.lit(RUN))
    rest = texts.select(key, F.explode(starts("w")).alias("at"), "w").select(key, "at", F.filter(run("w", F.col("at")), lambda w: frequent(w).isNull()).alias("w"))
    own = lookup_join(rest.select(key, "at", F.explode(F.array_distinct("w")).alias("token")), table, "token", "inner", salts=1)
    # one shuffle by text; a set, as rows of one key share their words
    own = own.repartition(key).groupBy(key, "at").agg(F.map_from_entries(F.collect_set(F.struct("token", "lemma"))).alias("t"))
    own = own.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("at", "t"))).alias("_lemmas"))

    def lemmas_of(w):
        looked_up = lambda t, ws: F.transform(ws, lambda x: F.coalesce(frequent(x), F.try_element_at(t, x), x))
        of_run = lambda at: let(F.try_element_at("_lemmas", at), lambda t: looked_up(t, run(w, at)))
        return F.flatten(F.transform(starts(w), of_run))

    tokens = F.filter(let(words, lemmas_of), lambda w: _kept(w, stop, min_length))
    rows = df.filter(F.col(key).isNotNull()).join(own.hint("merge"), key, "left").withColumn("tokens", tokens).drop("_lemmas")
    return rows.withColumn("processed_text", F.array_join("tokens", " "))
