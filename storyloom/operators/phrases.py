"""Entities from phrase tables of any size, and the choice among overlapping spans over the whole text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from storyloom.functions.entities import Rule, in_match_order
from storyloom.functions.let import let
from storyloom.functions.text import MASK, WORD_AFTER, WORD_BEFORE, mask_redactions, text_or_empty
from storyloom.operators.joins import lookup_join

# A word, or what stands between two words.
PIECE = r"[\p{L}\p{N}_]++|[^\p{L}\p{N}_]++"
# Pieces whose lengths are added up at once; each place adds up half as many on average.
BLOCK = 16
SPAN = "start int, length int, label string, text string"
_SPANS = "array<struct<start:int,length:int,label:string,text:string>>"
# Private characters that stand around a match while it is located; where a text holds them itself they read as U+FFFD.
_OPEN, _CLOSE = "\ue000", "\ue001"


def is_phrase(rule: Rule) -> bool:
    """Whether a rule is a phrase that begins and ends with a word, so that it is a run of whole pieces."""
    letter = lambda c: c.isalnum() or c == "_"
    return not rule.regex and bool(rule.pattern) and letter(rule.pattern[0]) and letter(rule.pattern[-1])


def phrase_table(spark: SparkSession, rules) -> DataFrame:
    """(label, phrase) of the phrase rules, each phrase once, under the label of its first rule."""
    first: dict[str, str] = {}
    for r in in_match_order(rules):
        if is_phrase(r):
            first.setdefault(r.pattern, r.label)
    return spark.createDataFrame([(v, k) for k, v in first.items()], "label string, phrase string")


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def _starts(pieces: Column, each, first: Column | int = 0, step: int = 1) -> Column:
    """``each(piece, i, start)`` of every ``step``-th piece from ``first`` on; ``start`` is the number of characters before, from sums over blocks."""
    n = F.size(pieces)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK)), lambda b: F.length(F.array_join(F.slice(pieces, b + 1, F.lit(BLOCK)), "")))
    running = lambda xs, start: F.aggregate(xs, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def before(sizes: Column) -> Column:
        # sums over groups of blocks first, so that no long array grows one by one
        groups = F.sequence(F.lit(0), F.size(sizes) - 1, F.lit(BLOCK))
        part = lambda g: F.slice(sizes, g + 1, F.lit(BLOCK))
        totals = F.transform(groups, lambda g: F.aggregate(part(g), F.lit(0), lambda a, x: a + x))
        return let(running(totals, F.lit(0)), lambda s: F.flatten(F.transform(groups, lambda g, i: F.slice(running(part(g), F.get(s, i)), F.lit(1), F.lit(BLOCK)))))

    def of(s: Column) -> Column:
        block = lambda i: F.floor(i / BLOCK).cast("int")
        inside = lambda i: F.when(i % BLOCK == 0, 0).otherwise(F.length(F.array_join(F.slice(pieces, block(i) * BLOCK + 1, F.greatest(i % BLOCK, F.lit(1))), "")))
        places = F.when(n > first, F.sequence(F.lit(first) if isinstance(first, int) else first, n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: each(F.get(pieces, i), i, F.get(s, block(i)) + inside(i)))

    return let(let(blocks, before), of)


def phrase_spans(df: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """(key, start, length, label, text) of every place where a phrase of (label, phrase) stands as whole words.

    Phrases are keyed by their first word and their number of pieces. Every word of a text is joined with the
    first words; those that are one give a candidate per length, joined with the phrases themselves. So the work
    follows the texts, not the number of phrases; both joins measure their table (``lookup_join``).
    """
    keyed = phrases.select("label", "phrase", _pieces(F.col("phrase")).alias("p"))
    keyed = keyed.select("label", "phrase", F.get("p", F.lit(0)).alias("first"), F.size("p").alias("n"))
    heads = keyed.groupBy("first").agg(F.collect_set("n").alias("ns"))
    longest = keyed.agg(F.max("n")).first()[0] or 1

    def words(p: Column) -> Column:
        # words and what stands between them take turns
        first = F.when(F.regexp_like(F.get(p, F.lit(0)), F.lit(r"^[\p{L}\p{N}_]")), 0).otherwise(1)
        place = lambda w, i, start: F.struct(start.cast("int").alias("start"), w.alias("first"), F.slice(p, i + 1, F.lit(longest)).alias("ahead"))
        return _starts(p, place, first, 2)

    rows = df.select(key, F.explode(let(_pieces(text_or_empty(F.col(text))), words)).alias("w")).select(key, "w.*")
    rows = lookup_join(rows, heads, "first", "inner").select(key, "start", "ahead", F.explode("ns").alias("n")).filter(F.size("ahead") >= F.col("n"))
    rows = rows.select(key, "start", F.array_join(F.slice("ahead", F.lit(1), F.col("n")), "").alias("phrase"))
    found = lookup_join(rows, keyed.select("label", "phrase"), "phrase", "inner")
    return found.select(key, "start", F.length("phrase").alias("length"), "label", F.col("phrase").alias("text"))


def pattern_spans(text: Column, rules) -> Column:
    """Spans of the matches of each rule that is no phrase, rule by rule, as an array."""
    clean = F.translate(text_or_empty(text), _OPEN + _CLOSE, "\ufffd\ufffd")

    def of(rule: Rule) -> Column:
        marked = F.split(F.regexp_replace(clean, f"{WORD_BEFORE}(?:{rule.expression}){WORD_AFTER}", f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]")

        def located(parts: Column) -> Column:
            # gaps and matches take turns
            matches = _starts(parts, lambda p, i, start: F.struct(start.alias("start"), p.alias("text")), 1, 2)
            return F.transform(
                matches, lambda m: F.struct(m["start"].cast("int").alias("start"), F.length(m["text"]).alias("length"), F.lit(rule.label).alias("label"), m["text"].alias("text"))
            )

        return let(marked, located)

    others = [of(r) for r in rules if not is_phrase(r)]
    return F.concat(*others) if others else F.array().cast(_SPANS)


def _free_spans(spans: pd.Series) -> pd.Series:
    """Of each text's spans, longest first, then leftmost, those that no kept one overlaps, by place."""
    from bisect import bisect_left

    def of(found) -> list[dict]:
        starts: list[int] = []
        kept: list[dict] = []
        # spans of one place and length: the first in the list of labels wins
        for s in sorted(found, key=lambda s: (-s["length"], s["start"], s["label"], s["text"])):
            a, b = s["start"], s["start"] + s["length"]
            i = bisect_left(starts, a)
            if (i == len(starts) or starts[i] >= b) and (i == 0 or kept[i - 1]["start"] + kept[i - 1]["length"] <= a):
                starts.insert(i, a)
                kept.insert(i, s)
        return kept

    return spans.map(lambda found: None if found is None else of(found))


def longest_spans(spans: Column) -> Column:
    """The spans that are kept of an array of overlapping ones: longest first, then leftmost, if still free."""
    _free_spans.__annotations__ = {"spans": pd.Series, "return": pd.Series}
    return F.pandas_udf(_free_spans, T.ArrayType(T.StructType.fromDDL(SPAN)))(spans)


def add_span_entities(df: DataFrame, key: str, text: str, phrases: DataFrame, patterns=(), mask_first: bool = False, name: str = "entities") -> DataFrame:
    """Add a map label -> sorted distinct texts, from a phrase table of any size and patterns.

    All matches of all rules are found; over the whole text the longest is kept first, then the leftmost, if no kept one
    overlaps it. Only spans are shuffled, by ``key``, which names rows; blank and null texts have an empty map. Texts that hold the mask are left out.
    """
    c = text_or_empty(F.col(text))
    rows = df.select(key, (mask_redactions(c) if mask_first else c).alias("_c"))
    by_phrase = phrase_spans(rows, key, "_c", phrases)
    by_pattern = rows.select(key, F.inline(pattern_spans(F.col("_c"), patterns)))
    every = by_phrase.unionByName(by_pattern).groupBy(key).agg(F.collect_list(F.struct("start", "length", "label", "text")).alias("_s"))
    kept = F.filter(longest_spans(F.col("_s")), lambda s: ~F.contains(s["text"], F.lit(MASK)))
    pairs = every.select(key, F.explode(kept).alias("s")).select(key, "s.label", "s.text")
    lists = pairs.groupBy(key, "label").agg(F.sort_array(F.collect_set("text")).alias("texts"))
    maps = lists.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "texts")))).alias(name))
    empty = F.from_json(F.lit("{}"), "map<string,array<string>>")
    return df.join(maps, key, "left").withColumn(name, F.coalesce(name, empty))
