"""Phrase tables and span choice against the alternation and plain Python."""

import random
import re

from pyspark.sql import functions as F

from storyloom.functions.entities import DEFAULT_RULES, EXTENDED_RULES, Rule, add_entities, phrases
from storyloom.operators.phrases import add_span_entities, is_phrase, phrase_table

TEXTS = [
    "I wrote to Bank of America and Equifax about Section 609 of the Fair Credit Reporting Act.",
    "Chase, Chase Bank and xChase, Chase_1; New York and New  York; $ 5,000.50 million FCRA FCRAs",
    "section two of West Virginia's law, [MASK] Capital One", "", None, "   ", "ééEquifax Equifaxé Equifax", "no entity " * 3_000 + "Equifax",
]


def rows(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id long, narrative string").repartition(3)


def maps(df):
    return {r["id"]: r["entities"] for r in df.select("id", "entities").collect()}


def test_default_rules_as_the_alternation(spark):
    for rules in (DEFAULT_RULES, EXTENDED_RULES):
        want = maps(add_entities(rows(spark), rules=rules))
        got = maps(add_span_entities(rows(spark), "id", "narrative", phrase_table(spark, rules), [r for r in rules if not is_phrase(r)]))
        assert got == want


def test_longest_span_wins_over_the_whole_text(spark):
    # the leftmost match crosses a longer one, which crosses a still longer one
    rules = phrases("A", ["one two", "five"]) + phrases("B", ["two three four"]) + [Rule("C", r"four (?:five|six)", regex=True), Rule("D", r"four", regex=True)]
    texts = ["one two three four five", "one two three four", "one two. four five", "four four six"]
    got = maps(add_span_entities(rows(spark, texts), "id", "narrative", phrase_table(spark, rules), rules[3:]))
    assert got == {0: {"B": ["two three four"], "A": ["five"]}, 1: {"B": ["two three four"]}, 2: {"A": ["one two"], "C": ["four five"]}, 3: {"D": ["four"], "C": ["four six"]}}


def test_large_table(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    names = sorted({" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(30_000)})
    texts = [" ".join(rng.choice((word(), rng.choice(names))) for _ in range(200)) for _ in range(20)]
    table = spark.createDataFrame([("N", n) for n in names], "label string, phrase string")
    got = maps(add_span_entities(rows(spark, texts), "id", "narrative", table))
    known, want = set(names), {}
    for i, t in enumerate(texts):
        words = [(m.start(), m.end()) for m in re.finditer(r"\w+", t)]
        spans = [(a, words[j + k][1]) for j, (a, _) in enumerate(words) for k in range(3) if j + k < len(words) and t[a : words[j + k][1]] in known]
        kept = []
        for a, b in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if all(b <= x or y <= a for x, y in kept):
                kept.append((a, b))
        want[i] = {"N": sorted({t[a:b] for a, b in kept})}
    assert got == want
    assert add_span_entities(rows(spark, texts), "id", "narrative", table.limit(0)).filter(F.size("entities") > 0).count() == 0


def test_places_in_long_texts(spark):
    from storyloom.operators.phrases import phrase_spans

    words = [f"w{i % 7}" for i in range(3_000)]
    text = " - ".join(words) + " the end"
    table = spark.createDataFrame([("X", "the end"), ("Y", "w5 - w6")], "label string, phrase string")
    found = phrase_spans(rows(spark, [text, " ..", "", "the end"]), "id", "narrative", table).collect()
    assert sum(r["text"] == "the end" for r in found) == 2
    starts = sorted(r["start"] for r in found if r["label"] == "Y")
    assert starts == [i for i in range(len(text)) if text.startswith("w5 - w6", i)]


def test_a_place_adds_up_few_pieces():
    from storyloom.operators import phrases

    # it was 128: each word of a text put 64 pieces together on average
    assert phrases.BLOCK <= 16
