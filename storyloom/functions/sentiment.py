"""Both sentiment scorers as array expressions over the words of one row.

The valence rules are those of the published rule-based model (Hutto and Gilbert,
2014); the tone rules average word polarity and subjectivity. Word tables are
parameters. Neighbouring words are reached by position in the row's own arrays,
so scoring needs no explode, no window and no shuffle of the token stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from storyloom import lexicons
from storyloom.functions.let import let
from storyloom.functions.lookup import hash_lookup
from storyloom.functions.symbols import MARK, describe_symbols
from storyloom.functions.text import plain_spaces, text_or_empty

# Fixed values of the published valence model.
CAPS_STEP = 0.733
NEGATE = -0.74
DISTANCE = (1.0, 0.95, 0.9)
NORM = 15.0
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_MARK = "valence double, booster double, negation boolean, polarity double, subjectivity double, intensity double"
MARK_TYPE = f"struct<{_MARK.replace(' double', ':double').replace(' boolean', ':boolean')}>"


def marks_table(lex: lexicons.SentimentLexicon) -> dict:
    """One record per word of any table."""
    table: dict[str, dict] = {}
    for word, v in lex.valence.items():
        table.setdefault(word, {})["valence"] = float(v)
    for word, v in lex.boosters.items():
        table.setdefault(word, {})["booster"] = float(v)
    for word in lex.negations:
        table.setdefault(word, {})["negation"] = True
    for word, (polarity, subjectivity) in lex.tone.items():
        table.setdefault(word, {}).update(polarity=float(polarity), subjectivity=float(subjectivity))
    for word, v in lex.intensity.items():
        table.setdefault(word, {})["intensity"] = float(v)
    return table


def words_of(text: Column) -> Column:
    """Space-separated words without edge punctuation, unless two or fewer characters remain."""
    chunks = F.array_remove(F.split(F.translate(plain_spaces(text_or_empty(text)), "\t\n\x0b\f\r", " " * 5), " "), "")

    def strip(w):
        bare = F.btrim(w, F.lit(PUNCTUATION))
        return F.when(F.length(bare) <= 2, w).otherwise(bare)

    return F.transform(chunks, strip)


def _is_upper(w: Column) -> Column:
    return (w == F.upper(w)) & (w != F.lower(w))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


@dataclass(frozen=True)
class Words:
    """The word arrays of one text."""

    shown: Column  # as written
    lower: Column
    marks: Column  # table record per word, null for most
    caps: Column  # some words in capitals, but not all
    hits: Column  # positions of the words that have a record
    own: Column | None = None  # per word, whether it is the text's own and not of a symbol's name; None: all are


def _word_valence(i: Column, t: Words, lex: lexicons.SentimentLexicon, phrase, phrase_booster) -> Column:
    """Valence of the listed word at ``i`` after capitals, boosters, negations and idioms."""
    word = lambda k: F.get(t.lower, i + k)
    mark = lambda k: F.get(t.marks, i + k)
    upper = lambda k: t.caps & _is_upper(F.get(t.shown, i + k))
    listed = lambda k: mark(k)["valence"].isNotNull()

    base = mark(0)["valence"]
    no_before = (
        (word(-1) == "no")
        | (word(-2) == "no")
        | ((word(-3) == "no") & word(-1).isin("or", "nor"))
    )
    start = (
        F.when(F.coalesce(no_before, F.lit(False)), base * NEGATE)
        .when(F.coalesce((word(0) == "no") & listed(1), F.lit(False)), F.lit(0.0))
        .otherwise(base)
    )
    start = let(
        start,
        lambda v: F.when(upper(0), F.when(v > 0, v + CAPS_STEP).otherwise(v - CAPS_STEP)).otherwise(v),
    )

    def boost(v, k):
        # k is 0, 1 or 2 words between the booster and the word
        scalar = mark(-k - 1)["booster"]
        signed = F.when(v < 0, -scalar).otherwise(scalar)
        loud = F.when(v > 0, signed + CAPS_STEP).otherwise(signed - CAPS_STEP)
        return F.coalesce(
            F.when(upper(-k - 1), loud).otherwise(signed) * F.get(F.array(*map(F.lit, DISTANCE)), k), F.lit(0.0)
        )

    def negates(k):
        return F.coalesce(mark(-k - 1)["negation"], F.lit(False)) | F.coalesce(
            F.contains(word(-k - 1), F.lit("n't")), F.lit(False)
        )

    so_this = lambda k: F.coalesce(word(k).isin("so", "this"), F.lit(False))
    never = lambda k: F.coalesce(word(k) == "never", F.lit(False))
    without = lambda k: F.coalesce(word(k) == "without", F.lit(False))
    doubt = lambda k: F.coalesce(word(k) == "doubt", F.lit(False))

    def negation_factor(k):
        plain = F.when(negates(k), NEGATE).otherwise(1.0)
        two = F.when(never(-2) & so_this(-1), 1.25).when(without(-2) & doubt(-1), 1.0).otherwise(plain)
        three = (
            F.when((never(-3) & so_this(-2)) | so_this(-1), 1.25)
            .when(without(-3) & (doubt(-2) | doubt(-1)), 1.0)
            .otherwise(plain)
        )
        return F.when(k == 1, two).when(k == 2, three).otherwise(plain)

    def step(v, k):
        active = (i > k) & ~listed(-k - 1)
        factor = negation_factor(k)
        added = (v + boost(v, k)) * factor
        if lex.idioms or lex.phrase_boosters:
            added = let(
                added, lambda x: F.when(k == 2, _idioms(x, i, t, phrase, phrase_booster)).otherwise(x)
            )
        return F.when(active, added).otherwise(v)

    # one step per distance 0, 1, 2
    scored = F.aggregate(F.array(F.lit(0), F.lit(1), F.lit(2)), start, step)
    least = (
        F.coalesce((word(-1) == "least") & ~listed(-1), F.lit(False))
        & ~F.coalesce(word(-2).isin("at", "very"), F.lit(False))
    )
    return scored * F.when(least, NEGATE).otherwise(1.0)


def _idioms(v: Column, i: Column, t: Words, phrase, phrase_booster) -> Column:
    def words(first, count):
        return F.array_join(F.slice(t.lower, i + first + 1, F.lit(count)), " ")

    # at this point three words precede position i
    before = [phrase(words(f, n)) for f, n in ((-1, 2), (-2, 3), (-2, 2), (-3, 3), (-3, 2))]
    after = [phrase(words(0, 3)), phrase(words(0, 2))]
    replaced = F.coalesce(*after, *before, v)
    extra = [F.coalesce(phrase_booster(words(f, n)), F.lit(0.0)) for f, n in ((-3, 3), (-3, 2), (-2, 2))]
    return replaced + extra[0] + extra[1] + extra[2]


def _valence(text: Column, t: Words, lex: lexicons.SentimentLexicon) -> Column:
    """Struct of ``compound, neg, neu, pos``."""
    phrase = hash_lookup(lex.idioms, "double")
    phrase_booster = hash_lookup(lex.phrase_boosters, "double")
    contrast = F.array_position(t.lower, lex.contrast).cast("int") - 1

    def scored(i):
        mark, word = F.get(t.marks, i), F.get(t.lower, i)
        kind_of = F.coalesce((word == "kind") & (F.get(t.lower, i + 1) == "of"), F.lit(False))
        return mark["valence"].isNotNull() & mark["booster"].isNull() & ~kind_of

    def score(i):
        side = F.when(contrast < 0, 1.0).when(i < contrast, 0.5).when(i > contrast, 1.5).otherwise(1.0)
        return _word_valence(i, t, lex, phrase, phrase_booster) * side

    questions = _count(text, "?")
    emphasis = F.least(_count(text, "!"), F.lit(4)) * 0.292 + F.when(questions <= 1, 0.0).when(
        questions <= 3, questions * 0.18
    ).otherwise(0.96)

    def totals(scores):
        add = lambda keep, shift: F.aggregate(
            F.filter(scores, keep), F.lit(0.0), lambda a, v: a + v + F.lit(shift)
        )
        rest = F.size(t.shown) - F.size(F.filter(scores, lambda v: v != 0))
        return F.struct(
            add(lambda v: v.isNotNull(), 0.0).alias("sum"),
            add(lambda v: v > 0, 1.0).alias("pos"),
            (-add(lambda v: v < 0, -1.0)).alias("neg"),
            rest.cast("double").alias("neu"),
            emphasis.alias("emph"),
        )

    def emphasised(q):
        pos, neg, emph = q["pos"], q["neg"], q["emph"]
        return F.struct(
            (q["sum"] + F.signum(q["sum"]) * emph).alias("sum"),
            (pos + F.when(pos > neg, emph).otherwise(0.0)).alias("pos"),
            (neg + F.when(pos < neg, emph).otherwise(0.0)).alias("neg"),
            q["neu"].alias("neu"),
        )

    def shares(q):
        weight = q["pos"] + q["neg"] + q["neu"]
        share = lambda x, blank: F.when(weight > 0, F.round(x / weight, 3)).otherwise(blank)
        return F.struct(
            F.round(q["sum"] / F.sqrt(q["sum"] * q["sum"] + NORM), 4).alias("compound"),
            share(q["neg"], 0.0).alias("neg"),
            share(q["neu"], 1.0).alias("neu"),
            share(q["pos"], 0.0).alias("pos"),
        )

    scores = F.transform(F.filter(t.hits, scored), score)
    return let(let(let(scores, totals), emphasised), shares)


def _tone(t: Words) -> Column:
    """Struct of ``polarity, subjectivity``: means over the rated words."""

    def mark(i):
        return F.get(t.marks, i) if t.own is None else F.when(F.get(t.own, i), F.get(t.marks, i))

    def rated(i):
        m, before, earlier = (mark(i - k) for k in range(3))
        plain = F.coalesce(before["intensity"], F.lit(1.0))
        negated = F.coalesce(before["negation"], F.lit(False)) | F.coalesce(
            before["intensity"].isNotNull() & earlier["negation"], F.lit(False)
        )
        factor = F.when(negated, 1.0 / plain).otherwise(plain)
        polarity = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), m["polarity"] * factor))
        return F.struct(
            (polarity * F.when(negated, -0.5).otherwise(1.0)).alias("p"),
            F.least(F.lit(1.0), m["subjectivity"] * factor).alias("s"),
        )

    def means(found):
        mean = lambda name: F.when(
            F.size(found) > 0, F.aggregate(found, F.lit(0.0), lambda a, r: a + r[name]) / F.size(found)
        ).otherwise(0.0)
        return F.struct(mean("p").alias("polarity"), mean("s").alias("subjectivity"))

    listed = F.filter(t.hits, lambda i: mark(i)["polarity"].isNotNull())
    return let(F.transform(listed, rated), means)


def five_way(score: Column, strong: float, labels=lexicons.SENTIMENT_LABELS) -> Column:
    """Label by the bounds -strong, -0.05, 0.05 and strong."""
    return (
        F.when(score <= -strong, labels[0])
        .when(score < -0.05, labels[1])
        .when(score <= 0.05, labels[2])
        .when(score < strong, labels[3])
        .when(score.isNotNull(), labels[4])
    )


def vader_label(compound: Column, labels=lexicons.SENTIMENT_LABELS) -> Column:
    return five_way(compound, 0.5, labels)


def textblob_label(polarity: Column, labels=lexicons.SENTIMENT_LABELS) -> Column:
    return five_way(polarity, 0.3, labels)


def sentiment_of(
    text: Column,
    lex: lexicons.SentimentLexicon = lexicons.SENTIMENT,
    labels=lexicons.SENTIMENT_LABELS,
) -> Column:
    """Struct of the eight sentiment fields of a text.

    Symbols of ``lex.symbols`` count as the words of their names for the valence scorer; the tone scorer passes
    over those words. The private-use character U+E000 tells them apart and is dropped from texts.
    """
    find = hash_lookup(marks_table(lex), MARK_TYPE)

    def of_words(c, shown, lower, marks, own):
        hits = F.filter(F.transform(marks, lambda m, i: F.when(m.isNotNull(), i)), lambda i: i.isNotNull())
        # only a listed word asks for capitals
        caps = lambda h: (F.size(h) > 0) & F.exists(shown, lambda w: ~_is_upper(w)) & F.exists(shown, _is_upper)
        return let(
            hits,
            lambda h: let(caps(h), lambda some: _both(c, Words(shown, lower, marks, some, h, own))),
        )

    def _both(c, t):
        return let(F.struct(_valence(c, t, lex).alias("v"), _tone(t).alias("t")), fields)

    def fields(x):
        compound, polarity = x["v"]["compound"], x["t"]["polarity"]
        return F.struct(
            compound.alias("vader_compound"),
            x["v"]["neg"].alias("vader_neg"),
            x["v"]["neu"].alias("vader_neu"),
            x["v"]["pos"].alias("vader_pos"),
            vader_label(compound, labels).alias("vader_label"),
            polarity.alias("textblob_polarity"),
            x["t"]["subjectivity"].alias("textblob_subjectivity"),
            textblob_label(polarity, labels).alias("textblob_label"),
        )

    def marked(c, shown, own=None):
        return let(
            F.transform(shown, F.lower),
            lambda lower: let(F.transform(lower, find), lambda marks: of_words(c, shown, lower, marks, own)),
        )

    def told_apart(c, raw):
        own = F.transform(raw, lambda w: ~F.startswith(w, F.lit(MARK)))
        plain = F.transform(raw, lambda w: F.translate(w, MARK, ""))
        return let(own, lambda o: let(plain, lambda shown: marked(c, shown, o)))

    if not lex.symbols:
        return let(text_or_empty(text), lambda c: let(words_of(c), lambda shown: marked(c, shown)))
    described = describe_symbols(text_or_empty(text), lex.symbols, MARK)
    return let(described, lambda c: let(words_of(c), lambda raw: told_apart(c, raw)))


SENTIMENT_COLUMNS = (
    "vader_compound", "vader_neg", "vader_neu", "vader_pos", "vader_label",
    "textblob_polarity", "textblob_subjectivity", "textblob_label",
)


def add_sentiment(
    df: DataFrame,
    text: str = "narrative",
    lex: lexicons.SentimentLexicon = lexicons.SENTIMENT,
    labels=lexicons.SENTIMENT_LABELS,
) -> DataFrame:
    """Add the eight sentiment columns."""
    scored = df.withColumn("_s", sentiment_of(F.col(text), lex, labels))
    return scored.withColumns({c: F.col("_s")[c] for c in SENTIMENT_COLUMNS}).drop("_s")
