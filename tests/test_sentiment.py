"""The array scorer against a plain restatement of the published rules."""

import math
import random
import string

import pytest
from pyspark.sql import functions as F

from storyloom import lexicons
from storyloom.functions import sentiment

LEX = lexicons.SENTIMENT


def words_of(text):
    out = []
    for chunk in text.split():
        bare = chunk.strip(string.punctuation)
        out.append(chunk if len(bare) <= 2 else bare)
    return out


def booster(word, valence, caps):
    scalar = LEX.boosters.get(word.lower(), 0.0)
    if scalar:
        scalar = -scalar if valence < 0 else scalar
        if word.isupper() and caps:
            scalar += 0.733 if valence > 0 else -0.733
    return scalar


def negative(word):
    return word in LEX.negations or "n't" in word


def word_score(words, low, i, caps):
    w, listed = low[i], LEX.valence
    v = listed[w]
    if w == "no" and i + 1 < len(low) and low[i + 1] in listed:
        v = 0.0
    if (i > 0 and low[i - 1] == "no") or (i > 1 and low[i - 2] == "no") or (
        i > 2 and low[i - 3] == "no" and low[i - 1] in ("or", "nor")
    ):
        v = listed[w] * -0.74
    if words[i].isupper() and caps:
        v += 0.733 if v > 0 else -0.733
    for k in range(3):
        if i > k and low[i - k - 1] not in listed:
            v += booster(words[i - k - 1], v, caps) * (1.0, 0.95, 0.9)[k]
            before = low[i - k - 1]
            if k == 1 and before == "never" and low[i - 1] in ("so", "this"):
                v *= 1.25
            elif k == 1 and before == "without" and low[i - 1] == "doubt":
                pass
            elif k == 2 and ((before == "never" and low[i - 2] in ("so", "this")) or low[i - 1] in ("so", "this")):
                v *= 1.25
            elif k == 2 and before == "without" and "doubt" in low[i - 2 : i]:
                pass
            elif negative(before):
                v *= -0.74
            if k == 2:
                phrase = lambda a, b: " ".join(low[i + a : i + b])
                for p in (phrase(-1, 1), phrase(-2, 1), phrase(-2, 0), phrase(-3, 0), phrase(-3, -1)):
                    if p in LEX.idioms:
                        v = LEX.idioms[p]
                        break
                for p in (phrase(0, 2), phrase(0, 3)):
                    v = LEX.idioms.get(p, v)
                v += sum(LEX.phrase_boosters.get(p, 0.0) for p in (phrase(-3, 0), phrase(-3, -1), phrase(-2, 0)))
    if i > 0 and low[i - 1] == "least" and low[i - 1] not in listed and not (i > 1 and low[i - 2] in ("at", "very")):
        v *= -0.74
    return v


def score(text):
    words = words_of(text)
    if not words:
        return 0.0, 0.0, 1.0, 0.0
    low = [w.lower() for w in words]
    caps = 0 < sum(w.isupper() for w in words) < len(words)
    values = []
    for i, w in enumerate(low):
        skip = w in LEX.boosters or (w == "kind" and low[i + 1 : i + 2] == ["of"]) or w not in LEX.valence
        values.append(0.0 if skip else word_score(words, low, i, caps))
    if LEX.contrast in low:
        turn = low.index(LEX.contrast)
        values = [v * (0.5 if i < turn else 1.5 if i > turn else 1.0) for i, v in enumerate(values)]
    marks = text.count("?")
    emphasis = min(text.count("!"), 4) * 0.292 + (0 if marks <= 1 else marks * 0.18 if marks <= 3 else 0.96)
    total = sum(values)
    total += math.copysign(emphasis, total) if total else 0
    pos = sum(v + 1 for v in values if v > 0)
    neg = sum(1 - v for v in values if v < 0)
    zero = sum(v == 0 for v in values)
    pos, neg = pos + (emphasis if pos > neg else 0), neg + (emphasis if neg > pos else 0)
    weight = pos + neg + zero
    return total / math.sqrt(total * total + 15), neg / weight, zero / weight, pos / weight


def random_texts(n):
    rng = random.Random(11)
    pool = (
        list(LEX.valence) + list(LEX.boosters)[:12] + "never so this without doubt least at very but no or nor not "
        "don't kind of sort of bus stop to die for yeah right upper hand the a bank".split() * 2
    )
    out = []
    for _ in range(n):
        words = [rng.choice(pool) for _ in range(rng.randint(1, 14))]
        words = [w.upper() if rng.random() < 0.12 else w for w in words]
        words = [w + rng.choice(["", "", "", "!", "?", ",", "!!", "??"]) for w in words]
        out.append(" ".join(words))
    return out


def test_valence_matches_plain_rules(spark):
    texts = random_texts(1500) + ["", "   \t ", "GOOD", "good BAD!!", "not very good", "kind of bad", "!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, narrative string")
    rows = sentiment.add_sentiment(df).orderBy("i").collect()
    for r, t in zip(rows, texts):
        got = (r.vader_compound, r.vader_neg, r.vader_neu, r.vader_pos)
        assert got == pytest.approx(score(t), abs=6e-4), t
        assert 0.99 < r.vader_neg + r.vader_neu + r.vader_pos < 1.01


def test_null_and_blank_text(spark):
    df = spark.createDataFrame([(None,), (" ",)], "narrative string")
    for r in sentiment.add_sentiment(df).collect():
        assert r[1:] == (0.0, 0.0, 1.0, 0.0, "Neutral", 0.0, 0.0, "Neutral")


@pytest.mark.parametrize(
    "text, polarity, subjectivity",
    [
        ("good", 0.7, 0.6), ("very good", 0.91, 0.78), ("not good", -0.35, 0.6),
        ("not very good", -0.7 / 1.3 / 2, 0.6 / 1.3), ("good bad", 0.0, 0.635), ("nothing here", 0.0, 0.0),
        ("extremely worst", -1.0, 1.0),
    ],
)
def test_tone(spark, text, polarity, subjectivity):
    df = spark.createDataFrame([(text,)], "narrative string")
    r = sentiment.add_sentiment(df).first()
    assert (r.textblob_polarity, r.textblob_subjectivity) == pytest.approx((polarity, subjectivity))


def test_label_bounds(spark):
    points = [-1.0, -0.5, -0.49, -0.3, -0.29, -0.06, -0.05, 0.0, 0.05, 0.06, 0.29, 0.3, 0.49, 0.5, 1.0, None]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    rows = df.select("p", sentiment.vader_label(F.col("p")).alias("v"), sentiment.textblob_label(F.col("p")).alias("t")).collect()
    a, b, c, d, e = lexicons.SENTIMENT_LABELS
    assert [r.v for r in rows] == [a, a, b, b, b, b, c, c, c, d, d, d, d, e, e, None]
    assert [r.t for r in rows] == [a, a, a, a, b, b, c, c, c, d, d, e, e, e, e, None]
    assert sentiment and df.select(sentiment.vader_label(F.lit(0.9), list("abcde"))).first()[0] == "e"
