import re
import unicodedata
from dataclasses import replace

from pyspark.sql import functions as F

from storyloom.functions.sentiment import sentiment_of
from storyloom.functions.symbols import describe_symbols, symbol_names, tree_pattern
from storyloom.lexicons import SENTIMENT

TABLE = {
    "😂": "face with tears of joy", "❤": "red heart", "❤️‍🔥": "heart on fire", "👋": "waving hand", "👋🏽": "a hand",
    "👨": "man", "👨‍👩‍👧": "family", ":-)": "smile", ":-))": "broad smile",
}


def described(spark, texts, names=TABLE):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.d for r in rows.select("i", describe_symbols(F.col("t"), names).alias("d")).orderBy("i").collect()]


def test_longest_entry_and_spaces(spark):
    cases = {
        "so 😂 it is": "so face with tears of joy it is",
        "so😂it": "so face with tears of joyit",
        "😂😂": "face with tears of joy face with tears of joy",
        "❤️‍🔥!": "heart on fire!",
        "❤️ ok": "red heart ok",
        "❤‍x": "red heartx",
        "hi 👋🏽": "hi a hand",
        "hi 👋🏿.": "hi waving hand: dark skin tone.",
        "👨‍👩‍👧 👨": "family man",
        "a:-))) b:-( :": "a broad smile) b:-( :",
        "❤️️️️️️️️️️️️ z": "red heart z",
        "nothing": "nothing", "": "", "🙃": "🙃",
    }
    assert described(spark, list(cases)) == list(cases.values())
    assert described(spark, [None, "x" * 200_000 + "😂"]) == [None, "x" * 200_000 + " face with tears of joy"]
    assert described(spark, ["😂"], {}) == ["😂"]


def test_the_tree_finds_what_an_alternation_by_length_finds():
    keys = [*TABLE, "ab", "abc", "b", "abcd"]
    one = "|".join(map(re.escape, sorted(keys, key=len, reverse=True)))
    tree = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), tree_pattern(keys))
    text = "abcabcdabb:-):-)):-👋👋🏽❤❤️❤️‍🔥👨‍👩👨‍👩‍👧"
    assert re.findall(tree, text) == re.findall(one, text)


def test_names_by_rule():
    names = symbol_names()
    assert names["😂"] == "face with tears of joy" and names["\U0001F3FD"] == "medium skin tone"
    assert all(unicodedata.name(k) for k in names)


def test_valence_reads_names_and_tone_does_not(spark):
    lex = replace(SENTIMENT, symbols={"😂": "good love", "😡": "terrible"})
    texts = ["it was 😂 then", "it was good love then", "😡 great service", "GREAT 😡!", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in rows.select("i", sentiment_of(F.col("t"), lex).alias("s")).orderBy("i").collect()]
    plain = [r.s for r in rows.select("i", sentiment_of(F.col("t"), replace(lex, symbols={})).alias("s")).orderBy("i").collect()]
    assert got[0].vader_compound == got[1].vader_compound > 0
    assert got[0].textblob_polarity == 0 < got[1].textblob_polarity
    assert [g.textblob_polarity for g in got] == [p.textblob_polarity for p in plain]
    assert got[2].vader_compound < plain[2].vader_compound and got[4] == got[5]
