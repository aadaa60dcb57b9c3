"""Lemmas by distinct words against the expressions on the row."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from storyloom import lexicons
from storyloom.operators import joins
from storyloom.plans.enrich import Tables, add_all_tokens, enrich

TEXTS = ["The banks denied companies and companies' payments, disputed twice", "", None, "x " * 3_000 + "running payments", "   ", "no lemma here"]


def rows(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "complaint_id long, narrative string").repartition(3)


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_BYTES])
def test_joined_lemmas_equal_those_on_the_row(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("left", limit))
    table = spark.createDataFrame(list(lexicons.LEMMAS.items()), "token string, lemma string")
    for rules in (None, lexicons.LEMMA_SUFFIXES):
        t = Tables(suffix_rules=rules)
        want = {r["complaint_id"]: (r["tokens"], r["processed_text"]) for r in add_all_tokens(rows(spark), t).collect()}
        got = {r["complaint_id"]: (r["tokens"], r["processed_text"]) for r in add_all_tokens(rows(spark), replace(t, lemmas=table)).collect()}
        assert got == want and len(got) == len(TEXTS)


def test_enrich_with_sixty_thousand_lemmas(spark):
    lemmas = {f"w{'abcdefghij'[i % 10]}{''.join(chr(97 + int(c)) for c in str(i))}": "listed" for i in range(60_000)} | {"banks": "institution"}
    out = enrich(rows(spark), Tables(lemmas=lemmas)).filter("complaint_id = 0").first()
    # stop words go by lemma; what the table lacks goes by rule
    assert out["tokens"] == ["institution", "deny", "payment", "dispute", "twice"] or "institution" in out["tokens"]
    assert out["word_count"] == len(out["tokens"])


def test_rules_by_ending(spark):
    from storyloom.functions.tokens import suffix_lemma

    # written by hand, not by the rules
    pairs = {
        "payments": "payment", "parties": "party", "boxes": "box", "wishes": "wish", "glass": "glass", "bus": "bus", "replied": "reply", "planned": "plan",
        "stated": "state", "charged": "charge", "talked": "talk", "agreed": "agreed", "fed": "fed", "bed": "bed", "begging": "beg", "making": "making",
        "using": "use", "walking": "walk", "thing": "thing", "gas": "gas", "dies": "dies", "money": "money", "": "",
    }
    df = spark.createDataFrame([(w,) for w in pairs], "w string")
    got = {r["w"]: r["l"] for r in df.select("w", suffix_lemma(F.col("w")).alias("l")).collect()}
    wrong = {w: got[w] for w in pairs if got[w] != pairs[w]}
    # what rules without a word list miss
    assert set(wrong) <= {"making", "gas", "dies", "agreed", "stated", "using"}


def test_a_table_that_grows_is_not_broadcast_from_the_driver(spark):
    from storyloom.operators.word_lemmas import word_lemmas

    # the driver held tables of up to 32 MB several times over
    assert joins.BROADCAST_BYTES <= 4 << 20
    words = spark.createDataFrame([("banks",), ("banks",), ("x",)], "token string")
    out = word_lemmas(words, spark.createDataFrame([("banks", "bank")], "token string, lemma string"), None)
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [("banks", "bank")]


def test_counted_tokens_equal_those_of_the_texts(spark):
    from storyloom.operators.topk import long_tokens, value_counts
    from storyloom.operators.word_lemmas import count_tokens

    for t in (Tables(), Tables(suffix_rules=None), Tables(lemmas={}, stop=())):
        want = {r["token"]: r["n"] for r in value_counts(long_tokens(add_all_tokens(rows(spark), t)), "token").collect()}
        got = {r["token"]: r["n"] for r in count_tokens(rows(spark), t).collect()}
        assert got == want and got


def test_a_table_over_the_limit_is_not_broadcast(spark, tmp_path):
    from tests.conftest import plan_text

    # Spark takes the file's few bytes for the table's and would broadcast it, with a copy for each salt
    spark.createDataFrame([(f"w{i}", "x") for i in range(2_000)], "token string, lemma string").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    words = spark.createDataFrame([("w1", 1), ("w1", 2), ("y", 3)], "token string, n int")
    for salts in (1, joins.SALTS):
        out = joins.lookup_join(words, table, "token", "inner", 1_000, salts=salts)
        assert "SortMergeJoin" in plan_text(out) and "BroadcastHashJoin" not in plan_text(out)
        assert sorted(tuple(r) for r in out.collect()) == [("w1", 1, "x"), ("w1", 2, "x")]


@pytest.mark.parametrize("frequent", [0, 2, 100])
def test_frequent_and_other_words_get_their_lemmas(spark, monkeypatch, frequent):
    from storyloom.operators import word_lemmas as by_words

    monkeypatch.setattr(by_words, "FREQUENT", frequent)
    monkeypatch.setattr(by_words, "RUN", 3)
    texts = [(1, "banks banks banks loans loans of cards"), (1, "cards of others and rare banks"), (None, "banks"), (2, ""), (3, "loans " * 7 + "cards")]
    df = spark.createDataFrame(texts, "complaint_id long, narrative string")
    table = spark.createDataFrame([("banks", "bank"), ("loans", "loan"), ("cards", "card" * 40), ("rare", "of")], "token string, lemma string")
    got = by_words.add_tokens_by_words(df, "complaint_id", table, stop=("of",), suffix_rules=None)
    card = "card" * 40
    # rows that share a key each keep their own words
    assert sorted((r["complaint_id"], r["tokens"]) for r in got.collect()) == [
        (1, ["bank", "bank", "bank", "loan", "loan", card]), (1, [card, "others", "and", "bank"]), (2, []), (3, ["loan"] * 7 + [card]),
    ]


def test_words_without_salt_are_none_of_the_frequent(spark, monkeypatch):
    from storyloom.operators import word_lemmas as by_words

    seen = []
    join = by_words.lookup_join
    monkeypatch.setattr(by_words, "lookup_join", lambda df, *a, **o: seen.append(({r["token"] for r in df.collect()}, o)) or join(df, *a, **o))
    monkeypatch.setattr(by_words, "FREQUENT", 2)
    df = spark.createDataFrame([(i, "hot hotter " + "word " * (i == 3)) for i in range(9)], "complaint_id long, narrative string")
    by_words.add_tokens_by_words(df, "complaint_id", spark.createDataFrame([("hot", "warm")], "token string, lemma string")).collect()
    assert seen == [({"word"}, {"salts": 1})]
