"""Complaint-shaped view of the sample tables, and term tables that occur in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from storyloom.functions.entities import Rule, phrases
from storyloom.lexicons import SentimentLexicon
from storyloom.operators.quality import QualityRule
from storyloom.plans.enrich import Tables
from storyloom.session import parts_for, path_bytes, spread

STOP = tuple("the of and to a in is that it for was on with be by as this are at from".split())
LEMMAS = {"thorreou": "thorre", "ererthre": "erer", "hering": "her"}
LEGAL_TERMS = ("license", "released", "token", "apache", "worthless")
TOKEN_TERMS = ("license", "apache", "token", "released", "worthless", "stupid", "idiot", "copyright")

RULES = (
    phrases("LAW", ["MIT License", "Apache License"])
    + [
        Rule("LAW", r"(?i:version)\s+\d++(?:\.\d++)*+", regex=True),
        Rule("MONEY", r"\d{16}", regex=True),
        Rule("NET", r"\d{1,3}(?:\.\d{1,3}){3}", regex=True),
    ]
    + phrases("ORG", ["Rewh", "Than", "Is"])
    + phrases("GPE", ["ononst", "inoran"])
)
LAW_NAMES = {"Apache License": "APACHE", "MIT License": "MIT"}
ORG_NOISE = ("Is",)

LEXICON = SentimentLexicon(
    valence={"worthless": -1.9, "stupid": -2.4, "idiot": -2.3, "thatin": 1.5, "hehely": 2.0},
    tone={
        "worthless": (-0.8, 0.9), "stupid": (-0.8, 1.0), "idiot": (-0.8, 0.8),
        "thatin": (0.3, 0.4), "hehely": (0.5, 0.6),
    },
    boosters={"rewh": 0.293, "orre": -0.293},
    intensity={"rewh": 1.3, "orre": 0.7},
    negations=frozenset(["ononst"]),
    contrast="orantion",
)

# Words of symbols; those in the lexicon count for the valence scorer.
SYMBOLS = {
    "😂": "hehely face", "😡": "worthless", "❤": "thatin heart", "❤️‍🔥": "heart on fire", "👋": "waving hand",
    "👋🏽": "toned hand", "👨‍👩‍👧": "family", "👨": "man",
}
# Planted by the id's remainder: texts in front of and behind the narrative.
PLANTED = (("😂", ""), ("", " 😡😡"), ("❤️‍🔥 ", "❤"), ("👨‍👩‍👧👨 ", " 👋🏽"), ("", ""), ("😂😂 ", "👋.😡"))


def with_symbols(text, key):
    at = F.pmod(key, F.lit(len(PLANTED)))
    side = lambda i: F.element_at(F.array(*(F.lit(p[i]) for p in PLANTED)), (at + 1).cast("int"))
    return F.concat(side(0), text, side(1))


QUALITY = [
    QualityRule("doubled_word", r"\b([A-Za-z]+) \1\b", "$1"),
    QualityRule("doubled_space", r"  +", " "),
    QualityRule("space_before_comma", r"(?<! ) +,", ","),
    QualityRule("repeated_mark", r"!!+", "!"),
]

TABLES = Tables(
    stop=STOP, lemmas=LEMMAS, suffix_rules=None, rules=tuple(RULES), lexicon=LEXICON, legal_terms=LEGAL_TERMS,
)

# Personal data that stands in for redactions.
REDACT = r"\S+@\S+|\b\d{16}\b|\b\d{1,3}(\.\d{1,3}){3}\b"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    return spread(spark.read.parquet(path), "doc_id", parts_for(spark, path_bytes(spark, path)))


def complaints(spark: SparkSession, sf_dir: str, joined: bool = False) -> DataFrame:
    """The view. ``joined`` adds state and response, which need two joins."""
    d = documents(spark, sf_dir)
    n = F.col("doc_id")
    cols = [
        n.alias("complaint_id"),
        F.col("text").alias("narrative"),
        F.col("source").alias("product"),
        F.col("lang").alias("issue"),
        F.concat(F.lit("C"), (n * 13 % 11).cast("string")).alias("company"),
        F.date_add(F.lit("2015-01-01").cast("date"), (n * 37 % 3650).cast("int")).cast("string").alias("date_received"),
        F.when(n % 9 == 0, "No").otherwise("Yes").alias("timely"),
    ]
    if not joined:
        return d.select(*cols)
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("doc_id", "_labelled")
    response = (
        F.when(F.col("_labelled").isNull(), None)
        .when((F.col("quality") == 1) & (F.col("toxic") == 0), "Closed with explanation")
        .when(F.col("quality") == 1, "Closed with monetary relief")
        .when(F.col("toxic") == 1, "Untimely response")
        .otherwise("In progress")
    )
    # nation has 25 rows at any scale; labels grow with documents, so that join is left to AQE
    return (
        d.join(labels, d.doc_id == labels._labelled, "left")
        .join(F.broadcast(nation), F.col("doc_id") % 27 == F.col("n_nationkey"), "left")
        .select(*cols, F.col("n_name").alias("state"), response.alias("response"))
    )


def redacted(df: DataFrame) -> DataFrame:
    return df.withColumn("narrative", F.regexp_replace("narrative", REDACT, "XXXX"))
