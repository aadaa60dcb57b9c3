"""A training-data pipeline over ``documents``: toxicity, line dedup, near-dedup, mixing, SentencePiece."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storyloom.llm.common import read_table, stored
from storyloom.llm.op4_mixing import mixed
from storyloom.llm.op5_toxicity import without_toxic
from storyloom.llm.op6_simhash import keep_one
from storyloom.llm.op7_line_dedup import without_shared_lines
from storyloom.llm.op10_sentencepiece import segmentations


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that other documents also hold stay in the one with the smallest id only."""
    return without_shared_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose SimHash fingerprints (3-word shingles) link at 3 or fewer bits the smallest id stays."""
    return keep_one(docs, words=3, radius=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them."""
    return mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, encoded; ids decode to the text."""
    return segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

# The toxicity stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next one reads them.

    Null and empty texts pass the toxicity stage if the base rate scores below 0.5, count as copies of each other in the
    near-dedup stage, and have no words for the mix to take, so they end there. Null ids, repeated rows and further columns
    are as the stages' operators say; empty tables give an empty result.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
