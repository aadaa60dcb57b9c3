"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storyloom.session import scratch_dir

# A word is a run of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def folded_words(text: str | None) -> list[bytes]:
    """The words of a text as lower-cased (A-Z) UTF-8; ``bytes.split`` cuts at exactly the six blanks."""
    return text.encode("utf-8").translate(_FOLD).split() if text else []


def digest(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes: together a 128-bit key of the columns, never null."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    Cuts the lineage: what was written survives the loss of executors, and later
    jobs read files in place of running the plan again.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_pieces(frame: pd.DataFrame, weight: pd.Series, limit: int) -> Iterator[pd.DataFrame]:
    """Cut a frame into runs of rows whose weights sum to about ``limit``; no row is left out."""
    if len(frame) == 0:
        return
    run = (weight.to_numpy(dtype=np.int64).cumsum() - 1) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), len(frame)]
    for a, b in zip(cuts, cuts[1:]):
        yield frame.iloc[a:b]


def map_texts(
    df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, text: str = "text", limit: int = 2_000_000
) -> DataFrame:
    """``mapInPandas`` over rows in pieces of about ``limit`` characters, so that memory follows the longest text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch[text].map(lambda t: len(t) if t else 0) + 16
            for piece in in_pieces(batch, size, limit):
                yield work(piece)

    return df.mapInPandas(run, schema)


def scale_count(total: int, per_part: int, least: int = 1) -> int:
    """Parts needed for ``total`` at ``per_part`` each."""
    return max(least, -(-int(total or 0) // per_part))
