"""Text-quality job: find the text column, count rule matches, correct the text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from storyloom.lexicons import TEXT_COLUMN_NAMES


@dataclass(frozen=True)
class QualityRule:
    """Issue type, Java pattern, and its replacement (``$1`` for groups)."""

    kind: str
    pattern: str
    replacement: str


QUALITY_RULES = [
    QualityRule("doubled_word", r"\b([A-Za-z]+) \1\b", "$1"),
    QualityRule("doubled_space", r"  +", " "),
    QualityRule("space_before_comma", r"(?<! ) +,", ","),
    QualityRule("repeated_mark", r"!!+", "!"),
]


def mean_lengths(df: DataFrame) -> DataFrame:
    """Mean non-null length of every string column, with its position."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        raise ValueError("no text column")
    one = df.agg(*[F.coalesce(F.avg(F.length(n)), F.lit(0.0)).alias(n) for n in names])
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.col(n).alias("mean_length"))
            for i, n in enumerate(names)
        ]
    )
    return one.select(F.inline(cells))


def text_column(df: DataFrame, preferred=TEXT_COLUMN_NAMES) -> DataFrame:
    """The text column as a one-row table: a preferred name, else the longest on average."""
    for name in preferred:
        if name in df.columns:
            return df.sparkSession.createDataFrame([(name,)], "column string")
    ranked = mean_lengths(df).orderBy(F.desc("mean_length"), F.asc("position"))
    return ranked.limit(1).select("column")


def detect_text_column(df: DataFrame, preferred=TEXT_COLUMN_NAMES) -> str:
    """Name of the text column. Reads the table once unless a preferred name is present."""
    return text_column(df, preferred).first()["column"]


def correct_texts(df: DataFrame, text: str, rules=QUALITY_RULES) -> DataFrame:
    """Add corrected text, error count and the type of each error; null texts are dropped.

    Matches are counted in the text as given; corrections are applied one rule after
    another.
    """
    c = F.col(text)
    filled = F.trim(c) != ""
    corrected = c
    for r in rules:
        corrected = F.regexp_replace(corrected, r.pattern, r.replacement)
    kinds = F.flatten(
        F.array(*[F.array_repeat(F.lit(r.kind), F.regexp_count(c, F.lit(r.pattern))) for r in rules])
    )
    empty = F.array().cast("array<string>")
    return (
        df.dropna(subset=[text])
        .withColumn("tipos_errores", F.when(filled, kinds).otherwise(empty))
        .withColumns(
            {
                "texto_corregido": F.when(filled, corrected).otherwise(c),
                "cantidad_errores": F.size("tipos_errores"),
            }
        )
    )
