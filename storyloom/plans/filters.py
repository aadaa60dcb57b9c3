"""Row filters and filter options shared by all marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from storyloom import lexicons


@dataclass(frozen=True)
class Filters:
    """Lists of accepted values and a closed year range; an empty list or None means all."""

    product: tuple = ()
    issue: tuple = ()
    company: tuple = ()
    state: tuple = ()
    vader_label: tuple = ()
    year_from: int | None = None
    year_to: int | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        for column in ("product", "issue", "company", "state", "vader_label"):
            wanted = getattr(self, column)
            if wanted and (column != "vader_label" or column in df.columns):
                df = df.where(F.col(column).isin(*wanted))
        if "year" in df.columns:
            if self.year_from:
                df = df.where(F.col("year") >= self.year_from)
            if self.year_to:
                df = df.where(F.col("year") <= self.year_to)
        return df


ALL = Filters()


def filter_options(df: DataFrame, columns=("product", "issue", "state", "company", "year")) -> DataFrame:
    """Distinct non-null values of each filter column, in one pass: (column, value)."""
    present = [c for c in columns if c in df.columns]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present])
    return (
        df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct().orderBy("column", "value")
    )


def label_options(df: DataFrame, labels=lexicons.SENTIMENT_LABELS) -> list[str]:
    return list(labels) if "vader_label" in df.columns else []


def select_present(df: DataFrame, columns) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])
