"""Table and column profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from storyloom.operators.quantiles import (
    counted_values,
    measures_long,
    moments,
    pivot_quantiles,
    quantiles_of,
)

QUARTILES = {0.25: "q25", 0.5: "median", 0.75: "q75"}


def schema_listing(df: DataFrame) -> DataFrame:
    """Column names and types with the row count of the table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    listing = df.sparkSession.createDataFrame(rows, "position int, column string, type string")
    return listing.withColumn("n_rows", df.agg(F.count(F.lit(1)).alias("n")).scalar())


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column that has any, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    return one.select(F.inline(pairs)).where(F.col("nulls") > 0)


def _comparable(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(c))
    return c


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row: ``n_rows`` and ``duplicates``.

    Rows are compared by a SHA-256 digest of all values, so 64 characters are
    shuffled per row and not the texts, and copies are merged before the shuffle.
    """
    row = F.to_json(
        F.struct(*[_comparable(f).alias(f.name) for f in df.schema.fields]),
        # nulls count, and so do microseconds
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    digests = df.select(F.sha2(row, 256).alias("_d")).groupBy("_d").agg(F.count(F.lit(1)).alias("_c"))
    return digests.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"),
    )


def describe(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """count, mean, std, min, quartiles and max per measure, one row each."""
    counted = counted_values(measures_long(df, measures), list(measures))
    plain = moments(counted).withColumnsRenamed({"n": "count", "lo": "min", "hi": "max"})
    parts = pivot_quantiles(quantiles_of(counted, list(QUARTILES)), QUARTILES)
    # one row per measure on either side
    return (
        plain.join(F.broadcast(parts), "group")
        .withColumnRenamed("group", "measure")
        .select("measure", "count", "mean", "std", "min", "q25", "median", "q75", "max")
    )


def length_stats(df: DataFrame, text: str) -> DataFrame:
    """Length statistics over non-null texts."""
    return describe(df, {"length": F.length(text)}).drop("measure", "count")


def length_flags(df: DataFrame, text: str, short: int = 20, long: int = 3000) -> DataFrame:
    n = F.length(text)
    return df.agg(F.count_if(n < short).alias("n_short"), F.count_if(n > long).alias("n_long"))


def contains_share(df: DataFrame, text: str, needle: str = "xxxx") -> DataFrame:
    """Rows whose text holds the needle, ignoring case, and their share in percent."""
    hit = F.contains(F.lower(text), F.lit(needle.lower()))
    return df.agg(
        F.count_if(hit).alias("n_hit"),
        (F.avg(F.coalesce(hit, F.lit(False)).cast("int")) * 100).alias("pct_hit"),
    )


def date_range(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def yearly_counts(df: DataFrame, year: str = "year", name: str = "n") -> DataFrame:
    return (
        df.where(F.col(year).isNotNull()).groupBy(year).agg(F.count(F.lit(1)).alias(name)).orderBy(year)
    )


def label_distribution(df: DataFrame, columns=("vader_label", "textblob_label")) -> DataFrame:
    """Rows per label of every scorer, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("scorer"), F.col(c).alias("label")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .where(F.col("label").isNotNull())
        .groupBy("scorer", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


CORRELATED = (
    "narrative_length word_count unique_words lexical_diversity legal_term_count "
    "uppercase_ratio mask_count entity_count vader_compound textblob_polarity"
).split()


def _sum_name(*at: int) -> str:
    return "_s" + "_".join(map(str, at))


def correlation_matrix(df: DataFrame, columns=CORRELATED) -> DataFrame:
    """Pearson correlation of each pair of present columns, in one pass over the table.

    Rows are added up per pattern of nulls (at most two to the power of the columns): count, sums, squares and
    products of the distances from a value of each column, and least and greatest values. The pairs are made of
    those sums alone. A pair without a row where both are present has no result row; one with a constant column
    gives null.
    """
    present = [c for c in columns if c in df.columns]
    numbers = df.select(*(F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(present)))
    # Any value of the column will do: it keeps the squares of large, close numbers apart.
    some = numbers.limit(1_000).agg(*(F.min(f"_v{i}").alias(f"_v{i}") for i in range(len(present))))
    near = {i: F.coalesce(some.select(f"_v{i}").scalar(), F.lit(0.0)) for i in range(len(present))}
    distances = numbers.select(*((F.col(f"_v{i}") - near[i]).alias(f"_v{i}") for i in range(len(present))))
    present_bits = sum((F.when(F.col(f"_v{i}").isNotNull(), 1 << i).otherwise(0) for i in range(len(present))), F.lit(0))
    sums = [F.sum(f"_v{i}").alias(_sum_name(i)) for i in range(len(present))]
    sums += [F.sum(F.col(f"_v{i}") * F.col(f"_v{j}")).alias(_sum_name(i, j)) for i in range(len(present)) for j in range(i, len(present))]
    ends = [f(f"_v{i}").alias(f"_{name}{i}") for i in range(len(present)) for name, f in (("lo", F.min), ("hi", F.max))]
    parts = distances.groupBy(present_bits.cast("long").alias("_bits")).agg(F.count(F.lit(1)).alias("_n"), *sums, *ends)
    cells = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            (F.col("_bits").bitwiseAND(F.lit((1 << i) | (1 << j))) == F.lit((1 << i) | (1 << j))).alias("both"),
            F.col("_n").alias("n"), *(F.col(_sum_name(*at)).alias(name) for name, at in
                                      (("x", (i,)), ("y", (j,)), ("xx", (i, i)), ("yy", (j, j)), ("xy", (i, j)))),
            *(F.col(f"_{name}{k}").alias(f"{name}_{side}") for k, side in ((i, "x"), (j, "y")) for name in ("lo", "hi")),
        )
        for (i, a), (j, b) in combinations(enumerate(present), 2)
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    pairs = parts.select(F.inline(F.array(*cells))).where("both").groupBy("a", "b")
    total = pairs.agg(
        *(F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")),
        ((F.min("lo_x") == F.max("hi_x")) | (F.min("lo_y") == F.max("hi_y"))).alias("constant"),
    )
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    spread = F.sqrt(F.greatest(F.col("xx") - x * x / n, F.lit(0.0))) * F.sqrt(F.greatest(F.col("yy") - y * y / n, F.lit(0.0)))
    return total.select("a", "b", F.when(~F.col("constant"), F.try_divide(F.col("xy") - x * y / n, spread)).alias("r"))
