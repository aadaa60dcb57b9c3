"""Exact quantiles of any number of rows, without holding them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storyloom.functions.let import let

# Value ranges per group in the first step: STEP ranges of STEP ranges each.
STEP = 64
RANGES = STEP * STEP


def measures_long(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row per measure and input row: ``group`` (the measure's name) and ``v``."""
    pairs = [F.struct(F.lit(name).alias("group"), c.cast("double").alias("v")) for name, c in measures.items()]
    return df.select(F.explode(F.array(*pairs)).alias("_m")).select("_m.group", "_m.v")


def counted_values(long: DataFrame, groups: list[str]) -> DataFrame:
    """Rows per ``group`` and value; equal values are merged before the shuffle."""
    return (
        long.where(F.col("v").isNotNull() & F.col("group").isin(*groups))
        .groupBy("group", "v")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def extents(counted: DataFrame) -> DataFrame:
    """One row per group: count, mean, least and greatest value."""
    return counted.groupBy("group").agg(
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.sum("c").alias("n"),
        (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"),
    )


def moments(counted: DataFrame) -> DataFrame:
    """``extents`` with the sample deviation, by distances from the mean."""
    joined = counted.join(F.broadcast(extents(counted)), "group")
    gap = F.col("v") - F.col("mean")
    variance = F.try_divide(F.sum(gap * gap * F.col("c")), F.col("n") - 1)
    return joined.groupBy("group", "lo", "hi", "n", "mean").agg(F.sqrt(variance).alias("std"))


def exact_quantiles(long: DataFrame, groups: list[str], quantiles: list[float]) -> DataFrame:
    """Linear-interpolated quantiles of ``v`` for each listed ``group``: (group, q, value)."""
    return quantiles_of(counted_values(long, groups), quantiles)


def _range_of(v: Column, coarse: Column, cuts: Column) -> Column:
    """How many of the sorted ``cuts`` lie below v; ``coarse`` holds the last of each ``STEP`` of them."""
    below = lambda part: F.size(F.filter(part, lambda c: c < v))
    return let(below(coarse), lambda i: i * STEP + below(F.slice(cuts, i * STEP + 1, STEP)))


def value_ranges(counted: DataFrame) -> DataFrame:
    """(group, b, first, last, c): about ``RANGES`` ranges per group with as many different values in each.

    The ends come from approximate percentiles of the different values, so that far outliers
    do not push all others into one range.
    """
    # as text, because a literal of thousands of parts takes seconds to plan
    shares = F.from_json(F.lit(str([i / RANGES for i in range(1, RANGES)])), "array<double>")
    cuts = counted.groupBy("group").agg(F.percentile_approx("v", shares, 10_000).alias("cuts"))
    cuts = cuts.withColumn("coarse", F.filter("cuts", lambda c, i: i % STEP == STEP - 1))
    found = _range_of(F.col("v"), F.col("coarse"), F.col("cuts"))
    placed = counted.join(F.broadcast(cuts), "group").withColumn("b", found)
    return placed.groupBy("group", "b").agg(
        F.sum("c").alias("c"), F.min("v").alias("first"), F.max("v").alias("last")
    )


def quantiles_of(counted: DataFrame, quantiles: list[float]) -> DataFrame:
    """Quantiles from value counts.

    1. The counts are added up in value ranges; running totals over those few rows
       show which range holds each wanted rank.
    2. Only the values between the ends of those ranges are ranked.

    Every step reads the one shuffled table of value counts, which Spark computes once.
    The groups were listed by name, which bounds every table that is broadcast.
    """
    by_range = value_ranges(counted).withColumn("n", F.sum("c").over(Window.partitionBy("group")))
    running = Window.partitionBy("group").orderBy("b")
    wanted = F.array(
        *[
            F.struct(F.lit(float(q)).alias("q"), rank(F.col("n"), q).cast("long").alias("rank"), F.lit(side).alias("side"))
            for q in quantiles
            for side, rank in (("low", _low_rank), ("high", _high_rank))
        ]
    )
    targets = (
        by_range.withColumn("before", F.sum("c").over(running) - F.col("c"))
        .withColumn(
            "want",
            F.filter(wanted, lambda w: (w["rank"] >= F.col("before")) & (w["rank"] < F.col("before") + F.col("c"))),
        )
        .where(F.size("want") > 0)
        .select("group", "b", "first", "last", "n", "before", "want")
    )
    # at most 2 rows per group and quantile
    inside = counted.join(F.broadcast(targets), "group").where(F.col("v").between(F.col("first"), F.col("last")))
    upto = F.col("before") + F.sum("c").over(Window.partitionBy("group", "b").orderBy("v"))
    hits = (
        inside.withColumn("upto", upto)
        .withColumn(
            "hit",
            F.explode(
                F.filter(
                    "want", lambda w: (w["rank"] < F.col("upto")) & (w["rank"] >= F.col("upto") - F.col("c"))
                )
            ),
        )
        .select("group", "n", "v", "hit.q", "hit.side")
    )
    low = F.max(F.when(F.col("side") == "low", F.col("v")))
    high = F.max(F.when(F.col("side") == "high", F.col("v")))
    position = (F.max("n") - 1) * F.col("q")
    return hits.groupBy("group", "q").agg(
        (low + (high - low) * (position - F.floor(position))).alias("value")
    )


def _low_rank(n: Column, q: float) -> Column:
    return F.floor((n - 1) * F.lit(float(q)))


def _high_rank(n: Column, q: float) -> Column:
    return F.ceil((n - 1) * F.lit(float(q)))


def one_quantile(df: DataFrame, c: Column, q: float) -> Column:
    """One quantile of one column, as a scalar subquery."""
    long = measures_long(df, {"all": c})
    return exact_quantiles(long, ["all"], [q]).select("value").scalar()


def pivot_quantiles(found: DataFrame, names: dict[float, str]) -> DataFrame:
    """(group, q, value) to one row per group with a column per quantile."""
    pick = lambda q: F.max(F.when(F.abs(F.col("q") - F.lit(float(q))) < 1e-12, F.col("value")))
    return found.groupBy("group").agg(*[pick(q).alias(name) for q, name in names.items()])
