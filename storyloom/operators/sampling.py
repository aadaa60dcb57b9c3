"""Samples of an exact size, the same on every run, without sorting the table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from storyloom.operators.joins import lookup_join

# Hex digits of the hash used to find the cut: 16^4 = 65,536 buckets.
PREFIX = 4
# Rows of one prefix whose ranks are sorted; with more of them the prefix is made longer.
BORDER = 100_000
# The rank of a null key, after all others.
LAST = "~"


def sample_rank(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))


def _prefix(key: str, seed: int) -> Column:
    return F.substring(sample_rank(key, seed), 1, PREFIX)


def ordered_text(df: DataFrame, key: str) -> Column | None:
    """Hex text in the order of a whole-number, date, timestamp or string key; None for other types."""
    c, kind = F.col(key), df.schema[key].dataType
    if isinstance(kind, T.StringType):
        return F.hex(F.encode(c, "UTF-8"))
    if isinstance(kind, T.IntegralType):
        number = c.cast("long")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(c).cast("long")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(c)
    else:
        return None
    # the sign bit is turned over, so that negative numbers come first
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def _cut(ranks: DataFrame, n: int) -> tuple[str, int, int] | None:
    """(rank, wanted, found): all rows below ``rank`` and ``wanted`` of the ``found`` rows at it are the first n.

    None where there are no more than n rows. Rows are counted per prefix of the rank, which goes down by
    ``PREFIX`` digits a round until few enough ranks are left to be sorted; only counts leave the tasks.
    """
    ends = ranks.agg(F.count("_r").alias("n"), F.min("_r").alias("lo"), F.max("_r").alias("hi")).first()
    if ends["n"] <= n:
        return None
    prefix, found, wanted = os.path.commonprefix([ends["lo"], ends["hi"]]), ends["n"], n

    def at(text: Column) -> tuple[str, int, int]:
        # at most 65,536 prefixes or BORDER ranks
        counts = ranks.where(F.col("_r").startswith(prefix)).groupBy(text.alias("_t")).agg(F.count(F.lit(1)).alias("_c"))
        before = F.sum("_c").over(Window.orderBy("_t")) - F.col("_c")
        row = counts.withColumn("_b", before).where(F.col("_b") < wanted).orderBy(F.desc("_t")).first()
        return row["_t"], wanted - row["_b"], row["_c"]

    while found > BORDER:
        length = len(prefix) + PREFIX
        prefix, wanted, found = at(F.substring("_r", 1, length))
        if len(prefix) < length:
            return prefix, wanted, found
    return at(F.col("_r"))


def _first_by(df: DataFrame, rank: Column, n: int) -> DataFrame:
    """The first n rows by a text; of rows that share the last text, those with the smallest hash of their values."""
    if n <= 0:
        return df.limit(0)
    rank = F.coalesce(rank, F.lit(LAST))
    cut = _cut(df.select(rank.alias("_r")), n)
    if cut is None:
        return df
    last, wanted, found = cut
    if wanted == found:
        return df.where(rank <= last)
    whole = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    return df.where(rank < last).union(df.where(rank == last).orderBy(whole).limit(wanted))


def sample_uniform(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """min(n, rows) rows: those with the smallest hash of the key, where they are and in no new order.

    Passes over the key column alone count rows per hash prefix and find the hash at which n rows are reached;
    the rows up to it are kept by a filter, so no whole row is moved or sorted, whatever n is. Only where the key
    repeats at the cut are the rows of that one key ranked. A null key comes last.
    """
    return _first_by(df, sample_rank(key, seed), n)


def sample_by_group(df: DataFrame, group: str, key: str, n: int = 3, seed: int = 42) -> DataFrame:
    """Up to n rows of every non-null group, those with the smallest hash of the key.

    The cut is found per group as in :func:`sample_uniform`, so a group that holds a
    third of all rows sends only the rows near its cut to the final ranking.
    """
    kept = df.where(F.col(group).isNotNull())
    hashed = kept.withColumn("_p", _prefix(key, seed))
    counts = hashed.groupBy(group, "_p").agg(F.count(F.lit(1)).alias("_c"))
    # at most 65,536 rows per group
    running = Window.partitionBy(group).orderBy("_p")
    cuts = (
        counts.withColumn("_before", F.sum("_c").over(running) - F.col("_c"))
        .where(F.col("_before") < n)
        .groupBy(group)
        .agg(F.max("_p").alias("_cut"))
    )
    # One row per group: where they are few enough, whole rows are filtered in place; the ranking is over few rows.
    near = lookup_join(hashed, cuts, group, "inner").where(F.col("_p") <= F.col("_cut"))
    ranked = near.withColumn(
        "_rn",
        F.row_number().over(Window.partitionBy(group).orderBy(sample_rank(key, seed), F.col(key))),
    )
    return ranked.where(F.col("_rn") <= n).select(*(f"`{c}`" for c in df.columns))


def first_rows(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first n rows by key, where they are; all rows when n is None. A null key comes last.

    The n-th key is found as in :func:`sample_uniform`, by counts over the key column. Keys of other types
    than whole numbers, dates, timestamps and strings are sorted, with whole rows up to the n-th.
    """
    if n is None:
        return df
    rank = ordered_text(df, key)
    if rank is None:
        return df.orderBy(F.asc_nulls_last(key)).limit(n)
    return _first_by(df, rank, n)
