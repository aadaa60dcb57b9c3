"""Joins with lookup tables whose size is checked before anything is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Bytes up to which a lookup table is broadcast. The driver holds its rows, the hash table and the pieces it sends: a multiple of this.
BROADCAST_BYTES = 4 << 20
# Copies of a larger lookup table, so that a hot key spreads over this many tasks.
SALTS = 16


def lookup_table(spark: SparkSession, table: dict, key: str, value: str, value_type: str = "string") -> DataFrame:
    """A two-column table of a Python dictionary; the rows are part of the plan."""
    return spark.createDataFrame(list(table.items()), f"{key} string, {value} {value_type}")


def word_table(spark: SparkSession, words, key: str) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], f"{key} string")


def table_bytes(table: DataFrame) -> int:
    """Bytes of a table's values, about: strings and lists by their text, other values by 8. Reads the table once."""
    wide = [f.name for f in table.schema.fields if not isinstance(f.dataType, T.NumericType)]
    size = F.lit(16 + 8 * len(table.columns)).cast("long")
    for name in wide:
        size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f"`{name}`"))), F.lit(0))
    return table.agg(F.sum(size)).first()[0] or 0


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: str, how: str = "left", most_bytes: int = BROADCAST_BYTES, *, salts: int = SALTS
) -> DataFrame:
    """Join a large table with a lookup table on one column.

    The lookup table is measured: up to ``most_bytes`` it is broadcast. Beyond that both sides are shuffled on the
    key and a salt, the lookup table once per salt, so that a key holding a third of the rows is spread over ``salts``
    tasks. The salt is a hash of the row's other columns: a task that runs again deals its rows as before. Where no key
    holds many rows, one salt is enough.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    if table_bytes(lookup) <= most_bytes:
        return df.join(F.broadcast(lookup), on, how)
    if salts == 1:
        return df.join(lookup.hint("merge"), on, how)
    # Maps have no hash, but their text does.
    as_hashed = lambda f: F.to_json(f"`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
    others = [as_hashed(f) for f in df.schema.fields if f.name != on]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.lit(1), *others), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Spark takes a compressed file's bytes for the table's, without the copies, and would broadcast them
    copies = copies.hint("merge")
    return salted.join(copies, [on, "_salt"], how).drop("_salt")
