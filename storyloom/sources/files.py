"""Readers and writers: damaged CSV, staged Parquet, CSV export."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

log = logging.getLogger("storyloom")

BAD = "_bad"


def damaged_row(bad: Column, fields: int) -> Column:
    """Whether a row that did not parse as a whole has an open quote or too many fields, and not just too few."""
    # Pieces between quotes: even ones lie outside quoted fields. (A regular expression
    # over a long quoted field would overflow the matcher's stack.)
    pieces = F.split(bad, '"')
    outside = F.filter(pieces, lambda p, i: i % 2 == 0)
    commas = F.aggregate(outside, F.lit(0), lambda n, p: n + F.regexp_count(p, F.lit(",")))
    open_quote = F.size(pieces) % 2 == 0
    return bad.isNotNull() & (open_quote | (commas > fields - 1))


def read_csv_skip_bad(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, header: bool = True
) -> DataFrame:
    """CSV without its damaged rows: too many fields, or a quote left open at the end.

    Rows with too few fields are kept and padded with nulls; columns are bound by position. With ``multi_line`` a
    file is one task: ``split_csv.read_split_csv`` reads a large one in many. Set it to False when no field holds a line break.
    """
    with_bad = T.StructType(schema.fields + [T.StructField(BAD, T.StringType())])
    raw = spark.read.csv(
        path, schema=with_bad, header=header, multiLine=multi_line, escape='"', quote='"',
        mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, enforceSchema=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return raw.where(~damaged_row(F.col(BAD), len(schema.fields))).drop(BAD)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def save_stage(df: DataFrame, path: str, partition_by: tuple = ()) -> dict:
    """Write a stage as Parquet; its row count is observed during the write."""
    seen = Observation()
    # stages hold each text several times over; zstd halves what the default codec writes of them
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    report = {"path": path, "rows": seen.get["rows"], "columns": len(df.columns)}
    log.info("stage %(path)s: %(rows)d rows, %(columns)d columns", report)
    return report


def kept_table(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """A table written to a shared folder and read back: later jobs read files, and lost executors cost nothing of it."""
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_stage(spark: SparkSession, path: str) -> DataFrame | None:
    """A finished stage, or None. Spark leaves ``_SUCCESS`` only behind a whole write."""
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return None
    return spark.read.parquet(path)


def read_enriched(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The finished table, or an empty one of the same schema when it is not there."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV copy; arrays and maps are written as JSON text."""
    flat = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, escape='"')
