"""Incremental enrichment: files that arrive later are added once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from storyloom.plans.enrich import Tables, enrich


def enrich_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    tables: Tables = Tables(),
    files_per_batch: int = 1000,
) -> None:
    """Enrich every Parquet file not seen before and append it to ``sink``.

    Progress is kept per file in ``checkpoint``, which must be on shared storage; a run
    that dies is repeated from its last whole batch.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        enrich(stream, tables)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
