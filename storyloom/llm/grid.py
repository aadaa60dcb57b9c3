"""A stated query set against all rows of a vector table, in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from storyloom.llm.common import scale_count

# Vectors and queries that meet in one task, at most about. With 64 dimensions a task holds some tens of MB.
VECTORS = 32_768
QUERIES = 4_096
# Blocks of vectors, at least, so that a small table still spreads.
LEAST = 24
# Rows, by smallest hash, whose exact scores give each query a floor for all blocks. Results do not depend on it.
SAMPLE = 2_048


def valid(vector: Column) -> Column:
    """Neither null nor empty nor with a null or non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.array_size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def of_one_length(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """The vectors of the commonest length (of equally common ones, the shorter), that length, and how many they are."""
    n = vectors.groupBy(F.array_size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if n is None:
        return vectors, 0, 0
    return vectors.filter(F.array_size("vec") == n["d"]), n["d"], n["count"]


def stack(column: pd.Series, width: int, kind=np.float64) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, width), kind)
    return np.stack(column.to_numpy()).astype(kind, copy=False)


def sample_of(rows: DataFrame, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the ``SAMPLE`` rows of the smallest hashes."""
    frame = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(SAMPLE).select("vec_id", "vec").toPandas()
    return frame["vec_id"].to_numpy(np.int64), stack(frame["vec"], d)


def floors(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """A score that ``k`` rows other than the query's own reach for certain, by query; -inf where the sample has too few.

    Products are lessened by more than their rounding. A score is at most the largest long, so a floor is too.
    """
    out = np.full(len(queries), -np.inf)
    if len(ids) < k:
        return out
    lengths = np.linalg.norm(sample, axis=1)
    for a in range(0, len(queries), 256):
        q = queries[a : a + 256]
        with np.errstate(over="ignore", invalid="ignore"):
            low = q @ sample.T - 1e-9 * np.linalg.norm(q, axis=1)[:, None] * lengths
        low = np.where(np.isnan(low) | (ids == own[a : a + 256, None]), -np.inf, low)
        out[a : a + 256] = np.partition(low, -k, axis=1)[:, -k]
    return np.minimum(out, 2.0**63)


def with_floor(queries: DataFrame, rows: DataFrame, d: int, k: int) -> DataFrame:
    """The queries with their ``floor`` among a sample of the rows, worked out once for all blocks."""
    ids, sample = sample_of(rows, d)
    shared = queries.sparkSession.sparkContext.broadcast((ids, sample))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, vectors = shared.value
        for batch in batches:
            own = batch["query_id"].to_numpy()
            yield batch.assign(floor=floors(stack(batch["vec"], d), own, known, vectors, k))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    return queries.mapInPandas(work, f"{kinds}, floor double")


def search(
    index: DataFrame, queries: DataFrame, n_index: int, n_queries: int, k: int,
    cell: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], score_type: str,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best by score, ties to the smaller vec_id.

    Vectors are dealt over blocks by hash, and so are queries; each block of one meets each of the other in a task,
    where ``cell(queries, vectors)`` returns the best ``k`` of the cell as (query_id, vec_id, score). A
    task's memory is set by the two block sizes, whatever the table's size.
    """
    queries = queries.distinct().withColumn("query_row", F.xxhash64("query_id", "vec"))
    v_blocks = scale_count(n_index, VECTORS, LEAST)
    q_blocks = scale_count(n_queries, QUERIES)
    v = index.withColumn("v_block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(v_blocks)).cast("int"))
    v = v.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    q = queries.withColumn("q_block", F.pmod("query_row", F.lit(q_blocks)).cast("int"))
    q = q.withColumn("v_block", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))))
    best = (
        q.groupBy("v_block", "q_block")
        .cogroup(v.groupBy("v_block", "q_block"))
        .applyInPandas(cell, f"query_row long, query_id long, vec_id long, score {score_type}")
    )
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
