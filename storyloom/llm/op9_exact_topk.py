"""Exact top-k by inner product with pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from storyloom.llm.common import stored
from storyloom.llm.grid import of_one_length, sample_of, search, stack, valid, with_floor

# Candidates that are scored between two looks at the stopping rule.
STEP = 256
LONG = 2**63 - 1


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows that lie far from each other: each next one is the farthest from those before."""
    if len(sample) == 0:
        return sample
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return sample[chosen]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(vectors - p, axis=1) for p in pivots], axis=1) if len(pivots) else np.zeros((len(vectors), 0))


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; sums too large for a double's whole numbers are taken in big integers and end at the range of long."""
    if len(vectors) and float(np.abs(vectors).max()) * float(np.abs(query).max()) * vectors.shape[1] >= 2**53:
        q = [int(x) for x in query]
        sums = [sum(int(a) * b for a, b in zip(v, q)) for v in vectors]
        return np.array([max(-LONG - 1, min(LONG, s)) for s in sums], np.int64)
    return (vectors @ query).astype(np.int64)


def nearest_of(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, bound: np.ndarray, k: int, floor: float = -np.inf):
    """The best ``k`` (ids, scores) that can reach ``floor``: candidates in order of their upper bound, until none left can enter."""
    able = (ids != own) & (bound >= floor)
    ids, vectors, bound = ids[able], vectors[able], bound[able]
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    size, taken = STEP, 0
    while taken < len(ids):
        size = min(size, len(ids) - taken)
        # the next candidates in bound order; the rest stay unsorted
        if taken == 0:
            order = np.argpartition(-bound, size - 1)
        elif len(order) > size:
            order = order[np.argpartition(-bound[order], size - 1)]
        now, order = order[:size], order[size:]
        taken += size
        ids_, score = np.concatenate((best_ids, ids[now])), np.concatenate((best, exact_products(vectors[now], query)))
        top = np.lexsort((ids_, -score))[:k]
        best_ids, best = ids_[top], score[top]
        if len(order) == 0 or (len(best) == k and bound[order].max() < best[-1]):
            break
        if len(best) == k:
            order = order[bound[order] >= best[-1]]
        size *= 4
    return best_ids, best


def top_products(
    vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, pivots: int = 256,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """The ``k`` largest integer inner products of each row whose id is divisible by ``every``, exactly.

    Components x become floor(scale * x). Distances of every row to the pivots are computed once and stored. For a
    query, |d(q, p) - d(o, p)| over all pivots p is a lower bound of d(q, o), hence (|q|^2 + |o|^2 -
    bound^2) / 2 is an upper bound of the score. Candidates below the query's floor, the k-th largest score among a
    sample of the rows, go; the rest are scored in bound order until the next bound is below the k-th score. Where
    pivots separate little, that is most of them: the result is exact always.

    Rows whose vector is null, empty, of another length than the commonest, or holds null or non-finite components
    take no part, nor do rows without an id; a query's own id is no candidate; zero vectors take part. Ties go to
    the smaller id. Repeated rows are candidates each, and one query; an empty table gives an empty result; other
    columns are ignored. A score beyond the range of long ends at that range.
    """
    whole = F.transform(vectors[vec_col], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), whole.alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & valid(F.col("vec")))
    # floor() of Spark gives a long; this one stays a double at any size
    down = lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0)
    rows = rows.select("vec_id", F.transform("vec", lambda x: down(x * scale)).alias("vec"))
    rows, d, n = of_one_length(rows)
    chosen = choose_pivots(sample_of(rows, d)[1], pivots) if n else np.zeros((0, d))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(far=list(distances(stack(batch["vec"], d), chosen)))

    index = stored(rows.mapInPandas(measure, "vec_id long, vec array<double>, far array<double>"), "pivot-table")

    def cell(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        ids, raw, found = v["vec_id"].to_numpy(), stack(v["vec"], d), []
        if len(q) and len(v):
            table, squares = stack(v["far"], len(chosen)).T.copy(), (raw * raw).sum(axis=1)
            for row, own, query, far, floor in zip(q["query_row"], q["query_id"], q["vec"], q["far"], q["floor"]):
                query = np.asarray(query)
                bound = np.zeros(len(ids))
                for p, dp in zip(table, far):
                    np.maximum(bound, np.abs(p - dp), out=bound)
                total = squares + query @ query
                # room for rounding in the distances
                with np.errstate(over="ignore", invalid="ignore"):
                    upper = (total - bound * bound) / 2 + 1e-9 * (total + 1)
                # no bound beyond the range of doubles; and no score is below the least long
                upper = np.maximum(np.where(np.isnan(upper), np.inf, upper), -(2.0**63))
                at, score = nearest_of(query, own, ids, raw, upper, k, floor)
                found.append(pd.DataFrame({"query_row": row, "query_id": own, "vec_id": at, "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    queries = index.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec", "far")
    if n:
        queries = with_floor(queries, index.select("vec_id", "vec"), d, k)
    return search(index, queries, n, n // every + 1, k, cell, "long")
