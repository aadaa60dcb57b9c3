"""Approximate nearest neighbours by randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from storyloom.llm.common import stored
from storyloom.llm.grid import of_one_length, search, stack, valid, with_floor

# Queries of a block whose estimates are held at once: times the block's vectors, 4 bytes each.
STEP = 128


def rotation(d: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated, centred, unit vectors, and their scalars.

    Scalars: length of the centred vector, inner product of the unit vector with its code, inner product of
    the vector with the centre. The code stands for the unit vector of signs over sqrt(d).
    """
    apart = vectors - centre
    length = np.linalg.norm(apart, axis=1)
    turned = apart @ turn / np.where(length > 0, length, 1)[:, None]
    bits = turned > 0
    fit = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), np.column_stack((length, np.where(length > 0, fit, 1), vectors @ centre))


def estimate(
    bits: np.ndarray, scalars: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, width: float
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors), and the half-width of each one's bounds.

    The estimate divides <code, query> by <code, vector>; its error is sqrt(1 - fit^2) / fit times a
    coordinate of a random unit vector in d - 1 dimensions, and ``width`` says how many of its deviations to allow.
    """
    d = queries.shape[1]
    apart = queries - centre
    turned = (apart @ turn).astype(np.float32)
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    length, fit, with_centre = scalars.T.astype(np.float32)
    along = turned @ signs.T / np.float32(np.sqrt(d)) / fit
    base = (queries @ centre - centre @ centre).astype(np.float32)
    guess = along * length + with_centre + base[:, None]
    spread = np.sqrt(np.maximum(1 - fit**2, 0)) / fit / np.float32(np.sqrt(max(d - 1, 1)))
    reach = np.linalg.norm(apart, axis=1).astype(np.float32)[:, None] * (spread * length * np.float32(width))
    return guess, reach


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, width: float = 2.5, seed: int = 42,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows (largest inner product) found for each row whose id is divisible by ``every``.

    Every row is coded to one bit a dimension about the mean of all vectors (each cut to the median length). A query's floor is
    the k-th largest exact score among a sample of the rows, or the k-th largest lower bound in a block where that
    is higher: vectors whose upper bound reaches it are scored on the original vectors in double precision, all
    others are left aside. ``width`` (deviations) sets how rarely a bound is wrong.

    Rows whose vector is null, empty, zero, of another length than the commonest, or holds null or non-finite
    components take no part, nor do rows without an id; a query's own id is no candidate. Ties go to the
    smaller id. Repeated rows are candidates each, and one query. With fewer than ``k`` candidates all
    come back; an empty table gives an empty result; other columns are ignored.
    """
    vec = F.transform(vectors[vec_col], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vec.alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & valid(F.col("vec")) & F.exists("vec", lambda x: x != 0))
    rows, d, n = of_one_length(rows)
    turn = rotation(d, seed)
    centre = np.zeros(d)
    if n:
        # vectors longer than the median count with its length, so that a few huge ones do not move the centre away
        long = rows.select("vec", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("length"))
        usual = long.agg(F.percentile_approx("length", 0.5)).first()[0]
        cut = F.least(F.lit(1.0), F.lit(usual) / F.col("length"))
        # partial sums: one array per task and position, not one row per component
        means = long.select(cut.alias("cut"), F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x") * F.col("cut")).alias("m")).collect()
        for m in means:
            centre[m["i"]] = m["m"]

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits, scalars = encode(stack(batch["vec"], d), centre, turn)
            yield batch.assign(bits=[b.tobytes() for b in bits], scalars=list(scalars))

    index = stored(rows.mapInPandas(code, "vec_id long, vec array<double>, bits binary, scalars array<double>"), "one-bit-codes")

    def cell(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        ids, qv = v["vec_id"].to_numpy(), stack(q["vec"], d)
        found: list[pd.DataFrame] = []
        if len(q) and len(v):
            raw = stack(v["vec"], d)
            bits = np.frombuffer(b"".join(v["bits"]), np.uint8).reshape(len(v), -1)
            scalars = stack(v["scalars"], 3)
            for a in range(0, len(q), STEP):
                guess, reach = estimate(bits, scalars, qv[a : a + STEP], centre, turn, width)
                own = ids == q["query_id"].to_numpy()[a : a + STEP, None]
                low = np.where(own, -np.inf, guess - reach)
                floor = np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(low), -np.inf)
                floor = np.fmax(floor, q["floor"].to_numpy()[a : a + STEP])
                # where an estimate left the range of floats, bounds say nothing: all are scored
                lost = ~np.isfinite(guess + reach).all(axis=1)
                for i, keep in enumerate(((guess + reach >= floor[:, None]) | lost[:, None]) & ~own):
                    at = np.flatnonzero(keep)
                    score = (raw[at] * qv[a + i]).sum(axis=1)
                    best = np.lexsort((ids[at], -score))[:k]
                    r = q.iloc[a + i]
                    found.append(pd.DataFrame({"query_row": r["query_row"], "query_id": r["query_id"], "vec_id": ids[at][best], "score": score[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})

    chosen = index.filter(F.col("vec_id") % every == 0)
    queries = chosen.select(F.col("vec_id").alias("query_id"), "vec")
    if n:
        queries = with_floor(queries, index.select("vec_id", "vec"), d, k)
    return search(index, queries, n, n // every + 1, k, cell, "double")
