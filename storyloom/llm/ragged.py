"""Byte-pair merging of many short sequences at once, as ragged numpy arrays."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd

NEVER = np.iinfo(np.int32).max
# Places in a sequence of ``merge_leftmost`` fit into BITS, and its sequences lie in tables of these widths.
BITS = 6
LOW = (1 << BITS) - 1
WIDTHS = (8, 16, 32, LOW)


class PairTable:
    """Which pairs of symbols merge, in what order, and into what."""

    def __init__(self, left, right, rank, made, symbols: int):
        key = np.asarray(left, np.int64) * symbols + np.asarray(right, np.int64)
        unique, order = np.unique(key, return_index=True)
        self.symbols = symbols
        self.key = pd.Index(unique)
        # the last entries stand for pairs that do not merge, whose place in the index is -1
        self.rank = np.append(np.asarray(rank, np.int32)[order], np.int32(NEVER))
        self.made = np.append(np.asarray(made, np.int32)[order], np.int32(-1))
        self.one = dict(zip(key.tolist(), zip(np.asarray(rank).tolist(), np.asarray(made).tolist())))

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NEVER`` where the pair does not merge) and result of each pair."""
        key = left.astype(np.int64) * self.symbols + right
        key[(left < 0) | (right < 0)] = -1
        at = self.key.get_indexer(key)
        return self.rank[at], self.made[at]


def alternate(chosen: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Of overlapping neighbours in ``chosen`` keep every second, from the left.

    ``joined[i]`` says that entries i-1 and i overlap if both are chosen.
    """
    run = chosen & np.concatenate(([False], chosen[:-1])) & joined
    if not run.any():
        return chosen
    at = np.arange(len(chosen))
    start = np.maximum.accumulate(np.where(run, -1, at))
    return chosen & ((at - start) % 2 == 0)


def merge_counts(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """Symbols that are left of each sequence after all merges.

    Each round finds every sequence's lowest rank and merges all places of that pair
    at once. This equals merging one by one from the left where a new pair never
    ranks before the pair that made it, as in a table learned by merging.
    """
    counts = lengths.astype(np.int64).copy()
    live = np.flatnonzero(lengths > 1)
    keep = np.repeat(lengths > 1, lengths)
    symbols = symbols[keep].astype(np.int32)
    sequence = np.repeat(np.arange(len(live)), lengths[live])
    while len(symbols):
        inner = sequence[1:] == sequence[:-1]
        rank, made = table.find(symbols[:-1], symbols[1:])
        rank = np.where(inner, rank, NEVER)
        starts = np.flatnonzero(np.concatenate(([True], ~inner)))
        padded = np.append(rank, NEVER)
        lowest = np.minimum.reduceat(padded, starts)
        row = np.cumsum(np.concatenate(([True], ~inner))) - 1
        chosen = (rank < NEVER) & (rank == lowest[row[:-1]])
        chosen = alternate(chosen, np.concatenate(([False], inner[:-1])) if len(inner) else inner)
        at = np.flatnonzero(chosen)
        symbols[at] = made[at]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        active = (lowest < NEVER)[row] & stay
        sizes = np.bincount(row[stay], minlength=len(starts))
        counts[live] = sizes
        live = live[lowest < NEVER]
        symbols = symbols[active]
        sequence = np.repeat(np.arange(len(live)), sizes[lowest < NEVER])
    return counts


def agenda(symbols: list[int], table: PairTable, skip: Callable[[int, int], bool] | None = None) -> list[int]:
    """Merge one sequence by a priority queue: lowest rank first, then leftmost.

    ``skip(start, end)`` says whether the candidate that spans these first symbols
    is left out when its turn comes. Time grows as n log n, for sequences of any length.
    """
    n = len(symbols)
    value, width = list(symbols), [1] * n
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j < n and value[i] >= 0 and value[j] >= 0:
            found = table.one.get(value[i] * table.symbols + value[j])
            if found:
                heapq.heappush(queue, (found[0], i, width[i], width[j], found[1]))

    for i in range(n - 1):
        offer(i, i + 1)
    while queue:
        _, i, wide, next_wide, made = heapq.heappop(queue)
        j = i + wide
        if width[i] != wide or j >= n or width[j] != next_wide:
            continue
        if skip and skip(i, j + next_wide):
            continue
        value[i], width[i], width[j] = made, wide + next_wide, 0
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    return [v for v, w in zip(value, width) if w]


class Ragged:
    """Rows of different lengths in one array."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size = flat, size
        self.first = np.cumsum(size) - size

    def places(self, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Where the first ``size`` entries of each of ``rows`` lie in ``flat``."""
        start = np.cumsum(size) - size
        return np.arange(size.sum()) + np.repeat(self.first[rows] - start, size)

    def of(self, rows: np.ndarray) -> Ragged:
        size = self.size[rows]
        return Ragged(self.flat[self.places(rows, size)], size)


def span(merge: np.ndarray) -> np.ndarray:
    """Start and end of a merge (or of a packed span) as one number, the start in the higher bits."""
    return merge & ((1 << 2 * BITS) - 1)


def merged(symbols: Ragged, ends: Ragged, merges: np.ndarray, count: np.ndarray) -> tuple[Ragged, Ragged]:
    """Rows as ``merge_leftmost`` takes them, after each row's merges (``count`` of them, in the order they happened)."""
    at = np.repeat(symbols.first, count)
    value, end = symbols.flat.copy(), ends.flat.copy()
    # where symbols grew more than once from the same start, the last one stays
    value[at + (merges >> BITS & LOW)] = merges >> 3 * BITS
    end[at + (merges >> BITS & LOW)] = merges & LOW
    end[at + (merges >> 2 * BITS & LOW)] = 0
    return Ragged(value, symbols.size), Ragged(end, symbols.size)


def merge_leftmost(symbols: Ragged, ends: Ragged, table: PairTable, left_out: np.ndarray) -> Ragged:
    """The merges of the agenda for many short sequences (of at most ``LOW`` places) at once, in order.

    ``ends`` holds the end of the symbol that starts at a place, and 0 at places inside a symbol. Column r of ``left_out``
    holds the spans that are left out in row r. Each round takes every row's best candidate (lowest rank, then leftmost);
    as leaving out depends on the span alone, this gives what ``agenda`` gives. A merge is result, start of its
    right part, start and end, in BITS each from the second on.
    """
    lengths = symbols.size
    count, rounds, least = np.zeros(len(lengths), np.int64), [], 1
    for width in WIDTHS:
        rows = np.flatnonzero((lengths > least) & (lengths <= width))
        least = width
        if len(rows):
            found = _merge_table(symbols, ends, rows, width, table, left_out)
            rounds.append(found)
            for row, _ in found:
                count[row] += 1
    out = Ragged(np.zeros(count.sum(), np.int64), count)
    for found in rounds:
        # a row merges in every round until it is done, so the rounds are the order
        for k, (row, merge) in enumerate(found):
            out.flat[out.first[row] + k] = merge
    return out


def _merge_table(symbols: Ragged, ends: Ragged, rows: np.ndarray, width: int, table: PairTable, left_out: np.ndarray) -> list:
    """Each round's merges (rows and merges), with a column per row and a line per place.

    The last line stands for what is before a row's first symbol and, as every place behind its end, holds no symbol.
    """
    n = len(rows)
    place = np.arange(width + 1)[:, None]
    cell = np.minimum(symbols.first[rows] + place, len(symbols.flat) - 1)
    after = np.where(place < symbols.size[rows], ends.flat[cell], 0).ravel()
    value = np.where(after > 0, symbols.flat[cell].ravel(), -1).astype(np.int32)
    before, best = np.full(len(after), width), np.full(len(after), NEVER, np.int32)
    made = np.full(len(after), -1, np.int32)

    def keys(left: np.ndarray, right: np.ndarray, start: np.ndarray, end: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place of candidates as one number, and their results."""
        rank, result = table.find(left, right)
        at = np.flatnonzero(rank < NEVER)
        start, code = start[at], start[at] << BITS | end[at]
        keep = np.ones(len(at), bool)
        for skipped in left_out:
            keep &= skipped[rows[column[at]]] != code
        key = np.full(len(rank), NEVER, np.int32)
        key[at[keep]] = rank[at[keep]] << BITS | start[keep]
        return key, result

    live = np.flatnonzero(after)
    start, column = live // n, live % n
    right = after[live] * n + column
    before[right] = start
    best[live], made[live] = keys(value[live], value[right], start, after[right], column)
    # rows that are done leave the table of the best candidates, the others keep their columns in the rest
    best, mine, found = best.reshape(width + 1, n), np.arange(n), []
    while True:
        low = best.min(axis=0)
        open_ = np.flatnonzero(low < NEVER)
        if not len(open_):
            return found
        if 4 * len(open_) < 3 * len(mine):
            best, mine, low = best[:, open_], mine[open_], low[open_]
            open_ = np.arange(len(mine))
        column, left = mine[open_], (low[open_] & LOW).astype(np.int64)
        at = left * n + column
        mid, begin = after[at], before[at]
        end = after[mid * n + column]
        beyond = end * n + column
        new = made[at]
        value[at], after[at], before[beyond], after[mid * n + column] = new, end, left, 0
        found.append((rows[column], new.astype(np.int64) << 3 * BITS | mid << 2 * BITS | left << BITS | end))
        # only the pairs beside a new symbol change
        start = np.concatenate((begin, left))
        key, result = keys(
            np.concatenate((value[begin * n + column], new)), np.concatenate((new, value[beyond])),
            start, np.concatenate((end, after[beyond])), np.concatenate((column, column)),
        )
        best[mid, open_] = NEVER
        best[start, np.concatenate((open_, open_))] = key
        made[start * n + np.concatenate((column, column))] = result
