"""Hard negatives by best-first descent of cover trees over norm-augmented candidates."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from storyloom.llm.common import scale_count, stored
from storyloom.llm.grid import stack, valid
from storyloom.llm.op9_exact_topk import LONG, exact_products

# Candidates of one tree, and anchors that meet it in one task, at most about.
VECTORS, ANCHORS = 8_192, 4_096
# Trees at least, so that a small table still spreads.
LEAST = 12
# A node of so many candidates or fewer is not divided further, and a ball of so many or fewer is no node of its own: its
# candidates are scored with those that stand alone, which costs less than bounding them.
LEAF, BALL = 256, 32
# Radius of a level, as a part of the level above.
SHRINK = 0.75
# Room for rounding in angles, and where an arc cosine turns steep.
SLACK = 1e-7

_TREE = "d int, block int, ids binary, labels binary, vectors binary, nodes binary, norm double"


def augmented(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vectors of one dimension more: each vector over the largest length, and the coordinate that makes up its length.

    Inner products with (query, 0) then only depend on the angle: the largest product is the nearest direction.
    """
    norm = float(np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0)))
    if norm == 0:
        return np.hstack((vectors, np.ones((len(vectors), 1)))), 0.0
    scaled = vectors / norm
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    return np.column_stack((scaled, rest)), norm


def angles(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(points @ centre, -1, 1))


def cover_tree(points: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): candidates in the order of the tree, and rows (centre, radius, first, last, child, children, alone, label).

    Every level covers a node's candidates by balls of a smaller radius whose centres lie further apart than it; a ball's
    own radius is then the largest angle to a candidate below. ``first`` to ``last`` are places in the order; balls of
    over ``BALL`` candidates are ``children`` rows that follow each other from ``child``; smaller balls, and the candidates of a
    node too small to divide, are the places from ``alone`` to ``last``. ``label`` is the one label below, or -inf.
    """
    n = len(points)
    order, rows = np.arange(n), []

    def row(centre: int, away: np.ndarray, first: int, last: int) -> list[float]:
        own = labels[order[first:last]]
        one = own[0] if (own == own[0]).all() and abs(own[0]) < 2**53 else -np.inf
        return [centre, float(away.max()) + SLACK, first, last, 0, 0, first, one]

    far = angles(points, points[0])
    rows.append(row(0, far, 0, n))
    queue: list[tuple[int, float]] = [(0, float(far.max()))]
    while queue:
        at, radius = queue.pop()
        first, last = int(rows[at][2]), int(rows[at][3])
        if last - first <= LEAF or radius <= SLACK:
            continue
        radius *= SHRINK
        free, balls = order[first:last], []
        centre = int(rows[at][0])
        while len(free):
            away = angles(points[free], points[centre])
            near = away <= radius
            near[free == centre] = True
            balls.append((centre, free[near], away[near]))
            free, away = free[~near], away[~near]
            if len(free):
                centre = int(free[away.argmax()])
        if len(balls) == 1:
            queue.append((at, radius))
            continue
        balls.sort(key=lambda ball: len(ball[1]) <= BALL)
        order[first:last] = np.concatenate([x for _, x, _ in balls])
        rows[at][4] = len(rows)
        for c, members, away in balls:
            if len(members) > BALL:
                queue.append((len(rows), float(away.max())))
                rows.append(row(c, away, first, first + len(members)))
                first += len(members)
        rows[at][5], rows[at][6] = len(rows) - rows[at][4], first
    nodes = np.array(rows)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    nodes[:, 0] = place[nodes[:, 0].astype(np.int64)]
    return order, nodes


class Tree:
    """A block of candidates in tree order, and the bounds of its nodes for a query."""

    def __init__(self, d: int, ids: bytes, labels: bytes, vectors: bytes, nodes: bytes, norm: float):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, np.float64).reshape(len(self.ids), d)
        rows = np.frombuffer(nodes, np.float64).reshape(-1, 8)
        self.radius, self.label, self.norm = rows[:, 1], rows[:, 7], norm
        self.centres = self.vectors[rows[:, 0].astype(np.int64)]
        self.last, self.child, self.children, self.alone = (rows[:, i].astype(np.int64).tolist() for i in (3, 4, 5, 6))
        self.largest = float(np.abs(self.vectors).max()) * d

    def bounds(self, query: np.ndarray, length: float, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that a candidate below the nodes ``a`` to ``b`` can have."""
        most = length * self.norm
        if most == 0:
            return np.zeros(b - a), np.zeros(b - a)
        at = np.arccos(np.clip(self.centres[a:b] @ query / most, -1, 1))
        room = SLACK * most + 1
        low = most * np.cos(np.minimum(at + self.radius[a:b], np.pi)) - room
        return low, most * np.cos(np.maximum(at - self.radius[a:b], 0)) + room

    def scores(self, query: np.ndarray, plain: bool, a: int, b: int) -> np.ndarray:
        if plain:
            return self.vectors[a:b] @ query
        return np.maximum(exact_products(self.vectors[a:b], query), -LONG)

    def search(self, query: np.ndarray, own: int, windows: list[tuple[int, int]], k: int, label: int, same: bool) -> list[list[tuple[int, int]]]:
        """Per window (least, largest score) the best ``k`` (-score, id) of the candidates with this label, or with others.

        Nodes leave a queue largest bound first. A node is entered if for some window its bounds meet what lies between
        the window's floor (at last its k-th score) and its upper end; the candidates that stand alone in it are scored exactly.
        """
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        live = [j for j, (least, largest) in enumerate(windows) if least <= largest]
        if not live:
            return found
        floors = [least for least, _ in windows]
        top = max(windows[j][1] for j in live)
        length = float(np.sqrt(query @ query))
        # whole numbers that a double holds
        plain = self.largest * float(np.abs(query).max()) < 2**53

        def wanted(low, high):
            hit = False
            for j in live:
                hit |= (high >= floors[j]) & (low <= windows[j][1])
            return hit

        def verify(a: int, b: int) -> None:
            every = self.scores(query, plain, a, b)
            near = (every >= min(floors[j] for j in live)) & (every <= top) & ((self.labels[a:b] == label) == same)
            at = near.nonzero()[0]
            at = at[self.ids[a:b][at] != own]
            if not len(at):
                return
            ids, scores = self.ids[a:b][at], every[at].astype(np.int64)
            for j in live:
                here = ((scores >= floors[j]) & (scores <= windows[j][1])).nonzero()[0]
                if len(here) > k:
                    here = here[np.lexsort((ids[here], -scores[here]))[:k]]
                if len(here):
                    found[j] = sorted(found[j] + list(zip((-scores[here]).tolist(), ids[here].tolist())))[:k]
                    if len(found[j]) == k:
                        floors[j] = max(floors[j], -found[j][-1][0])

        low, high = self.bounds(query, length, 0, 1)
        queue = [(-top, 0, low[0], high[0])]
        while queue:
            _, at, least, most = heapq.heappop(queue)
            if not wanted(least, most):
                continue
            if self.alone[at] < self.last[at]:
                verify(self.alone[at], self.last[at])
            a, n = self.child[at], self.children[at]
            if n:
                low, high = self.bounds(query, length, a, a + n)
                one = self.label[a : a + n]
                fits = ((one == label) | np.isinf(one) if same else one != label) & wanted(low, high)
                for i in np.flatnonzero(fits).tolist():
                    heapq.heappush(queue, (-min(high[i], top), a + i, low[i], high[i]))
        return found


def _trees(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per block of candidates of one length: ids, labels and vectors in tree order, and the nodes; and (d, blocks)."""
    blocks = rows.groupBy("d").count().select("d", F.greatest(F.lit(LEAST), F.ceil(F.col("count") / VECTORS)).cast("int").alias("blocks"))
    # a row per length of vector
    blocks = stored(blocks, "blocks")
    dealt = rows.join(F.broadcast(blocks), "d").withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.col("blocks")).cast("int"))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        # repeated rows come in any order; what a search returns does not depend on it
        frame = frame.sort_values("vec_id", kind="stable")
        d = int(frame["d"].iloc[0])
        vectors, ids, labels = stack(frame["vec"], d), frame["vec_id"].to_numpy(np.int64), frame["label"].to_numpy(np.int64)
        points, norm = augmented(vectors)
        order, nodes = cover_tree(points, labels)
        return pd.DataFrame(
            {
                "d": [d], "block": [int(frame["block"].iloc[0])], "ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()],
                "vectors": [np.ascontiguousarray(vectors[order]).tobytes()], "nodes": [nodes.tobytes()], "norm": [norm],
            }
        )

    return stored(dealt.groupBy("d", "block").applyInPandas(build, _TREE), "cover-trees"), blocks


def _each(trees: DataFrame, blocks: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """Every anchor against every tree of its length: (anchor_row, window, vec_id, score), the best ``k`` of a tree for each window.

    ``anchors`` has anchor_row, anchor_id, d, vec, label, and least and largest, arrays with an entry per window.
    """
    parts = scale_count(anchors.count(), ANCHORS)
    dealt = anchors.withColumn("part", F.pmod("anchor_row", F.lit(parts)).cast("int")).join(F.broadcast(blocks), "d")
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def cell(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(t):
            r = t.iloc[0]
            tree = Tree(int(r["d"]), r["ids"], r["labels"], r["vectors"], r["nodes"], float(r["norm"]))
            for row, own, vec, label, least, largest in zip(*(q[c] for c in ("anchor_row", "anchor_id", "vec", "label", "least", "largest"))):
                windows = list(zip(map(int, least), map(int, largest)))
                for w, best in enumerate(tree.search(np.asarray(vec, float), own, windows, k, label, same)):
                    out.extend((row, w, i, -s) for s, i in best)
        return pd.DataFrame(out, columns=["anchor_row", "window", "vec_id", "score"])

    keys = ("d", "block", "part")
    return dealt.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(cell, "anchor_row long, window int, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def whole_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(vec_id, label, vec, d) of the rows that take part; components x become floor(scale * x)."""
    vec = F.transform(vectors[vec_col], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & valid(F.col("vec")))
    # floor() of Spark gives a long; this one stays a double at any size
    down = lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0)
    rows = rows.select("vec_id", "label", F.transform("vec", lambda x: down(x * scale)).alias("vec"))
    return rows.withColumn("d", F.array_size("vec"))


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256, relabel: int = 7,
    classes: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per anchor (id divisible by ``every``) and positive the first ``negatives`` rows of other labels whose score lies in the positive's window.

    Scores are integer inner products of floor(scale * x). Candidates are dealt over blocks by hash; each block has a cover
    tree over its candidates, each made up to the block's largest length by one more coordinate, so that an angle
    to the anchor bounds a product. A first descent of all trees finds the anchor's positives, its best rows of the same label;
    a second one, with windows of ``percent`` % to 100 % of the positives' scores, the negatives. Both
    skip nodes whose bounds lie outside and score leaves exactly; every tree gives its best, and the best of those
    remain, so the result is exact. Anchors times trees grows with the square of the rows: the anchors are a fixed share.

    Rows with a null id or label, a null or empty vector or a null or non-finite component take no part; vectors meet those of their
    own length. Where an id is divisible by ``relabel``, the label becomes (label + 1) % ``classes``. Ties go to the smaller
    id; rows of the anchor's id are neither positive nor negative; repeated rows are candidates each, and one anchor. A
    negative positive's score has an empty window. Fewer positives or negatives than asked for all come back; an
    empty table gives an empty result; other columns are ignored. A score beyond the range of long ends at that range.
    """
    label = vectors[label_col].cast("long")
    label = F.when(vectors[id_col].cast("long") % relabel == 0, (label + 1) % classes).otherwise(label)
    rows = stored(whole_vectors(vectors, scale, id_col, vec_col, label), "candidates")
    trees, blocks = _trees(rows)
    anchors = rows.filter(F.col("vec_id") % every == 0).distinct()
    anchors = anchors.withColumn("anchor_row", F.xxhash64("vec_id", "label", "vec")).withColumnRenamed("vec_id", "anchor_id")
    one = lambda x: F.array(F.lit(x).cast("long"))
    wide = anchors.withColumns({"least": one(-LONG), "largest": one(LONG)})
    found = _best(_each(trees, blocks, wide, positives, True), positives)
    found = stored(found.select("anchor_row", F.struct("rank", F.col("vec_id").alias("id"), "score").alias("p")), "positives")
    mine = found.groupBy("anchor_row").agg(F.sort_array(F.collect_list("p")).alias("p"))
    # the least whole number s with percent * p <= 100 * s, in parts, as a product may leave the range of long
    least = F.expr(f"transform(p, x -> (x.score - pmod(x.score, 100)) div 100 * {percent} + cast(ceil(pmod(x.score, 100) * {percent} / 100) as bigint))")
    asked = anchors.join(mine, "anchor_row").withColumns({"least": least, "largest": F.col("p.score")})
    best = _best(_each(trees, blocks, asked.drop("p"), negatives, False), negatives)
    out = best.join(asked.select("anchor_row", "anchor_id", F.posexplode("p").alias("window", "p")), ["anchor_row", "window"])
    return out.select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")
    )
