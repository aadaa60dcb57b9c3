"""Toxicity by votes of the nearest labelled examples under exact TF-IDF cosine."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from storyloom.llm.common import map_texts, stored

# Labelled rows of each class that the classifier is fitted on, at most: those with the smallest hash.
PER_CLASS = 6_000
# Terms that examples are compared by: those most associated with the label, at most.
TERMS = 4_096
# Least association (chi-squared) and least examples of a term.
LEAST_CHI2, LEAST_DF = 15.0, 3
# A term must be this many times as frequent among examples with the label as among the others.
LEAST_RATIO = 5.0
# Neighbours that vote, and the weight of the base rate beside them.
NEIGHBOURS, BASE = 15, 0.3
# Examples in a block of the index, and blocks that are scored before the first look at the bounds.
BLOCK, FIRST = 64, 4
# Words whose terms a worker remembers; beyond that it starts anew.
REMEMBERED = 300_000
LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)


def terms_of(text: str | None) -> Counter:
    """Words of a text in lower case, and the beginnings of longer ones (marked by ^), with their counts."""
    words = Counter(LETTERS.findall(text.lower())) if text else Counter()
    out = Counter(words)
    for w, n in words.items():
        for p in PREFIXES:
            if len(w) > p:
                out["^" + w[:p]] += n
    return out


def learnable(doc_id: Column) -> Column:
    """Whether a row's label may be learned from."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id has the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class Model:
    """Terms, their weights, the block-max inverted index of the examples, and the calibration."""

    terms: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    # postings of term t in block b: entries at[t, b] to at[t, b + 1] of (example, value)
    at: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    most: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    base: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    # terms of words met before
    memory: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers, ascending, and counts of a text."""
        found: dict[int, int] = {}
        # no run of letters spans a blank
        words = text.lower().split() if text else []
        memory = self.memory
        new = set(words).difference(memory)
        if new:
            if len(memory) + len(new) > REMEMBERED:
                memory.clear()
                new = set(words)
            known = self.terms
            for w in new:
                memory[w] = tuple(
                    known[x]
                    for run in ((w,) if w.isalpha() else LETTERS.findall(w))
                    for x in (run, *("^" + run[:p] for p in PREFIXES if len(run) > p))
                    if x in known
                )
        for ids in filter(None, map(memory.__getitem__, words)):
            for i in ids:
                found[i] = found.get(i, 0) + 1
        order = sorted(found)
        return np.array(order, np.int32), np.array([found[i] for i in order], np.int32)

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF values of length 1."""
        w = (1 + np.log(counts)) * self.idf[terms]
        length = np.linalg.norm(w)
        return w / length if length > 0 else w

    def neighbours(self, terms: np.ndarray, weights: np.ndarray, without: int | None = None, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest cosine above zero and those cosines, largest first, exactly.

        A block's bound is the sum of its largest values per term. Blocks of the highest bounds are scored first;
        then those whose bound reaches the k-th cosine, and no others.
        """
        if len(terms) == 0 or len(self.ids) == 0:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.most[terms]
        score = np.zeros(len(self.ids))
        first = np.argpartition(-bound, min(FIRST, len(bound)) - 1)[:FIRST]
        self._add(score, terms, weights, first)
        if without is not None:
            score[without] = 0
        floor = np.partition(score, -k)[-k] if len(score) > k else 0.0
        # a little room, as a bound is a sum in another order
        rest = (bound > 0) & (bound >= floor - 1e-9)
        rest[first] = False
        rest = np.flatnonzero(rest)
        if len(rest):
            self._add(score, terms, weights, rest)
            if without is not None:
                score[without] = 0
        at = np.flatnonzero(score > 1e-12)
        if len(at) > k:
            cut = np.partition(score[at], -k)[-k]
            at = at[score[at] >= cut]
        at = at[np.lexsort((self.ids[at], -score[at]))][:k]
        return at, score[at]

    def _add(self, score: np.ndarray, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> None:
        every = len(blocks) > 8
        wanted = np.zeros(self.most.shape[1], bool)
        wanted[blocks] = True
        for t, w in zip(terms, weights):
            spans = [(self.at[t, 0], self.at[t, -1])] if every else [(self.at[t, b], self.at[t, b + 1]) for b in blocks]
            for a, z in spans:
                if z > a:
                    e, v = self.example[a:z], self.value[a:z]
                    if every:
                        keep = wanted[e // BLOCK]
                        e, v = e[keep], v[keep]
                    score[e] += w * v

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        """Share of the label among neighbours, weighted by cosine, with the base rate as one more voter."""
        return float((cosine @ self.labels[at] + BASE * self.base) / (cosine.sum() + BASE))

    def calibrated(self, vote: float) -> float:
        v = min(max(vote, 1e-6), 1 - 1e-6)
        return float(1 / (1 + np.exp(-(self.slope * np.log(v / (1 - v)) + self.shift))))

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        terms, counts = self.features(text)
        at, cosine = self.neighbours(terms, self.weigh(terms, counts))
        return self.calibrated(self.vote(at, cosine)), at, cosine


def build_index(model: Model, ids, labels, features: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Fill the inverted index. Examples are sorted by label and strongest term, so that blocks are alike inside."""
    weighed = [model.weigh(t, c) for t, c in features]
    lead = np.array([t[w.argmax()] if len(t) else -1 for (t, _), w in zip(features, weighed)])
    order = np.lexsort((np.asarray(ids), lead, np.asarray(labels)))
    model.ids, model.labels = np.asarray(ids, np.int64)[order], np.asarray(labels, float)[order]
    blocks = max(1, -(-len(order) // BLOCK))
    example = np.repeat(np.arange(len(order)), [len(features[i][0]) for i in order])
    term = np.concatenate([features[i][0] for i in order]) if len(order) else np.zeros(0, np.int64)
    value = np.concatenate([weighed[i] for i in order]) if len(order) else np.zeros(0)
    by = np.lexsort((example, term))
    model.example, model.value = example[by].astype(np.int32), value[by]
    key = term[by].astype(np.int64) * blocks + example[by] // BLOCK
    n = len(model.terms)
    edges = np.searchsorted(key, np.arange(n * blocks + 1))
    model.at = np.column_stack((edges[:-1].reshape(n, blocks), edges[blocks::blocks])) if n else np.zeros((0, blocks + 1), np.int64)
    model.most = np.zeros((n, blocks))
    np.maximum.at(model.most.reshape(-1), key, model.value)


def fit_calibration(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the votes' log-odds, with smoothed targets."""
    v = np.clip(votes, 1e-6, 1 - 1e-6)
    x = np.column_stack((np.log(v / (1 - v)), np.ones(len(v))))
    up, down = (labels == 1).sum(), (labels == 0).sum()
    y = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-3 * (w - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.05), float(w[1])


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on labelled rows that ``learnable`` admits.

    Terms and examples come from the ``per_class`` rows of each label with the smallest hash; document
    frequencies of the terms come from all documents; label totals from all learnable labels.
    """
    model = Model()
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    docs = documents.select("doc_id", "text")
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    model.base = (total.get(1, 0) + 0.5) / (sum(total.values()) + 2)
    by_hash = F.xxhash64(F.lit(5), "doc_id")
    parts = [known.filter(F.col("toxic") == y).orderBy(by_hash, "doc_id").limit(per_class) for y in (0, 1)]
    sample = stored(parts[0].union(parts[1]), "toxicity-sample")
    # at most twice per_class rows of an id and a label; of a repeated id one text counts
    chosen = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    chosen = stored(chosen, "toxicity-examples")
    each = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    n1, n0 = each.get(1, 0), each.get(0, 0)
    if not n1 or not n0:
        return model

    def count(piece: pd.DataFrame) -> pd.DataFrame:
        seen = Counter(), Counter()
        for text, toxic in zip(piece["text"], piece["toxic"]):
            seen[int(toxic)].update(terms_of(text).keys())
        every = list(seen[0].keys() | seen[1].keys())
        return pd.DataFrame({"term": every, "n0": [seen[0][t] for t in every], "n1": [seen[1][t] for t in every]})

    stats = map_texts(chosen, count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n = float(n0 + n1)
    chi2 = n * F.pow(b * n0 - a * n1, 2) / (F.lit(float(n0) * n1) * (a + b) * (n - a - b + 1))
    stats = stats.filter((a + b >= LEAST_DF) & (b * n0 >= LEAST_RATIO * n1 * a))
    top = stats.withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
    top = top.orderBy(F.desc("chi2"), "term").limit(TERMS).collect()
    model.terms = {r["term"]: i for i, r in enumerate(top)}
    if not top:
        return model
    terms = Model(terms=model.terms)

    def holds(piece: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(terms.terms), np.int64)
        for text in piece["text"]:
            seen[terms.features(text)[0]] += 1
        at = np.flatnonzero(seen)
        return pd.DataFrame({"term": at, "n": seen[at], "docs": 0}).pipe(
            lambda f: pd.concat((f, pd.DataFrame({"term": [-1], "n": [0], "docs": [len(piece)]})))
        )

    counts = map_texts(docs, holds, "term long, n long, docs long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).collect()
    every = sum(r["docs"] for r in counts)
    frequency = np.zeros(len(top))
    for r in counts:
        if r["term"] >= 0:
            frequency[r["term"]] = r["n"]
    model.idf = np.log((1 + every) / (1 + frequency)) + 1

    def example(piece: pd.DataFrame) -> pd.DataFrame:
        found = [terms.features(t) for t in piece["text"]]
        return pd.DataFrame({"doc_id": piece["doc_id"], "toxic": piece["toxic"], "t": [f[0] for f in found], "c": [f[1] for f in found]})

    # the sample's bound is what keeps this small on the driver
    examples = map_texts(chosen, example, "doc_id long, toxic int, t array<int>, c array<int>")
    rows = sorted(examples.collect(), key=lambda r: r["doc_id"])
    features = [(np.array(r["t"], np.int32), np.array(r["c"], np.int32)) for r in rows]
    build_index(model, [r["doc_id"] for r in rows], [r["toxic"] for r in rows], features)
    place = {int(d): i for i, d in enumerate(model.ids)}
    votes, toxic = np.zeros(len(rows)), np.array([r["toxic"] for r in rows])
    for i, (r, (t, c)) in enumerate(zip(rows, features)):
        votes[i] = model.vote(*model.neighbours(t, model.weigh(t, c), without=place[r["doc_id"]]))
    weight = np.where(toxic == 1, total[1] / n1, total[0] / n0)
    model.slope, model.shift = fit_calibration(votes, toxic, weight / weight.mean())
    return model


def score_texts(documents: DataFrame, model: Model, evidence: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every row: the nearest examples with cosine and label.

    One row per row that goes in; null and empty texts have no neighbours and score by the base rate alone;
    repeated rows repeat; a null id stays null; an empty table gives an empty result; other columns are ignored.
    """
    rows = documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(piece: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        score, shown = np.zeros(len(piece)), []
        for i, text in enumerate(piece["text"]):
            score[i], at, cosine = m.score(text)
            shown.append([{"doc_id": int(m.ids[j]), "cosine": float(c), "toxic": int(m.labels[j])} for j, c in zip(at[:evidence], cosine)])
        return pd.DataFrame({"doc_id": piece["doc_id"], "score": score, "evidence": shown})

    scored = map_texts(rows, work, f"doc_id {kind}, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    )


def toxicity(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Fit on ``labels`` and score every document. Without labels of both kinds every score is the base rate."""
    return score_texts(documents, fit(documents, labels, per_class))


def without_toxic(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores below 0.5."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, per_class))

    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        return text.map(lambda t: shared.value.score(t)[0] < 0.5).astype(bool)

    return documents.filter(clean(documents["text"]))
