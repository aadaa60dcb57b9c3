"""Stupid-backoff scores of documents from n-gram counts of the whole corpus."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from storyloom.llm.common import _FOLD, BLANKS, scale_count

# Bytes of text whose n-grams are taken in one task, about, and bytes of text per part of the count tables.
BLOCK, BUCKET = 2_000_000, 8_000_000
# Parts and blocks at least, so that a small table still spreads.
LEAST = 24
_IS_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))
# Values of the hash: any fixed odd multipliers and a fixed random number per byte will do.
_ODD, _STEP = 0x9E3779B97F4A7C15 | 1, np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_BACK = pow(_ODD, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    for m in (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(33))) * m
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z lowered) of some texts, in order, and the number of its text.

    A word's hash is a polynomial of its bytes, so that running sums over all bytes give all words at once.
    """
    raw = [t.encode("utf-8") if t else b"" for t in texts]
    data = np.frombuffer((b" ".join(raw) + b" ").translate(_FOLD), np.uint8)
    word = ~_IS_BLANK[data]
    edge = np.diff(np.concatenate(([False], word)).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_ODD, len(data)), out=sums[1:])
    h = (sums[end] - sums[start]) * _powers(_BACK, len(data))[start] + (end - start).astype(np.uint64) * _STEP
    first = np.cumsum([0, *(len(r) + 1 for r in raw)])[:-1]
    return mix(h), np.searchsorted(first, start, side="right") - 1


def grams(texts: list[str | None], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each word, for 0 to ``order`` words; the word's text; its place in the text.

    A word whose text has fewer words before it has zero there. The empty n-gram ends at every word.
    """
    h, text = word_hashes(texts)
    new = np.concatenate(([True], text[1:] != text[:-1])) if len(text) else np.zeros(0, bool)
    at = np.arange(len(text))
    place = at - np.maximum.accumulate(np.where(new, at, 0)) if len(text) else at
    levels = [np.full(len(h), np.uint64(1)), h]
    for k in range(2, order + 1):
        g = np.zeros(len(h), np.uint64)
        g[1:] = mix(levels[-1][:-1] * _STEP + h[1:] + np.uint64(k))
        g[place < k - 1] = 0
        levels.append(g)
    return levels[: order + 1], text, place


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers with their first bytes together, then their second ones: small numbers then compress well."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1).astype(np.int64)


def _bounds(buckets: int) -> np.ndarray:
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def _scores(texts: list[str | None], totals: np.ndarray, distinct: np.ndarray, order: int, alpha: float, leave_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log scores, and words, of each text."""
    levels, text, place = grams(texts, order)
    n = len(texts)
    words = np.bincount(text, minlength=n)
    if len(text) == 0:
        return np.zeros(n), words
    counts = []
    for g in levels:
        at = np.searchsorted(distinct, g)
        at[at >= len(distinct)] = 0
        c = np.where(g == 0, 0, totals[at]).astype(np.float64)
        if leave_out:
            # what the text itself holds of each n-gram
            _, inverse, own = np.unique(text * np.int64(len(distinct) + 1) + at, return_inverse=True, return_counts=True)
            c -= np.where(g == 0, 0, own[inverse])
        counts.append(c)
    score = np.zeros(len(text))
    open_ = np.ones(len(text), bool)
    top = np.minimum(place + 1, order)
    for k in range(order, 0, -1):
        before = np.concatenate(([0.0], counts[k - 1][:-1])) if k > 1 else counts[0]
        hit = open_ & (top >= k) & (counts[k] > 0)
        score[hit] = (top[hit] - k) * np.log(alpha) + np.log(counts[k][hit] / before[hit])
        open_ &= ~hit
    score[open_] = (top[open_] - 1) * np.log(alpha) - np.log(counts[0][open_] + 1)
    return np.bincount(text, weights=score, minlength=n), words


def score_documents(
    documents: DataFrame, order: int = 2, alpha: float = 0.4, leave_out: bool = True,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Stupid-backoff log scores of every whole text under n-gram counts of all texts.

    A word scores c(n-gram) / c(its context) at the longest n-gram that the rest of the corpus holds, times
    ``alpha`` for each word of context given up; a word found nowhere scores as 1 / (words + 1). With
    ``leave_out`` a document's own n-grams are taken from the counts, so that a text is judged by the others.

    The relations are explode -> count per hash -> join -> sum per document, with rows packed: documents are dealt
    into blocks by hash; a block sends its distinct n-gram hashes with their counts, one row for each part of the
    hash range; a part sums the counts of all blocks, which is its slice of the count tables, and answers each
    block; the block joins the answers to its n-grams by hash and sums per document. A frequent n-gram is one
    entry per block. Blocks and parts grow in number with the text, not in size. Hashes have 64 bits.

    One row per row that goes in: doc_id, n_words, score (sum of logs), mean_log. Null and empty texts have 0 words,
    score 0 and a null mean; repeated rows are documents of their own; a null id stays null; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = scale_count(size, BLOCK, LEAST), scale_count(size, BUCKET, LEAST)
    bounds = _bounds(buckets)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def distinct_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        levels, _, _ = grams(texts, order)
        found, count = np.unique(np.concatenate(levels), return_counts=True)
        keep = found != 0
        return found[keep], count[keep]

    def ask(part: pd.DataFrame) -> pd.DataFrame:
        found, count = distinct_of(part["text"].tolist())
        cut = np.concatenate(([0], np.searchsorted(found, bounds), [len(found)]))
        full = np.flatnonzero(np.diff(cut))
        return pd.DataFrame(
            {
                "bucket": full.astype(np.int32),
                "block": np.int32(part["block"].iloc[0]),
                "grams": [found[cut[b] : cut[b + 1]].tobytes() for b in full],
                "counts": [_planes(count[cut[b] : cut[b + 1]]) for b in full],
            }
        )

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(g, np.uint64) for g in part["grams"]]
        count = np.concatenate([_from_planes(c) for c in part["counts"]])
        found, inverse = np.unique(np.concatenate(each), return_inverse=True)
        totals = np.bincount(inverse, weights=count, minlength=len(found)).astype(np.int64)[inverse]
        ends = np.cumsum([len(g) for g in each])
        return pd.DataFrame(
            {"block": part["block"], "bucket": part["bucket"], "totals": [_planes(totals[e - len(g) : e]) for g, e in zip(each, ends)]}
        )

    def score(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = part["text"].tolist()
        found, _ = distinct_of(texts)
        totals = np.concatenate([np.zeros(0, np.int64), *map(_from_planes, answers.sort_values("bucket")["totals"])])
        if len(totals) != len(found):
            raise ValueError(f"{len(totals)} counts for {len(found)} n-grams")
        total, words = _scores(texts, totals, found, order, alpha, leave_out)
        mean = [t / w if w else None for t, w in zip(total.tolist(), words.tolist())]
        return pd.DataFrame({"doc_id": part["doc_id"], "n_words": words, "score": total, "mean_log": mean})

    asked = rows.groupBy("block").applyInPandas(ask, "bucket int, block int, grams binary, counts binary")
    answers = asked.groupBy("bucket").applyInPandas(answer, "block int, bucket int, totals binary")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(score, f"doc_id {kind}, n_words long, score double, mean_log double")
    )
