"""SentencePiece (merge type) encoding with seeded merge-dropout, and lossless decoding."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
from xxhash import xxh64_intdigest as hashed
from pyspark.sql import Column, DataFrame, functions as F

from storyloom.llm.common import map_texts
from storyloom.llm.ragged import BITS, LOW, PairTable, Ragged, agenda, merge_leftmost, merged, span

SPACE_MARK = "▁"
# No piece has a blank after another character, so these chunks never merge with each other.
CHUNK = re.compile(r" *[^ ]+| +")
# Longer chunks go through the queue one by one. Places in a shorter one fit into the BITS of ``merge_leftmost``.
LONG = 48
# Characters that are encoded together; nothing is kept from one piece to the next.
PIECE = 1_000_000
NO_HIT = 1 << BITS
_M1, _M2, _GOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def keyed(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a chunk's key and the span of a candidate in it."""
    x = key + (start.astype(np.uint64) * np.uint64(1 << 32) + end.astype(np.uint64)) * _GOLD
    for m in (_M1, _M2):
        x = (x ^ (x >> np.uint64(33))) * m
    return x ^ (x >> np.uint64(33))


class Pieces:
    """The vocabulary of a model file, as pair table and byte strings."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(n)]
        self.n = n
        self.bytes_ = [0] * 256
        self.out: list[bytes] = []
        plain: dict[str, int] = {}
        for i, t in enumerate(texts):
            if model.is_byte(i):
                value = int(t[3:5], 16)
                self.bytes_[value] = i
                self.out.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.out.append(b"")
            else:
                plain[t] = i
                self.out.append(t.replace(SPACE_MARK, " ").encode("utf-8"))
        # a lower number comes first: best score first, equal scores share a number
        score = {i: model.get_score(i) for i in plain.values()}
        level = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        left, right, rank, made = [], [], [], []
        for t, i in plain.items():
            for cut in range(1, len(t)):
                a, b = plain.get(t[:cut]), plain.get(t[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(level[score[i]]), made.append(i)
        self.table = PairTable(left, right, rank, made, n)
        # one symbol per character; a character without a piece gets a number of its own below zero
        self.letter = {t.replace(SPACE_MARK, " "): i for t, i in plain.items() if len(t) == 1}
        self.letters = (-1 - np.arange(0x110000)).astype(np.int32)
        for c, i in self.letter.items():
            self.letters[ord(c)] = i

    def symbols(self, chunk: str) -> list[int]:
        return [self.letter.get(c, -1 - ord(c)) for c in chunk]

    def spelled(self, symbols: Ragged) -> Ragged:
        """Ids of the final symbols; characters without a piece become their bytes."""
        odd = np.flatnonzero(symbols.flat < 0)
        if not len(odd):
            return symbols
        point = -1 - symbols.flat[odd]
        wide = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        size = np.ones(len(symbols.flat), np.int64)
        size[odd] = wide
        out, begin = np.repeat(symbols.flat, size), (np.cumsum(size) - size)[odd]
        at = np.arange(wide.sum()) + np.repeat(begin - (np.cumsum(wide) - wide), wide)
        raw = np.frombuffer("".join(map(chr, point.tolist())).encode("utf-8"), np.uint8)
        out[at] = np.array(self.bytes_, np.int32)[raw]
        grown = np.bincount(np.searchsorted(symbols.first + symbols.size, odd, side="right"), weights=wide - 1, minlength=len(symbols.size))
        return Ragged(out, symbols.size + grown.astype(np.int64))

    def cut(self, chunks: list[str], which: np.ndarray, keys: np.ndarray, bar: np.uint64) -> tuple[np.ndarray, Ragged]:
        """Number of the segmentation of each occurrence (``which`` chunk, and its key), and the segmentations.

        A tree per chunk: its agenda without skips meets candidates in an order, and as long as none of them is skipped it
        goes on as it would. So an occurrence is hashed against those only; the first that its key skips leads to the node
        of the agenda without this candidate, and so on. A node begins where its parent met the candidate, with the merges
        made until then, and is worked out once for all its occurrences.
        """
        flat = self.letters[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        symbols = Ragged(flat, np.array([len(c) for c in chunks], np.int64))
        ends = Ragged(np.arange(len(flat)) - np.repeat(symbols.first, symbols.size) + 1, symbols.size)
        # of one level's nodes: what they begin with, skipped spans, and merges; ``found`` and ``nodes`` of all levels
        left_out, found, nodes = np.zeros((0, len(chunks)), np.int64), [], 0
        at, active = which.copy(), np.arange(len(which))
        while True:
            merges = merge_leftmost(symbols, ends, self.table, left_out)
            value, end = merged(symbols, ends, merges.flat, merges.size)
            stay = end.flat > 0
            found.append((value.flat[stay], np.add.reduceat(stay, symbols.first, dtype=np.int64)))
            node = at[active] - nodes
            n = merges.size[node] if bar else np.zeros(len(active), np.int64)
            active, node, n = active[n > 0], node[n > 0], n[n > 0]
            if not len(active):
                break
            begin = np.cumsum(n) - n
            code = span(merges.flat[merges.places(node, n)])
            hit = keyed(np.repeat(keys[active], n), code >> BITS, code & LOW) < bar
            place = np.arange(len(code)) - np.repeat(begin, n)
            met = np.minimum.reduceat(np.where(hit, place, NO_HIT), begin)
            active, node, met = active[met < NO_HIT], node[met < NO_HIT], met[met < NO_HIT]
            if not len(active):
                break
            codes, child = np.unique((node << BITS) | met, return_inverse=True)
            nodes += len(symbols.size)
            at[active] = nodes + child
            parent, j = codes >> BITS, codes & LOW
            left_out = np.concatenate((left_out[:, parent], span(merges.flat[merges.first[parent] + j])[None]))
            symbols, ends = merged(symbols.of(parent), ends.of(parent), merges.flat[merges.places(parent, j)], j)
        return at, Ragged(*(np.concatenate(x) for x in zip(*found)))

    def encode(self, texts: list[str | None], dropout: float, seed: int, ids: list | int = 0) -> list[np.ndarray]:
        """Ids of each text. Each occurrence of a chunk is cut by a key of its own: of seed, document (id and text) and place."""
        bar = np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))
        split = [CHUNK.findall(" " + t) if t else [] for t in texts]
        every = list(chain.from_iterable(split))
        if not every:
            return [np.zeros(0, np.int32) for _ in texts]
        sizes = np.array([len(x) for x in split], np.int64)
        ids = ids if isinstance(ids, list) else [ids] * len(texts)
        of_text = np.array([hashed(t, hashed(repr(i), seed)) if t else 0 for i, t in zip(ids, texts)], np.uint64)
        place = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = keyed(np.repeat(of_text, sizes), place, np.full(len(every), -1))
        which, chunks = pd.factorize(np.array(every, object))
        long = np.array([len(c) > LONG for c in chunks])
        # long chunks take the queue, and a blank their place in the tables
        at, found = self.cut([" " if x else c for c, x in zip(chunks.tolist(), long.tolist())], which, keys, bar)
        more = []
        for i in np.flatnonzero(long[which]).tolist():
            k = keys[i : i + 1]
            skip = (lambda a, b: bool(keyed(k, np.array([a]), np.array([b]))[0] < bar)) if bar else None  # noqa: B023
            at[i] = len(found.size) + len(more)
            more.append(np.array(agenda(self.symbols(every[i]), self.table, skip), np.int32))
        if more:
            found = Ragged(np.concatenate((found.flat, *more)), np.append(found.size, [len(x) for x in more]))
        symbols = self.spelled(found).of(at)
        ends = np.cumsum(np.bincount(np.repeat(np.arange(len(texts)), sizes), weights=symbols.size, minlength=len(texts)).astype(np.int64))
        return np.split(symbols.flat, ends[:-1])

    def decode(self, ids) -> str:
        raw = b"".join(map(self.out.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _placed(rows: DataFrame) -> DataFrame:
    """With ``place``, a number of id and text that does not depend on how rows are dealt into batches."""
    return rows.withColumn("place", F.xxhash64("doc_id", "text"))


def encode(
    documents: DataFrame, model: str, dropout: float = 0.1, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Ids (array<int>) of every whole text under a merge-type SentencePiece model.

    Candidates leave the agenda best score first, then leftmost; each is skipped with
    probability ``dropout``, decided by a hash of seed, document (id and text), place of the chunk in it and span, so that
    reruns agree and each occurrence of a word is cut on its own. Rate 0 gives the model's own encoding (but
    for a literal U+2581, which is spelled in bytes so that it decodes as itself).

    Nothing is shuffled. One row comes out per row that goes in: null and empty texts have an empty
    array, repeated rows repeat, a null id stays null, other columns are ignored.
    """

    def work(piece: pd.DataFrame) -> pd.DataFrame:
        ids = pieces(model).encode(piece["text"].tolist(), dropout, seed, piece["place"].tolist())
        return pd.DataFrame({"doc_id": piece["doc_id"], "ids": ids})

    rows = _placed(documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, work, f"doc_id {kind}, ids array<int>", limit=PIECE)


def decode(ids: Column, model: str) -> Column:
    """Text of an id array; null stays null."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        find = pieces(model)
        return column.map(lambda x: None if x is None else find.decode(x))

    return run(ids)


def segmentations(
    documents: DataFrame, model: str, dropout: float = 0.1, seed: int = 42,
) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids (4 little-endian bytes each), and whether they decode to the text.

    Same cases as ``encode``; a null text counts as empty.
    """

    def work(piece: pd.DataFrame) -> pd.DataFrame:
        find = pieces(model)
        ids = find.encode(piece["text"].tolist(), dropout, seed, piece["place"].tolist())
        return pd.DataFrame(
            {
                "doc_id": piece["doc_id"],
                "n_ids": np.array([len(x) for x in ids], np.int64),
                "ids_sha256": [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids],
                "lossless": [find.decode(x) == (t or "") for x, t in zip(ids, piece["text"])],
            }
        )

    rows = _placed(documents.select("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, work, f"doc_id {kind}, n_ids long, ids_sha256 string, lossless boolean", limit=PIECE)
