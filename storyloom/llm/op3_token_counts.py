"""Token counts of whole texts under a word-end byte-pair vocabulary."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from storyloom.llm.common import map_texts
from storyloom.llm.ragged import PairTable, agenda, merge_counts

# Words whose counts a worker remembers; beyond that it starts anew.
REMEMBERED = 400_000
# Longer pre-tokens go through the queue, whose time grows as n log n.
LONG = 2_048
WHITE = r"\t-\r \x85\xa0  -     　"
# Fixed value: how the vocabulary's own tokenizer cuts a normalised text.
CUT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
SPACE = regex.compile(rf"[{WHITE}]+")
CONTROL = regex.compile(r"[\x1c-\x1f]")
# Words that are looked up together.
BATCH = 400_000


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where it prints, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class WordCounter:
    """Counts tokens of texts; one per worker and vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.table = PairTable(
            [vocab[a] for a, _ in pairs],
            [vocab[b] for _, b in pairs],
            np.arange(len(pairs)),
            [vocab[a + b] for a, b in pairs],
            max(vocab.values()) + 1,
        )
        letters, end = byte_letters(), spec["model"]["end_of_word_suffix"] or ""
        self.inside = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Add the counts of new words: cut into pre-tokens, merge all of those, sum per word."""
        tokens, owner = [], []
        for i, w in enumerate(words):
            if w.isalpha():
                tokens.append(w.encode("utf-8"))
                owner.append(i)
            else:
                cut = CUT.findall(w)
                tokens.extend(t.encode("utf-8") for t in cut)
                owner.extend([i] * len(cut))
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        counts = np.zeros(len(tokens), np.int64)
        for i in np.flatnonzero(lengths > LONG):
            b = tokens[i]
            counts[i] = len(agenda([*self.inside[list(b[:-1])].tolist(), int(self.last[b[-1]])], self.table))
        short = np.flatnonzero(lengths <= LONG)
        if len(short):
            flat = np.frombuffer(b"".join(tokens[i] for i in short), np.uint8)
            ends = np.cumsum(lengths[short]) - 1
            symbols = self.inside[flat]
            symbols[ends] = self.last[flat[ends]]
            counts[short] = merge_counts(symbols, lengths[short], self.table)
        sums = np.bincount(np.array(owner, np.int64), weights=counts, minlength=len(words)).astype(np.int64)
        self.known.update(zip(words, sums.tolist()))

    def words(self, text: str) -> list[str]:
        """Blank-separated words of a normalised text without special strings; no pre-token spans a blank."""
        # a capital sigma is lowered by itself, so that it never takes its word-end form
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # four control characters are blanks for split() but not for the vocabulary
        return SPACE.split(text) if CONTROL.search(text) else text.split()

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; new pre-tokens of all of them are merged together."""
        totals, held, size = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            parts = [text] if text else []
            if text and self.special and "<|" in text:
                parts = self.special.split(text)
                totals[i] = len(parts) - 1
            for part in parts:
                words = self.words(part)
                held.append((i, words))
                size += len(words)
                if size > BATCH:
                    self.add(totals, held)
                    held, size = [], 0
        self.add(totals, held)
        return totals

    def add(self, totals: list[int], held: list[tuple[int, list[str]]]) -> None:
        every = set().union(*(words for _, words in held))
        new = every.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = every
        if new:
            self.learn(list(new))
        for i, words in held:
            totals[i] += sum(map(self.known.__getitem__, words))


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 2_048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text.

    ``vocabulary`` is the path of a tokenizer file (byte-pair merges with word ends) that every
    executor has. Each worker holds pre-tokens as ragged arrays of byte symbols and merges each one's
    lowest-ranked pair in the same step (``ragged.merge_counts``); counts of words met before
    are remembered up to a fixed number; a pre-token longer than ``LONG`` bytes is merged through a queue.

    Nothing is shuffled and one row comes out per row that goes in: null and empty texts have 0
    bytes and tokens, repeated rows repeat, a null id stays null, other columns are ignored.
    Special strings inside a text count as one token each.
    """

    def work(piece: pd.DataFrame) -> pd.DataFrame:
        find = counter(vocabulary)
        n = np.array(find.counts(piece["text"].tolist()), np.int64)
        size = np.fromiter((len(t.encode("utf-8")) if t else 0 for t in piece["text"]), np.int64, len(piece))
        return pd.DataFrame({"doc_id": piece["doc_id"], "n_bytes": size, "n_tokens": n, "over_limit": n > limit})

    rows = documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
