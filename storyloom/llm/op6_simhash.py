"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from storyloom.llm.common import digest, folded_words, map_texts, stored
from storyloom.llm.components import components

BITS = 64
SEED = 42
# A bucket with more fingerprints gets masks of its own over the bits that it leaves free. One that has
# gone through both levels holds at most 2**14 different fingerprints.
LARGE = 1 << 14
# Shingles that are counted together.
SPAN = 200_000


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks such that any two words that differ in at most ``radius`` of ``bits`` agree under one of them.

    Bit i gets a code i mod (2**(radius+1) - 1) + 1 of radius+1 bits; mask v, for each such v but zero,
    holds the bits whose code has an odd product with v. Up to ``radius`` codes leave some v
    orthogonal to all of them, and that mask holds none of the differing bits.
    """
    codes = 1 << (radius + 1)
    return [
        sum(1 << b for i, b in enumerate(bits) if ((i % (codes - 1) + 1) & v).bit_count() % 2)
        for v in range(1, codes)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits: bit b is 1 if it is set in over half of the hashes of the word shingles, repeats included."""
    w = folded_words(text)
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(w) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    counts, n = np.zeros(BITS, np.int64), len(starts)
    for a in range(0, n, SPAN):
        spans = zip(starts[a : a + SPAN], ends[a : a + SPAN])
        h = np.array([xxh64_intdigest(joined[i:j], SEED) for i, j in spans], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(rows: DataFrame, words: int = 3) -> DataFrame:
    """``text`` of the rows replaced by ``fp``, the fingerprint as a signed long."""
    others = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others) + ", fp long"

    def work(piece: pd.DataFrame) -> pd.DataFrame:
        found = np.fromiter((_signed(fingerprint(t, words)) for t in piece["text"]), np.int64, len(piece))
        return piece[[f.name for f in others]].assign(fp=found)

    return map_texts(rows, work, schema)


def forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what pairs within ``radius`` bits connect; at most one per fingerprint.

    Grows one tree after another: the fingerprints within reach of the front join it.
    """
    free = fps.view(np.uint64)
    while len(free) > 1:
        root, front, free = free[0], free[:1], free[1:]
        while len(front) and len(free):
            step, front = front[:256], front[256:]
            near = np.zeros(len(free), bool)
            for a in range(0, len(step), 16):
                left = np.flatnonzero(~near)
                apart = np.bitwise_count(free[left] ^ step[a : a + 16, None])
                near[left[(apart <= radius).any(axis=0)]] = True
            if near.any():
                found, free = free[near], free[~near]
                front = np.concatenate((front, found))
                for x in found.view(np.int64).tolist():
                    yield x, int(root.view(np.int64))


def _bucket_links(keyed: DataFrame, radius: int) -> DataFrame:
    """Links within the buckets of (t, k, fp) rows; a bucket is met as one run of sorted rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def links(frame: pd.DataFrame) -> pd.DataFrame:
            t, k, fp = (frame[c].to_numpy() for c in ("t", "k", "fp"))
            cut = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            cut = np.concatenate(([0], cut, [len(fp)]))
            found: list[tuple[int, int]] = []
            for i in np.flatnonzero(np.diff(cut) > 1):
                found.extend(forest(fp[cut[i] : cut[i + 1]], radius))
            return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        for batch in batches:
            if len(batch) == 0:
                continue
            # the last bucket of a batch may go on in the next one
            last = batch.iloc[-1]
            same = ((batch["t"] == last["t"]) & (batch["k"] == last["k"])).to_numpy()
            if not same.all():
                begin = int(np.flatnonzero(~same)[-1]) + 1
                yield links(pd.concat([*held, batch.iloc[:begin]]))
                held = [batch.iloc[begin:]]
            else:
                held.append(batch)
                first = held[0].iloc[0]
                if (first["t"], first["k"]) != (last["t"], last["k"]):
                    whole = pd.concat(held)
                    same = ((whole["t"] == last["t"]) & (whole["k"] == last["k"])).to_numpy()
                    yield links(whole[~same])
                    held = [whole[same]]
        if held:
            yield links(pd.concat(held))

    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartition(parts, "t", "k").sortWithinPartitions("t", "k", "fp")
    return ordered.mapInPandas(run, "a long, b long")


def hamming_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) between different fingerprints (column ``fp``, each once) that connect all pairs within ``radius`` bits.

    Every pair within the radius shares a bucket of some mask, where it is compared or already connected.
    A bucket above ``LARGE`` is spread by masks over the bits that its own mask leaves open.
    """
    masks = covering_masks(list(range(BITS)), radius)
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in enumerate(masks)))
    keyed = fps.select("fp", F.explode(keys).alias("x")).select("x.t", "x.k", "fp")
    large = stored(keyed.groupBy("t", "k").count().filter(F.col("count") > LARGE).select("t", "k"), "large-buckets")
    if large.isEmpty():
        return _bucket_links(keyed, radius)
    rest = [[b for b in range(BITS) if not m >> b & 1] for m in masks]
    fine = [covering_masks(bits, radius) for bits in rest]
    table = F.from_json(F.lit(str([[_signed(m) for m in row] for row in fine])), "array<array<bigint>>")
    finer = F.transform(
        F.get(table, F.col("t")),
        lambda m, i: F.struct(
            (F.lit(len(masks)) * (F.col("t") + 1) + i).alias("t"), F.col("k").bitwiseOR(F.col("fp").bitwiseAND(m)).alias("k")
        ),
    )
    spread = keyed.join(large, ["t", "k"], "left_semi").select("fp", F.explode(finer).alias("x")).select("x.t", "x.k", "fp")
    return _bucket_links(keyed.join(large, ["t", "k"], "left_anti").union(spread), radius)


def _classes(prints: DataFrame, first: Column, radius: int) -> DataFrame:
    """(fp, best): the smallest ``first`` of the component of each fingerprint."""
    fps = stored(prints.groupBy("fp").agg(first.alias("low")), "fingerprint-classes")
    roots = components(hamming_links(fps.select("fp"), radius), "fingerprint-links")
    roots = stored(roots.withColumnRenamed("node", "fp"), "fingerprint-roots")
    best = roots.join(fps, "fp").groupBy("root").agg(F.min("low").alias("best"))
    linked = roots.join(best, "root").select("fp", "best")
    # written, so that the join of documents with it reads two plain tables and a fingerprint of many copies can be split
    return stored(fps.join(linked, "fp", "left").select("fp", F.coalesce("best", "low").alias("best")), "fingerprint-best")


def near_duplicates(
    documents: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: fingerprint (16 hexadecimal digits) and the smallest id of its component.

    Texts with one fingerprint form a class; classes are linked at ``radius`` or fewer differing bits, and
    components are taken over the links. Whole texts are read once, without a shuffle; after that, rows
    hold an id and a fingerprint. Copies are never expanded into pairs.

    One row per row that goes in. Null and empty texts have fingerprint zero and are linked
    like any other; a null id takes part but is never a component's id, unless the component has no other;
    repeated rows repeat; an empty table gives an empty result; other columns are ignored.
    """
    rows = documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text"))
    prints = stored(fingerprints(rows, words), "fingerprints")
    classes = _classes(prints, F.min("doc_id"), radius)
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("best").alias("component_id")
    )


def keep_one(documents: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``documents``, all columns, with one row of each near-duplicate group.

    Groups are the components over fingerprints within ``radius`` bits.

    The row with the smallest doc_id stays (a null id counts as the largest; of rows with one id, the one with the
    smallest text digest). Null and empty texts form a group like any other. Fully repeated rows leave one.
    """
    d = documents
    whole = d.select(F.struct(*(d[f"`{c}`"] for c in d.columns)).alias("row"))
    key = digest(F.col("row.doc_id"), F.col("row.text"))
    rows = whole.select(
        F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc_id"), key[0].alias("h1"), key[1].alias("h2")).alias("id"),
        F.col("row.text").alias("text"),
    )
    classes = _classes(stored(fingerprints(rows, words), "fingerprints"), F.min("id"), radius)
    best = classes.select(F.col("best.h1").alias("h1"), F.col("best.h2").alias("h2")).distinct()
    found = whole.withColumn("h1", key[0]).withColumn("h2", key[1]).join(best, ["h1", "h2"], "left_semi")
    return found.dropDuplicates(["h1", "h2"]).select("row.*")
