"""Every corpus operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import itertools
import random
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from storyloom.llm.common import stored
from storyloom.llm.op1_lm_scoring import score_documents
from storyloom.llm.grid import floors
from storyloom.llm.op2_ann import nearest
from storyloom.llm.op3_token_counts import counter, token_counts
from storyloom.llm.op4_mixing import mix, mixed
from storyloom.llm.op5_toxicity import fit, score_texts, toxicity, without_toxic
from storyloom.llm.op6_simhash import BITS, covering_masks, fingerprint, forest, hamming_links, keep_one, near_duplicates
from storyloom.llm.op7_line_dedup import line_dedup, without_shared_lines
from storyloom.llm.op8_licences import KNOWN, licence_scan
from storyloom.llm.op9_exact_topk import top_products
from storyloom.llm.op10_sentencepiece import decode, encode, keyed, pieces, segmentations
from storyloom.llm.ragged import LOW, PairTable, Ragged, agenda, merge_leftmost, merged

WORD_FILE, PIECE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, score double, key string, h1 long"
LONG = "the long text goes on " * 5_000
SHARED = "a line that several documents share"
ROWS = [
    (1, "one two three four five six", "en", "a"),
    (2, "one two three four five six", "en", "a"),
    (2, "one two three four five six", "en", "a"),
    (3, None, None, None),
    (None, f"no id here\n{SHARED}", "en", "b"),
    (4, "", "", ""),
    (5, " \t\n ", "en", "b"),
    (6, LONG, None, "c"),
    (7, f"{SHARED}\nmine", "fr", "c"),
    (8, f"own\n  A Line that several documents share\t\n{SHARED}\n", "fr", "a"),
    (None, None, None, None),
    (9, "é▁ 日本 <|endoftext|> 😀  x", "de", "é"),
]
DOCS = [(i, t, lang, s, len(t or ""), "r", 5, 0.5, "k", 1) for i, t, lang, s in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return stored(spark.createDataFrame(DOCS, SCHEMA), "odd-documents")


@pytest.fixture(scope="module")
def none(spark):
    return stored(spark.createDataFrame([], SCHEMA), "no-documents")


def lists(arrays):
    return [x.tolist() for x in arrays]


def by_row(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_lm_scoring(docs, none):
    got = by_row(score_documents(docs), "doc_id", "n_words", "score", "mean_log")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t, _, _ in ROWS]
    grams = [{n: [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] for n in (1, 2)} for w in words]
    count = lambda skip, g: sum(x[len(g)].count(g) for k, x in enumerate(grams) if k != skip)
    want = []
    for k, ((i, _, _, _), w) in enumerate(zip(ROWS, words)):
        total, known = sum(len(x) for j, x in enumerate(words) if j != k), {}
        score = 0.0
        for j, x in enumerate(w):
            pair = tuple(w[j - 1 : j + 1]) if j else None
            if (pair, x) not in known:
                two = count(k, pair) if pair else 0
                one = count(k, (x,))
                back = np.log(0.4) if pair else 0.0
                known[pair, x] = np.log(two / count(k, (w[j - 1],))) if two else back + (np.log(one / total) if one else -np.log(total + 1))
            score += known[pair, x]
        want.append((i, len(w), score))
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=repr)]
    assert np.allclose(sorted(g[2] for g in got), sorted(w[2] for w in want))
    assert all((g[3] is None) == (g[1] == 0) for g in got)
    assert score_documents(none).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).astype(float).tolist()) for i in range(120)]
    rows += [(200, None), (201, [0.0] * 8), (220, [float("nan")] * 8), (240, [None] * 8), (260, [1.0] * 3), (280, [float("inf")] * 8)]
    return rows + [(300 + i, rows[7][1]) for i in range(4)] + [(None, rows[3][1])]


def brute(rows, every, k, score, ok):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and ok(v)]
    out = set()
    for q, v in good:
        if q % every == 0:
            best = sorted(((-score(v, w), i) for i, w in good if i != q))[:k]
            out |= {(q, n + 1, i) for n, (_, i) in enumerate(best)}
    return out


def test_nearest(spark):
    rows = vector_rows()
    want = brute(rows, 20, 20, lambda a, b: float((a * b).sum()), any)
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(vectors(spark, rows)).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)
    # huge components, in ordinary rows' company
    rows += [(1_000, [1e30] + [0.0] * 7), (1_001, [0.0, 3e12] + [0.0] * 6), (1_020, [0.0, 0.0, -1e19] + [0.0] * 5)]
    want = brute(rows, 20, 20, lambda a, b: float((a * b).sum()), any)
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(vectors(spark, rows)).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)
    assert nearest(vectors(spark, [])).count() == 0
    assert nearest(vectors(spark, rows[:1])).count() == 0


def test_top_products(spark):
    rows = vector_rows()
    whole = lambda a, b: int((np.floor(256 * a) * np.floor(256 * b)).sum())
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in top_products(vectors(spark, rows)).collect()}
    assert got == brute(rows, 50, 5, whole, lambda v: True)
    assert top_products(vectors(spark, [])).count() == 0
    big = top_products(vectors(spark, [(0, [1e30, 1e30]), (1, [1e30, 1e30]), (2, [-1e30, 1.0])])).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(big, key=lambda r: r["rank"])] == [(1, 2**63 - 1), (2, -(2**63))]


def test_searches_over_more_rows_than_the_sample(spark):
    rng = np.random.default_rng(11)
    middles = rng.standard_normal((30, 24))
    rows = [(i, (middles[i % 30] + 0.4 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(3_000)]
    frame = vectors(spark, rows)
    v = np.array([r[1] for r in rows], np.float32).astype(float)

    def best(q, of, k):
        score = of @ of[q]
        return [(q, n + 1, int(i)) for n, i in enumerate([i for i in np.lexsort((np.arange(len(of)), -score)) if i != q][:k])]

    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in top_products(frame).collect()}
    assert got == {x for q in range(0, 3_000, 50) for x in best(q, np.floor(256 * v), 5)}
    got = {(r["query_id"], r["vec_id"]) for r in nearest(frame).collect()}
    want = {(q, i) for q in range(0, 3_000, 20) for q, _, i in best(q, v, 20)}
    assert len(got & want) >= 0.97 * len(want) and len(got) == len(want)


def test_floors_are_reached_by_k_other_rows():
    rng = np.random.default_rng(2)
    v = np.floor(256 * rng.standard_normal((70, 8)))
    ids = np.arange(70)
    got = floors(v, ids, ids[:40], v[:40], 5)
    exact = np.where(ids[:40] == ids[:, None], -np.inf, v @ v[:40].T)
    fifth = np.sort(exact, axis=1)[:, -5]
    assert (got <= fifth).all() and np.allclose(got, fifth, rtol=1e-6, atol=1)
    assert (floors(v, ids, ids[:4], v[:4], 5) == -np.inf).all()
    assert (floors(v, ids, ids[:5], v[:5], 5)[:5] == -np.inf).all()


def test_token_counts(docs, none):
    library = tokenizers.Tokenizer.from_file(WORD_FILE)
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in ROWS), key=repr)
    got = token_counts(docs, WORD_FILE)
    assert by_row(got, "doc_id", "n_bytes", "n_tokens") == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got.collect())
    assert token_counts(none, WORD_FILE).count() == 0
    rng = random.Random(5)
    texts = ["".join(rng.choice("abAB's 'tΣσ12é́ \n\x1cß…一<|>") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["x" * 9_000, "etaoin" * 900]
    assert counter(WORD_FILE).counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_mix(docs, none):
    got = mix(docs).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((i or -1, words(t)) for i, t, _, _ in ROWS)
    total = sum(r["size"] for r in got)
    for target in {r["target"] for r in got}:
        taken = sum(r["taken"] for r in got if r["target"] == target)
        sources = {r["source_size"] for r in got if r["target"] == target}
        assert abs(taken - len(sources) * target) <= len(sources) or target == 0
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert sum({(r["source_size"], r["target"]): r["target"] for r in got}.values()) <= total + 1
    assert mix(none).count() == 0
    again = mixed(docs)
    assert again.columns == docs.columns and all(r["text"] and r["text"].strip() for r in again.collect())
    assert mixed(none).count() == 0


def test_toxicity(spark, docs, none):
    rng = random.Random(2)
    clean = ["".join(rng.choice(["al", "be", "co", "de"]) for _ in range(3)) for _ in range(60)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 1
        words = [rng.choice(clean) for _ in range(30)] + ["vileword", "nastyword"] * bad
        rows.append((i, " ".join(words), None, None, 0, "r", 1, 0.0, "k", 0))
        labels.append((i, 1 if bad else 0, "x"))
    table = stored(spark.createDataFrame(rows, SCHEMA), "toxic-documents")
    known = spark.createDataFrame(labels + [(None, 1, "x"), (3, None, "x"), (7, 0, "y")], "doc_id long, toxic int, text string")
    got = toxicity(table, known).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 1) for r in got) >= 0.97 * len(got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    model = fit(table, known)
    terms, counts = model.features("vileword " + rows[6][1])
    weights = model.weigh(terms, counts)
    dense = np.zeros((len(model.ids), len(model.terms)))
    for t in range(len(model.terms)):
        a, z = model.at[t, 0], model.at[t, -1]
        dense[model.example[a:z], t] = model.value[a:z]
    cosine = dense[:, terms] @ weights
    at, best = model.neighbours(terms, weights)
    assert np.allclose(best, np.sort(cosine[cosine > 1e-12])[::-1][: len(best)])
    odd = score_texts(docs, model).collect()
    assert len(odd) == len(DOCS) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity(none, known).count() == 0
    assert toxicity(docs, known.limit(0)).count() == len(DOCS)
    left = without_toxic(table, known)
    assert left.columns == table.columns and 300 <= left.count() <= 330


def test_covering_masks():
    masks = covering_masks(list(range(BITS)), 3)
    assert len(masks) == 15
    for bits in itertools.combinations(range(BITS), 3):
        assert any(not m & sum(1 << b for b in bits) for m in masks)


def brute_prints():
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for i, t, _, _ in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    return out


def test_near_duplicates(docs, none):
    got = near_duplicates(docs)
    assert by_row(got, "doc_id", "fingerprint") == sorted(((i, f"{f:016x}") for i, f in brute_prints()), key=repr)
    root = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got.collect()}
    assert {root[k] for k in root if k[0] in (1, 2)} == {1} and {root[k] for k in root if k[0] in (3, 4, 5)} == {3}
    assert near_duplicates(none).count() == 0
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({v for v in root.values()})
    assert keep_one(none).count() == 0


def test_links_keep_components(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 5))) % (1 << 64) for b in base for _ in range(20)}
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    links = hamming_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).collect()

    def groups(pairs):
        parent = {signed(f): signed(f) for f in fps}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[top(a)] = top(b)
        seen = {}
        for f in parent:
            seen.setdefault(top(f), set()).add(f)
        return sorted(map(sorted, seen.values()))

    near = [(signed(a), signed(b)) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 3]
    assert groups((r["a"], r["b"]) for r in links) == groups(near)


def test_large_bucket(spark, monkeypatch):
    import storyloom.llm.op6_simhash as op6

    monkeypatch.setattr(op6, "LARGE", 8)
    fps = [1 << b for b in range(0, 40)] + [0]
    links = hamming_links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    reached, front = {0}, {0}
    both = {(r["a"], r["b"]) for r in links} | {(r["b"], r["a"]) for r in links}
    while front:
        front = {b for a, b in both if a in front} - reached
        reached |= front
    assert reached == set(fps)
    assert len(list(forest(np.array(fps), 3))) == len(fps) - 1


def test_fingerprint_of_long_text():
    assert fingerprint("a b c d " * 150_000) == fingerprint("a b c d " * 150_000) != 0


def test_line_dedup(docs, none):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(low)
    order = lambda i: float("inf") if i is None else i
    holders = {}
    for i, t, _, _ in ROWS:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(order(i))
    want = []
    for i, t, _, _ in ROWS:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(i)]
        want.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    got = line_dedup(docs)
    assert by_row(got, "doc_id", "text", "n_lines", "n_dropped") == sorted(want, key=repr)
    assert by_row(line_dedup(docs, min_docs=3), "doc_id", "n_dropped") != by_row(got, "doc_id", "n_dropped")
    assert line_dedup(none).count() == 0
    same = without_shared_lines(docs)
    assert same.columns == docs.columns and same.schema == docs.schema
    assert sorted((r["text"] or "", r["doc_id"] or 0) for r in same.collect()) == sorted((t, i or 0) for i, t, _, _ in want)


def test_licence_scan(spark, docs, none):
    mit = KNOWN["MIT"][-1]
    texts = [mit.upper().replace(",", ""), mit.replace("<year>", "2019"), mit[:-30], "x\n# licensed under the MIT Licence!\ny", "SPDX-License-Identifier: ISC", None]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text_licence"], r["line_licences"], r["n_lines"]) for r in licence_scan(table).collect()}
    assert [got[i][0] for i in range(6)] == ["MIT", "MIT", None, None, "ISC", None]
    assert got[3][1:] == (["MIT"], 1) and got[5] == (None, [], 0)
    odd = licence_scan(docs).collect()
    assert len(odd) == len(DOCS) and {r["text_licence"] for r in odd} == {None}
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r["text_digest"] == empty) for r in odd if r["doc_id"] in (3, 4, 5))
    assert licence_scan(none).count() == 0


def test_sentencepiece(docs, none):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    texts = [t for _, t, _, _ in ROWS if t and "▁" not in t]
    assert lists(pieces(PIECE_FILE).encode(texts, 0, 1, 1)) == library.encode(texts)
    got = segmentations(docs, PIECE_FILE)
    assert got.count() == len(DOCS) and all(r["lossless"] for r in got.collect())
    assert sorted(got.collect(), key=repr) == sorted(segmentations(docs, PIECE_FILE).collect(), key=repr)
    words = ["internationalisation of tokenisers " * 40]
    varied = {tuple(pieces(PIECE_FILE).encode(words, 0.3, s, 2)[0]) for s in range(4)}
    assert len(varied) == 4
    both = encode(docs, PIECE_FILE).withColumn("text", decode(F.col("ids"), PIECE_FILE))
    assert by_row(both, "text") == sorted(((t or "",) for _, t, _, _ in ROWS), key=repr)
    assert encode(none, PIECE_FILE).count() == 0


def test_pipeline(spark, docs, none, tmp_path):
    labels = spark.createDataFrame([(1, 0), (6, 1)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, none):
        left = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stored(stage(spark, left, str(tmp_path)), name)
            assert left.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path)).count() == left.count()


def test_pipeline_near_dedup(spark, docs):
    """One document stays of each component of fingerprints within three bits."""
    rng = random.Random(8)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(words), " ".join(words).upper(), " ".join(words[:-1]), " ".join(words[:200])]
    rows = [(i, t, None, None, 0, "r", 1, 0.0, "k", 0) for i, t in enumerate(texts)]
    table = stored(spark.createDataFrame(rows + rows[:3], SCHEMA).unionByName(docs), "near-documents")
    every = [(r["doc_id"], r["text"], fingerprint(r["text"])) for r in table.collect()]
    left = {f: f for _, _, f in every}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(list(left), 2):
            low = min(left[a], left[b])
            if (a ^ b).bit_count() <= 3 and left[a] != left[b]:
                left[a] = left[b] = low
                changed = True
    first = {}
    for i, _, f in every:
        mine = (i is None, i or 0)
        first[left[f]] = min(first.get(left[f], mine), mine)
    want = sorted(first.values())
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in corpus_pipeline.near_dedup(spark, table, "").collect())
    assert got == want and len(got) < 130


def test_published_licences(spark):
    """Every listed text is found as it is, rewrapped paragraph by paragraph, and in other spelling."""
    rows, names = [], []
    for name, texts in KNOWN.items():
        for text in filter(lambda t: len(t) > 500, texts):
            paragraphs = [p for p in re.split(r"\n\s*\n", text)]
            wrapped = "\n\n".join(
                p if re.search(r"(?im)^\W*(copyright|\(c\)|©|all rights)", p) else textwrap.fill(" ".join(p.split()), 61, break_long_words=False, break_on_hyphens=False)
                for p in paragraphs
            )
            spelled = re.sub(r"\blicense\b", "licence", wrapped)
            spelled = re.sub(r"\borganization\b", "organisation", spelled).replace('"', "''")
            for form in (text, wrapped, spelled.upper()):
                rows.append((len(rows), form))
                names.append(name)
    got = {r["doc_id"]: r["text_licence"] for r in licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(i, n, got[i]) for i, n in enumerate(names) if got[i] != n] == []
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC"} <= set(names)


def test_dropout_per_occurrence(spark):
    """Every occurrence of a word is cut on its own, and as it is without memory."""
    find = pieces(PIECE_FILE)
    n, word = 2_000, "internationalisation"
    rows = [(1, f"{word} " * n), (2, f"{word} " * n), (1, f"{word} " * n)]
    got = [r["ids"] for r in encode(spark.createDataFrame(rows, "doc_id long, text string"), PIECE_FILE).collect()]
    assert got[0] == got[2] != got[1]
    bounds, cuts, part, size = len(f" {word}"), set(), [], 0
    for i in got[0]:
        part.append(i)
        size += len(find.out[i])
        if size >= bounds:
            cuts.add(tuple(part))
            part, size = [], 0
    assert len(cuts) > 20
    text = " ".join(["the", "tokenisers", "of", word, "日本", "é"] * 50 + ["x" * 60])
    first = find.encode([text], 0.1, 5, [7])
    # what else is encoded with a text, and where, has no part
    assert lists(find.encode([text * 2, text, None], 0.1, 5, [8, 7, 9])[1:2]) == lists(first) and find.decode(first[0]) == text
    one = "tokenisers "[:-1]
    free = lists(find.encode([one], 0, 5))
    same = sum(lists(find.encode([one], 0.1, 5, [k])) == free for k in range(400))
    assert 40 < same < 400


def plain_pieces(find, text, dropout, seed, id_):
    """Every chunk of a whole text by a search for the best pair at every step, with the same keys."""
    u = np.uint64
    bar, out = u(int(dropout * 2.0**64)), []
    of_text = xxhash.xxh64_intdigest(text, xxhash.xxh64_intdigest(repr(id_), seed))
    for place, chunk in enumerate(re.findall(r" *[^ ]+| +", " " + text)):
        key = keyed(np.array([of_text], u), np.array([place]), np.array([-1]))
        parts, skipped = [(find.letter.get(c, -1 - ord(c)), i, i + 1) for i, c in enumerate(chunk)], set()
        while True:
            best = None
            for i in range(len(parts) - 1):
                (x, a, _), (y, _, b) = parts[i], parts[i + 1]
                hit = find.table.one.get(x * find.table.symbols + y) if x >= 0 and y >= 0 else None
                if hit and (a, b) not in skipped and (best is None or (hit[0], a) < best[:2]):
                    best = (hit[0], a, b, i, hit[1])
            if best is None:
                break
            _, a, b, i, made = best
            if keyed(key, np.array([a]), np.array([b]))[0] < bar:
                skipped.add((a, b))
            else:
                parts[i : i + 2] = [(made, a, b)]
        for x, _, _ in parts:
            out.extend((x,) if x >= 0 else (find.bytes_[v] for v in chr(-1 - x).encode()))
    return out


def test_dropout_against_a_plain_search(spark, sf_dir):
    find = pieces(PIECE_FILE)
    rows = [(r["doc_id"], r["text"][:3_000]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40).collect()]
    rows += [(1, "é▁ 日本 <|endoftext|> 😀  x"), (2, "w" * 200 + " " + "ab" * 40), (3, "   "), (4, "\n\t a\u0301")]
    for rate in (0.1, 0.5):
        got = lists(find.encode([t for _, t in rows], rate, 3, [i for i, _ in rows]))
        assert got == [plain_pieces(find, t, rate, 3, i) for i, t in rows]


def test_dropout_goes_on_from_its_parent(monkeypatch):
    """A segmentation looks up the pairs behind the merge that was left out, not those of its whole chunk again."""
    find, looked, made = pieces(PIECE_FILE), [], []
    lookup, cut = find.table.find, find.cut
    monkeypatch.setattr(find.table, "find", lambda a, b: looked.append(len(a)) or lookup(a, b))
    monkeypatch.setattr(find, "cut", lambda *x: made.append(cut(*x)) or made[-1])
    find.encode(["internationalisation counterrevolutionaries tokenisers " * 2_000], 0.3, 5, [7])
    assert len(made[0][1].size) > 10_000 and sum(looked) < 30 * len(made[0][1].size)


def test_merge_leftmost_against_the_queue():
    """Equal ranks, new pairs that rank before their makers, every length, left-out spans, and rows begun before."""
    rng = np.random.default_rng(4)
    pairs = rng.permutation(900)[:500]
    table = PairTable(pairs // 30, pairs % 30, rng.integers(0, 60, 500), rng.integers(0, 30, 500), 30)
    size = np.concatenate((np.arange(1, LOW + 1), rng.integers(1, LOW + 1, 400)))
    symbols = Ragged(rng.integers(-1, 30, size.sum()).astype(np.int32), size)
    ends = Ragged(np.arange(size.sum()) - np.repeat(symbols.first, size) + 1, size)
    start = rng.integers(0, size, (5, len(size)))
    left_out = start << 6 | np.minimum(start + rng.integers(2, 4, start.shape), size)
    merges = merge_leftmost(symbols, ends, table, left_out)

    def rows(value, end):
        return [value.flat[a:b][end.flat[a:b] > 0].tolist() for a, b in zip(value.first, value.first + size)]

    got = rows(*merged(symbols, ends, merges.flat, merges.size))
    skipped = [set(c.tolist()) for c in left_out.T]
    want = [
        agenda(symbols.flat[a : a + n].tolist(), table, lambda i, j: (i << 6 | j) in skip)  # noqa: B023
        for a, n, skip in zip(symbols.first, size, skipped)
    ]
    assert got == want and merges.size.max() > 20
    some = rng.integers(0, merges.size + 1)
    begun = merged(symbols, ends, merges.flat[merges.places(np.arange(len(size)), some)], some)
    rest = merge_leftmost(*begun, table, left_out)
    assert (rest.size == merges.size - some).all()
    assert rows(*merged(*begun, rest.flat, rest.size)) == want
