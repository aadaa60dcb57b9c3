"""Hard negatives, prefix trie and shards against plain versions, on odd rows and on planted heavy groups."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from storyloom.llm.common import read_table, stored
from storyloom.llm.op11_hard_negatives import LONG, augmented, cover_tree, hard_negatives
from storyloom.llm.op12_prefix_trie import prefix_trie
from storyloom.llm.op13_sharding import shards


def plain_negatives(rows):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all():
            whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            good.append((i, whole, (label + 1) % 10 if i % 7 == 0 else label))
    out = set()
    for a, va, la in good:
        if a % 100:
            continue
        scored = sorted((max(-LONG, min(LONG, -sum(x * y for x, y in zip(va, vb)))), b, lb) for b, vb, lb in good if b != a and len(va) == len(vb))
        for ps, p, _ in [x for x in scored if x[2] == la][:5]:
            near = [(s, n) for s, n, ln in scored if ln != la and 80 * -ps <= 100 * -s <= 100 * -ps][:5]
            out |= {(a, p, r + 1, n, -ps, -s) for r, (s, n) in enumerate(near)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, 0.5, 1) for i, v, c in rows], "vec_id long, embedding array<float>, label int, score double, d int")


def test_hard_negatives(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] + 0.1 * rng.standard_normal(8)).tolist(), int(i % 3)) for i in range(400)]
    rows += [(500 + i, [0.5] * 8, i % 2) for i in range(200)]
    rows += [(701, None, 1), (702, [None] * 8, 1), (703, [float("nan")] * 8, 2), (704, [float("inf")] * 8, 2), (705, [0.1] * 8, None)]
    rows += [(None, [0.1] * 8, 1), (800, [0.0] * 8, 1), (801, [1e30] + [0.0] * 7, 0), (802, [1e12] + [0.0] * 7, 0), (900, [1.0, 2.0], 1), (901, [1.0, 1.9], 1), (902, [1.0, 1.8], 2)]
    assert {tuple(r) for r in hard_negatives(vectors(spark, rows)).collect()} == plain_negatives(rows)
    # repeated rows are positives and negatives each, and one anchor
    again = rows + [rows[100], rows[101], rows[450], rows[450]]
    got = [tuple(r) for r in hard_negatives(vectors(spark, again)).collect()]
    assert set(got) == plain_negatives(again)
    clean = rows
    assert hard_negatives(vectors(spark, [])).count() == 0
    assert hard_negatives(vectors(spark, clean[:1])).count() == 0


def test_hard_negatives_of_the_table(spark, sf_dir):
    table = read_table(spark, sf_dir, "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert {tuple(r) for r in hard_negatives(table).collect()} == plain_negatives(rows)


def test_cover_tree():
    rng = np.random.default_rng(1)
    points, norm = augmented(np.vstack((rng.standard_normal((300, 4)), np.ones((200, 4)), np.zeros((3, 4)))))
    order, nodes = cover_tree(points, np.arange(503) % 2)
    assert sorted(order.tolist()) == list(range(503)) and np.allclose(np.linalg.norm(points, axis=1), 1) and norm > 0
    for centre, radius, first, last, child, children, alone, _ in nodes:
        below = points[order[int(first) : int(last)]]
        assert (np.arccos(np.clip(below @ points[order[int(centre)]], -1, 1)) <= radius).all()
        mine = nodes[int(child) : int(child + children)]
        assert np.concatenate((mine[:, 2], [alone])).tolist() == np.concatenate(([first], mine[:, 3])).tolist()


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    full = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - c % 5, [])[:h] + t[h:]
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, t in full.items():
        ends[tuple(t)].append(c)
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
            if d:
                children[tuple(t[: d - 1])].add(tuple(t[:d]))
    below, out = {}, []
    for p in sorted(members, key=len, reverse=True):
        n, k = len(members[p]), children[p]
        leaves = sum(below[x][0] for x in k) if k else 1
        saved = sum(below[x][1] for x in k) + ((n - 1) * len(p[-1][1].encode()) if p else 0)
        below[p] = leaves, saved
        ids = ",".join(map(str, sorted(ends.get(p, []))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, n, len(k), leaves, saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, path string, n long")


def deep_rows():
    rows = [(c, t, "user" if t % 2 else "bot", f"turn {t} of {c // 10}") for c in range(60) for t in range(c % 7)]
    # long ones: copies, copies up to a turn, one that stops within another, one of its own
    rows += [(c, t, "user", f"long {t}" + ("x" if c == 203 and t > 40 else "")) for c in (200, 203, 204, 205) for t in range(50)]
    rows += [(206, t, "user", f"long {t}") for t in range(33)] + [(300, t, "bot", f"own {t}") for t in range(64)]
    rows += [(400 + i, 0, "user", "the same") for i in range(5_000)]
    rows += [(70, None, "user", "no turn"), (70, None, None, None), (70, 1, "", ""), (70, 1, "", ""), (71, 2, "é", "日本 😀"), (None, 0, "user", "lost")]
    return rows + [(72, 0, "user", "y" * 200_000), (72, 0, "user", "y" * 200_000), (-3, 0, "a", "b"), (-5, 1, "a", "c")]


def test_prefix_trie(spark):
    rows = deep_rows()
    negative = [r for r in rows if r[0] is None or r[0] >= 0]
    got = sorted((tuple(r) for r in prefix_trie(conversations(spark, negative)).collect()), key=str)
    assert got == plain_trie(negative)
    # below zero the family leader lies towards zero
    assert prefix_trie(conversations(spark, rows)).filter("depth = 0").first()["conv_id"] == -5
    assert prefix_trie(conversations(spark, [])).count() == 0


def test_prefix_trie_of_the_table(spark, sf_dir):
    table = read_table(spark, sf_dir, "conversations")
    got = sorted((tuple(r) for r in prefix_trie(table).collect()), key=str)
    assert got == plain_trie([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()])


def plain_shards(rows, count=8):
    bits = lambda x, n: int(hashlib.md5(x.encode()).hexdigest()[:n], 16)
    keyed = []
    for i, t in rows:
        t = t or ""
        raw = t.encode()
        keyed.append((bits(t, 10), bits("" if i is None else str(i), 5), i is not None, i or 0, len(raw) + 1, zlib.crc32(raw)))
    keyed.sort()
    total, groups, at = sum(k[4] for k in keyed), {}, 0
    for k in keyed:
        start, size = groups.get(k[0], (at, 0))
        groups[k[0]] = start, size + k[4]
        at += k[4]
    out, slots, at = [], defaultdict(int), 0
    for group, _, some, i, size, crc in keyed:
        start, whole = groups[group]
        twice = 2 * start + whole if whole * 32 * count <= total else 2 * at + size
        shard = min(twice * count // (2 * total), count - 1)
        out.append((i if some else None, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        at += size
    return sorted(out, key=str)


def documents(spark, rows):
    return stored(spark.createDataFrame([(*r, 7, "k", 3) for r in rows], "doc_id long, text string, size long, key string, n long"), "shard-documents")


@pytest.mark.parametrize("heavy", [0, 4_000])
def test_shards(spark, heavy):
    rng = np.random.default_rng(2)
    rows = [(i, "é " * int(rng.integers(0, 60)) + str(i)) for i in range(1_500)]
    rows += [(2_000 + i, "a copy") for i in range(40)] + [(3_000 + i, "one of very many copies " * 3) for i in range(heavy)]
    rows += [(None, None), (None, None), (5, ""), (5, ""), (None, "no id"), (6, "long " * 20_000)]
    # equal rows, more than come out of one row
    rows += [(7_000, "again and again")] * (2 * heavy)
    got = sorted((tuple(r) for r in shards(documents(spark, rows)).collect()), key=str)
    assert got == plain_shards(rows)
    sizes = defaultdict(int)
    for r in got:
        sizes[r[4]] += r[1]
    assert max(sizes.values()) - min(sizes.values()) <= sum(sizes.values()) / 8 / 16 + 2 * 100_001
    where = defaultdict(set)
    for r in got:
        where[r[2]].add(r[4])
    assert len(where[zlib.crc32(b"a copy")]) == 1


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr("storyloom.llm.op13_sharding.COPIES", 100)
    rows = [(1, "same")] * 2_050 + [(i, f"text {i}") for i in range(300)]
    assert sorted((tuple(r) for r in shards(documents(spark, rows)).collect()), key=str) == plain_shards(rows)
    assert shards(documents(spark, [])).count() == 0
