"""Spelling by deletions against plain edit distances; CSV in many splits against the reader of one task."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from storyloom.operators import spelling
from storyloom.sources.files import read_csv_skip_bad
from storyloom.sources.split_csv import read_split_csv


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("hot", [1, 256])
def test_corrections(spark, monkeypatch, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 11)))
    known = {word(): rng.randint(20, 60) for _ in range(150)}
    words = sorted({word() for _ in range(150)} | set(list(known)[:5]) | {"zzzzzzzz"})
    want = set()
    for w in words:
        if w not in known and len(w) >= 4:
            near = sorted((edits(w, k), -n, k) for k, n in known.items() if len(k) >= 2 and edits(w, k) <= 2)
            want |= {(w, near[0][2], near[0][0])} if near else set()
    table = spark.createDataFrame(list(known.items()), "word string, n long")
    asked = spark.createDataFrame([(w,) for w in words * 2], "word string")
    got = [tuple(r) for r in spelling.corrections(asked, table).collect()]
    assert set(got) == want and len(got) == len(want)
    assert spelling.corrections(asked.limit(0), table).count() == 0 == spelling.corrections(asked, table.limit(0)).count()


def test_correct_spelling(spark):
    texts = [(1, "Teh bank, TEH bank-teh\nteh!"), (2, "nothing"), (3, None), (4, ""), (5, "  "), (6, "the tehs teh" + " x" * 5_000)]
    fixed = spelling.correct_spelling(
        spark.createDataFrame(texts, "id long, t string"), "id", "t", spark.createDataFrame([("teh", "the", 1)], "word string, correction string, distance int")
    )
    got = {r["id"]: (r["texto_corregido"], r["cantidad_errores"]) for r in fixed.collect()}
    assert got == {1: ("The bank, THE bank-the\nthe!", 4), 2: ("nothing", 0), 4: ("", 0), 5: ("  ", 0), 6: ("the tehs the" + " x" * 5_000, 1)}


def field(rng):
    return rng.choice([
        "", "plain", '"line one\nline, two\n\n""quoted"" three"', '"' + "long text, with comma\n" * rng.randrange(40) + '"', '""', '"one\r\ntwo"',
        'a "stray" one', '5" pipe', '"closed"then more', f"v{rng.randrange(99)}",
    ])


@pytest.mark.parametrize("ends_open", [False, True])
def test_split_csv_equals_the_reader_of_one_task(spark, tmp_path, ends_open):
    rng = random.Random(int(ends_open))
    lines = ["id,a,b,c"]
    for i in range(1_200):
        lines.append(",".join([str(i)] + [field(rng) for _ in range({7: 5, 9: 1}.get(i % 50, 3))]))
        lines += [""] * (i % 97 == 0)
    body = "\n".join(lines) + ('\n9999,"open to the end\nmore\n' + "and more\n" * 400 if ends_open else "")
    (tmp_path / "x.csv").write_text(body, newline="")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "a", "b", "c")])
    want = sorted(map(tuple, read_csv_skip_bad(spark, str(tmp_path), schema).collect()), key=repr)
    sizes = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = sorted(map(tuple, read_split_csv(spark, str(tmp_path), schema).collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want


def test_headers_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text('b,"a",other\n1,"x\ny",z\n2\n')
    (tmp_path / "2.csv").write_text("a\nonly\n")
    (tmp_path / "3.csv").write_text("")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    got = sorted(map(tuple, read_split_csv(spark, str(tmp_path), schema).collect()), key=repr)
    assert got == [("only", None), ("x\ny", 1), (None, 2)]
    assert read_split_csv(spark, str(tmp_path / "3.csv"), schema).count() == 0


def test_words_are_dealt_out_before_deletions(spark):
    from storyloom.operators.spelling import WORD_TASKS, deletions, near_words

    words = spark.createDataFrame([("abcdefgh",), ("a",), ("",)], "word string").coalesce(1)
    by_hand = lambda w, d: {"".join(c for i, c in enumerate(w[:7]) if i not in gone) for n in range(d + 1) for gone in __import__("itertools").combinations(range(len(w[:7])), n)}
    for d in (1, 2, 3):
        for r in words.select("word", deletions(F.col("word"), d).alias("k")).collect():
            assert set(r["k"]) == by_hand(r["word"], d) and len(r["k"]) == len(set(r["k"]))
    known = spark.createDataFrame([("abcdefg", 5)], "word string, n long")
    plan = near_words(words, known)._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression" in plan and str(WORD_TASKS) in plan


def test_many_documents_make_many_csv_files(spark, sf_dir, monkeypatch):
    from checks import queries

    want = sorted(map(tuple, queries.QUERIES["csv_split_import"](spark, sf_dir).collect()), key=repr)
    folders = []
    keep = queries.scratch_dir
    monkeypatch.setattr(queries, "scratch_dir", lambda s, name: folders.append(keep(s, name)) or folders[-1])
    monkeypatch.setattr(queries, "CSV_FILE", 100_000)
    got = sorted(map(tuple, queries.QUERIES["csv_split_import"](spark, sf_dir).collect()), key=repr)
    files = [f for f in spark.read.text(folders[0]).inputFiles() if f.endswith(".txt")]
    assert got == want and len(files) > 1


def test_records_and_effects_of_splits(monkeypatch):
    import pyarrow as pa

    from storyloom.sources import split_csv

    rng = random.Random(4)
    for trial in range(300):
        monkeypatch.setattr(split_csv, "HELD", rng.choice([1, 20, 1 << 20]))
        # a line ends outside, ends inside, keeps the state or turns it
        rows, want, effects = [], {}, []
        for split in range(rng.randint(1, 3)):
            start, n = rng.random() < 0.5, rng.randint(1, 12)
            lines = [(f"line{split}-{i}", *rng.choice([(False, False), (True, True), (False, True), (True, False)])) for i in range(n)]
            rows += [{"file": "f", "split": split, "value": v, "e0": e0, "e1": e1, "start": start} for v, e0, e1 in lines]
            state, number = start, 0
            for v, e0, e1 in lines:
                number += not state
                want.setdefault((split, number), []).append(v)
                state = e1 if state else e0
            both = []
            for state in (False, True):
                begun = 0
                for _, e0, e1 in lines:
                    begun += not state
                    state = e1 if state else e0
                both += [state, begun]
            effects.append((split, both[0], both[2], both[1], both[3]))
        size = rng.randint(1, 9)
        kind = pa.schema([("file", pa.string()), ("split", pa.int64()), ("value", pa.string()), ("e0", pa.bool_()), ("e1", pa.bool_()), ("start", pa.bool_())])
        batches = [pa.RecordBatch.from_pylist(rows[i : i + size], kind) for i in range(0, len(rows), size)]
        batches.insert(rng.randint(0, len(batches)), pa.RecordBatch.from_pylist([], kind))
        out = [r for b in split_csv._records(iter(batches)) for r in b.to_pylist()]
        got = {}
        for r in sorted(out, key=lambda r: (r["split"], r["number"], r["at"])):
            got.setdefault((r["split"], r["number"]), []).append(r["value"])
            assert not r["whole"] or r["number"] > 0
        assert {k: "\n".join(v) for k, v in got.items()} == {k: "\n".join(v) for k, v in want.items()}
        # a whole record is one row
        whole = [(r["split"], r["number"]) for r in out if r["whole"]]
        assert len(whole) == len(set(whole)) and all(len(got[k]) == 1 for k in whole)
        seen = [tuple(r[c] for c in ("split", "end0", "end1", "n0", "n1")) for b in split_csv._effects(iter(batches)) for r in b.to_pylist()]
        assert seen == effects


def test_long_records_go_in_pieces(spark, tmp_path):
    # one record over many splits and batches, others after it
    text = "\n".join(f"line {i}" for i in range(30_000))
    (tmp_path / "x.csv").write_text(f'a,b\n1,"{text}"\n2,"x\ny"\n3,z\n')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    for splits in ("50k", "128m"):
        spark.conf.set(size, splits)
        try:
            got = sorted(map(tuple, read_split_csv(spark, str(tmp_path), schema).collect()))
        finally:
            spark.conf.set(size, before)
        assert got == [("1", text), ("2", "x\ny"), ("3", "z")]
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_the_split_reader_writes_the_text_once(spark, sf_dir, monkeypatch):
    from checks import queries
    from storyloom.session import path_bytes
    from storyloom.sources import split_csv
    from tests.conftest import plan_text

    folders = []
    for module in (queries, split_csv):
        keep = module.scratch_dir
        monkeypatch.setattr(module, "scratch_dir", lambda s, name, keep=keep: folders.append(keep(s, name)) or folders[-1])
    out = queries.QUERIES["csv_split_import"](spark, sf_dir)
    texts, others = folders[0], folders[1:]
    # it wrote the lines, the numbered lines, the records and the result, 1.77 times the files' bytes together
    assert sum(path_bytes(spark, f) for f in others) < 0.75 * path_bytes(spark, texts)
    # and dealt whole texts by file and by split
    assert "RoundRobin" not in plan_text(out) and "SortMergeJoin" not in plan_text(out)
