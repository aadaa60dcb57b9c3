"""Quoted CSV in many tasks: one file is read in splits, though fields hold line breaks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from storyloom.session import scratch_dir
from storyloom.sources.files import BAD, damaged_row, kept_table

# What leads to the quote that closes a field. Possessive repeats run as loops, at any length.
_TO_CLOSE = r'[^"]*+(?:""[^"]*+)*+"(?!")'


def _opens(line: Column) -> Column:
    """Whether a line that begins outside quotes ends within them: an opening quote is left when all closed fields are gone."""
    return F.regexp_like(F.regexp_replace(line, f'(^|,)"{_TO_CLOSE}', "$1"), F.lit('(?:^|,)"'))


def _stays_open(line: Column) -> Column:
    """The same of a line that begins within quotes. What follows a closing quote is no start of a field."""
    rest = F.regexp_replace(line, f"^{_TO_CLOSE}", "x")
    return ~F.regexp_like(line, F.lit(f"^{_TO_CLOSE}")) | _opens(rest)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with file and split, and the state (within quotes or not) after each where it begins outside (``e0``) or inside (``e1``).

    Rows come in the files' order, each split's together. ``csv_records`` relies on it: nothing below may shuffle them.
    """
    # only line feeds end a line here; a carriage return before one goes when its record is whole
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    )
    # the expensive tests only where a line has a quote
    some = F.contains("value", F.lit('"'))
    text = F.regexp_replace("value", "\r$", "")
    return raw.withColumn("e0", some & _opens(text)).withColumn("e1", ~some | _stays_open(text))


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def _after(e0: np.ndarray, e1: np.ndarray, state: bool) -> np.ndarray:
    """The state after each of some lines. A line sets the state whatever it was, keeps it, or turns it."""
    turns = np.cumsum(e0 & ~e1)
    last = np.maximum.accumulate(np.where(e0 == e1, np.arange(len(e0)), -1))
    seen = np.maximum(last, 0)
    return np.where(last >= 0, e0[seen], state) ^ ((turns - np.where(last >= 0, turns[seen], 0)) % 2 == 1)


def _begins(after: np.ndarray, state: bool) -> np.ndarray:
    """Places of the lines that begin outside quotes: each is the first of a record."""
    return np.flatnonzero(~np.append(state, after[:-1]))


def _of_splits(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """A batch cut where the split changes."""
    file, split, n = batch["file"], batch["split"], batch.num_rows
    if not n:
        return
    new = _flags(pc.not_equal(file.slice(1), file.slice(0, n - 1))) | _flags(pc.not_equal(split.slice(1), split.slice(0, n - 1)))
    places = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    for at, to in zip(places, places[1:]):
        yield (file[at].as_py(), split[at].as_py()), batch.slice(at, to - at)


_EFFECTS = "file string, split long, end0 boolean, end1 boolean, n0 long, n1 long"


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to the state, and how many records begin in it, for either state that it may begin in."""
    names = _EFFECTS.replace(",", "").split()[::2]
    row = lambda key, ends, begun: pa.RecordBatch.from_pylist([dict(zip(names, (*key, *ends, *begun)))])
    key, ends, begun = None, [False, True], [0, 0]
    for batch in batches:
        for here, part in _of_splits(batch):
            if here != key:
                if key:
                    yield row(key, ends, begun)
                key, ends, begun = here, [False, True], [0, 0]
            e0, e1 = _flags(part["e0"]), _flags(part["e1"])
            for k in (0, 1):
                after = _after(e0, e1, ends[k])
                begun[k] += len(_begins(after, ends[k]))
                ends[k] = bool(after[-1])
    if key:
        yield row(key, ends, begun)


_PIECES = "file string, split long, number long, at long, value string, whole boolean"
# Bytes of a record that a task holds; what is longer is passed on in pieces.
HELD = 4 << 20


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each split, numbered from 1, and pieces of those that cross its ends or are long.

    Lines before the first record are pieces of number 0; ``at`` is the place of a piece's first line.
    """
    out: list[pa.RecordBatch] = []
    key, state, number, at = None, False, 0, 0
    held, held_at, cut = [], 0, False  # of the record at hand: lines, the place of the first, whether pieces of it went before

    def add(numbers, place: int, values, whole: bool):
        n = len(numbers)
        each = [pa.repeat(pa.scalar(x, kind), n) for x, kind in ((key[0], pa.string()), (key[1], pa.int64()))]
        more = [pa.array(numbers, pa.int64()), pa.repeat(pa.scalar(place, pa.int64()), n), values.cast(pa.string()), pa.repeat(pa.scalar(whole), n)]
        out.append(pa.RecordBatch.from_arrays([*each, *more], names=_PIECES.replace(",", "").split()[::2]))

    def joined(places, lines):
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), lines), "\n")

    def pass_on(whole: bool):
        lines = pa.concat_arrays(held)
        add([number], held_at, joined([0, len(lines)], lines), whole)
        held.clear()

    for batch in batches:
        for here, part in _of_splits(batch):
            if here != key:
                if held:
                    pass_on(False)
                start = part["start"][0].as_py()
                if start is None:
                    raise RuntimeError(f"{here[0]} was split in another way when its quotes were counted")
                key, state, number, at, cut = here, start, 0, 0, False
            after = _after(_flags(part["e0"]), _flags(part["e1"]), state)
            begins, lines, n, closed = _begins(after, state), part["value"], part.num_rows, not after[-1]
            first = int(begins[0]) if len(begins) else n
            if first:
                held_at = held_at if held else at
                held.append(lines.slice(0, first))
                if first < n or closed:
                    pass_on(number > 0 and not cut)
            if len(begins):
                places = np.append(begins, n) if closed else begins
                whole = len(places) - 1
                if whole:
                    add(np.arange(number + 1, number + whole + 1), 0, joined(places, lines), True)
                number, cut = number + len(begins), False
                if not closed:
                    held.append(lines.slice(int(begins[-1])))
                    held_at = at + int(begins[-1])
            if sum(x.nbytes for x in held) > HELD:
                pass_on(False)
                cut = True
            state, at = not closed, at + n
        yield from out
        out.clear()
    if held:
        pass_on(False)
    yield from out


def _state(order, upto: int) -> tuple[Column, Column]:
    """The last state set before a row, and the turns since (or since the window's start)."""
    so_far = order.rowsBetween(Window.unboundedPreceding, upto)
    mark = F.when(F.col("sets").isNotNull(), F.struct("sets", F.sum("turns").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("turns")))
    last = F.last(mark, ignorenulls=True).over(so_far)
    return last["sets"], F.coalesce(F.sum("turns").over(so_far), F.lit(0)) - F.coalesce(last["turns"], F.lit(0))


def _turned(state: Column, turns: Column) -> Column:
    return F.when(turns % 2 == 1, ~state).otherwise(state)


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Files are cut alike each time, also if executors come or go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, number, record, open): the logical lines of CSV files, each whole, dealt over the files' splits.

    Each split of a file is worked on by itself: what its lines do to the state (within quotes or not) depends on the
    state it begins in, so a first pass works out both outcomes; one small row per split then goes through a running composition, which
    gives every split its true start. A second pass puts the records within a split together where they are read, and writes them; what hangs over
    a split's end joins the split where it began, the only text that is shuffled. The rows per split are broadcast, as many as the driver lists.
    ``open`` marks a record whose quote never closes; it is not put together, as it may be the rest of a file.
    """
    lines = _lines(spark, path)
    order = Window.partitionBy("file").orderBy("split")
    before_it = order.rowsBetween(Window.unboundedPreceding, -1)
    with _same_splits(spark):
        splits = kept_table(lines.drop("value").mapInArrow(_effects, _EFFECTS), scratch_dir(spark, "csv-splits"))
        splits = splits.withColumn("sets", F.when(F.col("end0") == F.col("end1"), F.col("end0"))).withColumn("turns", (F.col("end0") & ~F.col("end1")).cast("long"))
        state, turns = _state(order, -1)
        splits = splits.withColumn("start", _turned(F.coalesce(state, F.lit(False)), turns)).withColumn("records", F.when(F.col("start"), F.col("n1")).otherwise(F.col("n0")))
        begun = F.last(F.when(F.col("records") > 0, F.struct(F.col("split"), F.col("records"))), ignorenulls=True)
        splits = kept_table(splits.withColumn("owner", begun.over(before_it)), scratch_dir(spark, "csv-starts"))
        rows = lines.join(F.broadcast(splits.select("file", "split", "start")), ["file", "split"], "left").mapInArrow(_records, _PIECES)
        rows = kept_table(rows, scratch_dir(spark, "csv-records"), compression="zstd")
    one = rows.filter("whole").select("file", "split", "number", "value", F.lit(False).alias("open"))
    # a record may begin in one split and end some splits later
    parts = rows.filter("NOT whole")
    before = splits.select("file", "split", "owner")
    early = parts.filter("number = 0").join(F.broadcast(before), ["file", "split"]).select("file", "owner.split", F.col("owner.records").alias("number"), "split", "at", "value")
    early = early.toDF("file", "split", "number", "part", "at", "value")
    parts = parts.filter("number > 0").select("file", "split", "number", F.col("split").alias("part"), "at", "value").unionByName(early)
    # the last record of a file whose splits end inside quotes stays open
    state, turns = _state(order, 0)
    final = splits.select("file", "split", _turned(F.coalesce(state, F.lit(False)), turns).alias("open")).groupBy("file").agg(F.max_by("open", "split").alias("open"))
    owner = splits.filter("records > 0").groupBy("file").agg(F.max_by(F.struct("split", "records"), "split").alias("owner"))
    unfinished = final.filter("open").join(owner, "file").select("file", "owner.split", F.col("owner.records").alias("number"))
    closed = parts.join(F.broadcast(unfinished), ["file", "split", "number"], "left_anti")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("part", "at", "value"))), lambda x: x["value"])
    joined = closed.groupBy("file", "split", "number").agg(F.array_join(ordered, "\n").alias("value")).withColumn("open", F.lit(False))
    lost = unfinished.withColumn("value", F.lit(None).cast("string")).withColumn("open", F.lit(True))
    every = one.unionByName(joined).unionByName(lost)
    return every.select("file", "split", "number", F.regexp_replace("value", "\r$", "").alias("record"), "open")


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV without its damaged rows, as ``read_csv_skip_bad`` gives it, with every file read in as many tasks as it has splits.

    With ``header`` the first record of a file names its columns; they are bound by name, in any order, and a
    column of the schema that a file lacks is null. Records without a character are skipped. Line breaks within quotes are kept. The
    text is written once, as records, and not shuffled but for those that cross a split's end; a record may be longer than a split. An
    unclosed quote takes the rest of its file, as it does in the other reader, and is dropped. The files are read here, twice, and no more by the result.
    """
    records = csv_records(spark, path).filter("NOT open AND record != ''")
    if not header:
        return _parsed(records, schema, [f.name for f in schema.fields])
    # one row per file, as many as the driver lists
    place = ["file", "split", "number"]
    first = records.groupBy("file").agg(F.min(F.struct("split", "number")).alias("first")).select("file", "first.*")
    first = records.join(F.broadcast(first), place, "left_semi").select(*place, F.col("record").alias("header"))
    first = kept_table(first, scratch_dir(spark, "csv-headers"))
    body = records.join(F.broadcast(first.select(*place)), place, "left_anti")
    # a handful of different headers; each is a way to read the files that have it
    out = None
    for row in first.select("header").distinct().collect():
        names = _header_names(spark, row["header"])
        mine = body.join(F.broadcast(first.filter(F.col("header") == row["header"]).select("file")), "file", "left_semi")
        part = _parsed(mine, schema, names)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _header_names(spark: SparkSession, record: str) -> list[str]:
    width = record.count(",") + 1
    kind = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    row = spark.range(1).select(F.from_csv(F.lit(record), kind.simpleString()[7:-1].replace(":", " "), options).alias("r")).first()["r"]
    names = [x for x in row]
    while names and names[-1] is None:
        names.pop()
    return names


def _parsed(records: DataFrame, schema: T.StructType, names: list[str]) -> DataFrame:
    """Records of the columns ``names`` as rows of the schema, without damaged ones."""
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    columns = [f"`_{i}` {kinds.get(n, 'string')}" for i, n in enumerate(names)]
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "maxCharsPerColumn": "-1",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = records.select(F.from_csv("record", ", ".join([*columns, f"{BAD} string"]), options).alias("r")).select("r.*")
    rows = rows.where(~damaged_row(F.col(BAD), len(names)))
    place = {n: i for i, n in reversed(list(enumerate(names)))}
    return rows.select(*[(F.col(f"_{place[f.name]}") if f.name in place else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
