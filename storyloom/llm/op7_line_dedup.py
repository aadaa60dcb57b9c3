"""Lines that many documents share are dropped, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storyloom.functions.let import let
from storyloom.llm.common import BLANKS, digest, lower_ascii, stored


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _marked(whole: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(row, gone) for (row) structs: positions of the lines to drop, null where none."""
    doc = F.col("row.doc_id")
    key = digest(doc, F.col("row.text"))
    lines = (
        whole.select(doc.alias("id"), key[0].alias("d1"), key[1].alias("d2"), F.posexplode(_lines(F.col("row.text"))).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .filter(F.char_length("key") >= min_chars)
    )
    h = digest(F.col("key"))
    lines = stored(lines.select("id", "d1", "d2", "pos", h[0].alias("h1"), h[1].alias("h2")), "lines")
    # a null id is one document, after all others
    order = F.struct(F.col("id").isNull().alias("none"), "id")
    if min_docs == 2:
        # two documents hold a line if its smallest and largest id differ; both combine before the shuffle
        shared = lines.groupBy("h1", "h2").agg(F.min(order).alias("keep"), F.max(order).alias("far")).filter("keep != far")
    else:
        each = lines.select("h1", "h2", order.alias("o")).distinct()
        shared = each.groupBy("h1", "h2").agg(F.min("o").alias("keep"), F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    shared = stored(shared.select("h1", "h2", "keep"), "shared-lines")
    gone = (
        lines.join(shared, ["h1", "h2"])
        .filter(order != F.col("keep"))
        .groupBy("d1", "d2")
        .agg(F.collect_set("pos").alias("gone"))
    )
    return whole.withColumn("d1", key[0]).withColumn("d2", key[1]).join(gone, ["d1", "d2"], "left").select("row", "gone")


def _kept(text: Column, gone: Column) -> Column:
    """The text without the lines at the positions in ``gone``, in order."""

    def pick(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.array_size(lines) - 1), gone)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), F.coalesce(text, F.lit(""))).otherwise(let(_lines(text), pick))


def line_dedup(
    documents: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: kept text, number of lines before, and number of lines dropped.

    A line's key is the line without blanks at both ends and with A-Z in lower case. Keys of at least
    ``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines except those in the
    smallest id that holds them. Lines are exploded once into 128-bit digests; counts combine before the
    shuffle, and the text itself is shuffled once, for the reassembly by position.

    One row per row that goes in. A null or empty text is one empty line; rows with one id are one document; a null
    id counts as one document after all others; an empty table gives an empty result; other columns are ignored.
    """
    d = documents
    whole = d.select(F.struct(d[id_col].alias("doc_id"), d[text_col].alias("text")).alias("row"))
    marked = _marked(whole, min_chars, min_docs)
    text = F.col("row.text")
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        _kept(text, F.col("gone")).alias("text"),
        (F.char_length(F.coalesce(text, F.lit(""))) - F.char_length(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_shared_lines(documents: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """The rows of ``documents``, all columns, with the kept text in ``text``. A row that loses nothing is unchanged, null text included.

    ``n_chars``, where there is such a column, follows the text of rows that lost lines.
    """
    d = documents
    whole = d.select(F.struct(*(d[f"`{c}`"] for c in d.columns)).alias("row"))
    marked = _marked(whole, min_chars, min_docs)
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(_kept(F.col("row.text"), F.col("gone")))
    marked = marked.select("row", "gone", text.alias("kept"))
    columns = []
    for c in d.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("kept")
        elif c == "n_chars":
            value = F.when(F.col("gone").isNull(), value).otherwise(F.char_length("kept").cast(d.schema[c].dataType))
        columns.append(value.alias(c))
    return marked.select(*columns)
