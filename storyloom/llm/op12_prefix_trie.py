"""Trie of conversation prefixes by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from storyloom.llm.common import scale_count, stored
from storyloom.session import scratch_dir

# Bytes of a path's digest, one per turn.
WIDE = 16
# Ids of one row that goes into a digest of ended conversations: 2 to this power at most.
ID_BITS = 12
# Nodes at depth d lose one turn a round, or d // DEEP turns where that is more.
DEEP = 8

_COUNTS = ("n", "ended", "children", "leaves", "saved")


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest of role and text and bytes of the text."""
    c = conversations
    role, text = F.coalesce(c["role"], F.lit("")), F.coalesce(c["text"], F.lit(""))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = c.select(
        c["conv_id"].cast("long").alias("conv_id"),
        F.struct(c["turn"].alias("turn"), mark.alias("mark"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    # arrays sort their structs field by field, null first
    return rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 5, spread: int = 9) -> DataFrame:
    """(conv_id, turns): the first h turns of the conversation that leads the family, then what the own one has after its first h."""
    own = stored(_turns(conversations), "turns")
    lead = F.col("conv_id") - F.col("conv_id") % family
    first = own.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("lead"), F.slice("turns", 1, max(1, spread - 1)).alias("first"))
    both = own.withColumn("lead", lead).join(first, "lead", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    head = F.when(h > 0, F.slice("first", F.lit(1), F.greatest(h, F.lit(1))))
    none = F.slice("turns", 1, 0)
    rest = F.slice(F.col("turns"), h + 1, F.greatest(F.array_size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(F.coalesce(head, none), rest).alias("turns"))


def _paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, path, sizes): per conversation the chained digests of its prefixes, 16 bytes each, and bytes per turn."""

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = []
            for marks in batch["marks"]:
                at, links = b"", []
                for m in marks:
                    at = hashlib.md5(at + m.encode()).digest()
                    links.append(at)
                paths.append(b"".join(links))
            yield batch[["conv_id", "sizes"]].assign(path=paths)

    rows = conversations.select("conv_id", F.col("turns.mark").alias("marks"), F.col("turns.size").alias("sizes"))
    rows = rows.mapInPandas(chain, "conv_id long, sizes array<bigint>, path binary")
    return rows.select("conv_id", F.array_size("sizes").alias("depth"), "path", "sizes")


def _cut(depth: Column) -> list[Column]:
    """Depth, path and sizes of the prefix of this depth."""
    return [
        depth.cast("int").alias("depth"),
        F.substring(F.col("path"), F.lit(1), depth * WIDE).alias("path"),
        F.slice("sizes", F.lit(1), depth).alias("sizes"),
    ]


def _merged(rows: DataFrame) -> DataFrame:
    """One row per path. Sums and minima are taken before the shuffle, so a path of very many rows costs a few."""
    return rows.groupBy("depth", "path", "sizes").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).cast("long").alias(c) for c in _COUNTS))


def _with_own(nodes: DataFrame) -> DataFrame:
    """A node that only ended conversations share is a leaf; its own text is saved by every member but one."""
    leaf = F.when(F.col("ended") == F.col("n"), 1).otherwise(F.col("leaves")).cast("long")
    last = F.coalesce(F.get("sizes", F.col("depth") - 1), F.lit(0))
    return nodes.withColumn("leaves", leaf).withColumn("saved", F.col("saved") + (F.col("n") - 1) * last)


def peel(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Nodes of the depths above ``low`` up to ``high``, from what ended there and what is left of the deeper nodes.

    With one depth this is one merge. With several, rows are first cut to every depth between, merged, and then give
    their leaves and savings to the nodes above them.
    """
    if high - low <= 1:
        return _with_own(_merged(rows))
    each = rows.withColumn("at", F.explode(F.sequence(F.lit(low + 1), F.col("depth"))))
    here = F.col("at") == F.col("depth")
    top = [F.when(here, F.col(c)).otherwise(0).alias(c) for c in _COUNTS if c != "n"]
    nodes = _with_own(_merged(each.select(*_cut(F.col("at")), "conv_id", "n", *top)))
    lines = nodes.withColumn("up", F.col("depth") - F.lit(1)).filter(F.col("up") > low)
    # what is zero goes to the parent alone, for its count of children
    far = F.when((F.col("leaves") > 0) | (F.col("saved") > 0), F.lit(low + 1)).otherwise(F.col("up"))
    lines = lines.withColumn("at", F.explode(F.sequence(far, F.col("up"))))
    zero = F.lit(0).cast("long")
    given = lines.select(
        *_cut(F.col("at")), F.lit(None).cast("long").alias("conv_id"), zero.alias("n"), zero.alias("ended"),
        (F.col("at") == F.col("up")).cast("long").alias("children"), "leaves", "saved",
    )
    return _merged(nodes.unionByName(given))


def prefix_trie(conversations: DataFrame, family: int = 5, spread: int = 9) -> DataFrame:
    """The trie of all rebuilt conversations, a row per node.

    Every conversation is one path of chained digests. From the greatest depth up, the conversations that end at a depth
    join the nodes that are left there, equal paths merge, every node is written out, loses its last turn and
    moves up with its counts; so nodes are found and summed in one pass, and rows carry digests and numbers, no texts.
    Where paths are deep, a round takes an eighth of the depth at once (``peel``), so rounds grow with the logarithm.

    Turns come in the order of ``turn``, null first, then of the digest of role and text; null role or text counts as
    empty; equal turn rows are turns each. Rows without conv_id take no part. A conversation without turns left is a member of
    the root only. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that shared prefixes save in the subtree) and ends_sha256 (of the ids that end there, comma-joined). An
    empty table has no nodes; other columns are ignored. The turns of one conversation meet in one task.
    """
    paths = stored(_paths(rebuilt(conversations, family, spread)), "paths")
    spark, deepest = paths.sparkSession, paths.agg(F.max("depth")).first()[0]
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    starts = paths.select("depth", "path", "sizes", "conv_id", one.alias("n"), one.alias("ended"), *(zero.alias(c) for c in _COUNTS[2:]))
    base, high, left = scratch_dir(spark, "trie"), deepest, None
    while high is not None and high >= 0:
        low = max(-1, high - max(1, high // DEEP))
        rows = starts.filter((F.col("depth") > low) & (F.col("depth") <= high))
        nodes = peel(rows if left is None else rows.unionByName(left), low, high)
        nodes.write.parquet(f"{base}/round={high}")
        nodes = spark.read.schema(nodes.schema).parquet(f"{base}/round={high}")
        left = nodes.filter(F.col("depth") == low + 1).select(
            *_cut(F.lit(low)), "conv_id", "n", zero.alias("ended"), one.alias("children"), "leaves", "saved"
        ) if low >= 0 else None
        high = low
    if deepest is None:
        nodes = peel(starts, -1, 0)
    else:
        nodes = spark.read.schema(nodes.schema).parquet(base)
    key = lambda depth: F.substring(F.col("path"), (depth - 1) * WIDE + 1, F.lit(WIDE))
    depth = F.col("depth")
    nodes = nodes.select(
        "conv_id", "depth", key(depth).alias("key"), F.when(depth > 1, key(depth - 1)).when(depth == 1, F.lit(b"")).alias("parent_key"),
        "n", "children", "leaves", "saved",
    )
    above = nodes.select((depth + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(above, ["depth", "parent_key"], "left")
    ends = _ends(paths.select("depth", key(depth).alias("key"), "conv_id"))
    nodes = nodes.join(ends, ["depth", "key"], "left")
    return nodes.select(
        "conv_id", depth.cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _ends(ended: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256): SHA-256 of the ids that end at a node, ascending, comma-joined.

    Ids are joined in portions of neighbouring numbers, so that the one task that a node's hash needs reads
    strings of thousands of ids and holds one at a time.
    """
    portion = F.shiftright("conv_id", ID_BITS)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    portions = stored(ended.groupBy("depth", "key", portion.alias("portion")).agg(ids.alias("ids")), "ended")
    parts = max(scale_count(portions.count(), 100_000), int(ended.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            out = []
            for depth, key, ids in zip(batch["depth"], batch["key"], batch["ids"]):
                if (depth, key) != at:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = (depth, key), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["depth", "key", "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=["depth", "key", "ends_sha256"])

    ordered = portions.repartition(parts, "depth", "key").sortWithinPartitions("depth", "key", "portion")
    return ordered.mapInPandas(run, "depth int, key binary, ends_sha256 string")
