"""Shards of equal bytes by sampled splitters, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storyloom.llm.common import stored

# Ranges that a large table is cut into; they grow with it up to the second number, which bounds the splitters.
RANGES, MOST_RANGES = 2_048, 65_536
# Rows of a range, at least and at most, that set the number of ranges outside those bounds.
FEW_ROWS, MANY_ROWS = 16, 500_000
# Sampled keys per range.
POINTS = 32
# A group of equal texts stays in one shard up to this part of a shard's bytes.
WHOLE = 32
# Bits of a key that belong to the row; those above belong to the text.
ROW_BITS = 20
# Equal rows are counted as one; this many of them come out of one row of a task.
COPIES = 50_000


def _hex_bits(column: Column, digits: int) -> Column:
    """The first hexadecimal digits of the MD5 of a string, as a number."""
    return F.conv(F.substring(F.md5(column), 1, digits), 16, 10).cast("long")


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, size, text_crc32, key, n): ``n`` equal rows each; the key's upper 40 bits are of the text, the rest of the id."""
    text = F.coalesce(documents[text_col], F.lit(""))
    id_ = documents[id_col]
    key = F.shiftleft(_hex_bits(text.cast("binary"), 10), ROW_BITS).bitwiseOR(
        _hex_bits(F.coalesce(id_.cast("string"), F.lit("")).cast("binary"), ROW_BITS // 4)
    )
    rows = documents.select(
        id_.alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key")
    )
    return rows.groupBy("doc_id", "size", "text_crc32", "key").agg(F.count("*").alias("n"))


def _group(key: Column) -> Column:
    return F.shiftright(key, ROW_BITS)


def splitters(rows: DataFrame, total: int, count: int, shards: int) -> DataFrame:
    """One row ``cuts``: the sorted first keys of all ranges but the first.

    Keys are drawn with a chance that grows with their rows' size (and by the mean size for each row, so that
    many small rows are split as well), by a hash of the key, and cut at quantiles. A cut inside a group of equal
    texts moves to the group's start, unless the group has more bytes than may stay whole: such an overfull
    group is subdivided at the cuts drawn from it.
    """
    ranges = min(max(RANGES, count // MANY_ROWS), MOST_RANGES, max(1, count // FEW_ROWS))
    weight = (F.col("size") + F.lit(total / count)) * F.col("n")
    chance = weight * F.lit(ranges * POINTS / (2 * total))
    # whole points, and one more with the probability of the rest
    draw = F.pmod(F.xxhash64("key", "doc_id", "size"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    points = rows.select("key", F.floor(chance + draw).cast("int").alias("m")).filter("m > 0")
    points = points.select(F.explode(F.array_repeat("key", F.col("m"))).alias("key"))
    quantiles = F.from_json(F.lit(str([i / ranges for i in range(1, ranges)] or [0.0])), "array<double>")
    cuts = points.agg(F.percentile_approx("key", quantiles, 4 * ranges).alias("cuts"))
    cuts = stored(cuts.select(F.explode(F.array_distinct("cuts")).alias("key")), "drawn-splitters")
    several = cuts.groupBy(_group(F.col("key")).alias("group")).count().filter("count > 1").select("group")
    sizes = rows.join(F.broadcast(several), _group(F.col("key")) == F.col("group"), "left_semi")
    sizes = sizes.groupBy(_group(F.col("key")).alias("group")).agg(F.sum(F.col("size") * F.col("n")).alias("bytes"))
    overfull = sizes.filter(F.col("bytes") * WHOLE * shards > total).select("group", F.lit(True).alias("overfull"))
    cuts = cuts.withColumn("group", _group(F.col("key"))).join(F.broadcast(overfull), "group", "left")
    start = F.shiftleft("group", ROW_BITS)
    both = F.explode(F.when(F.col("overfull"), F.array(start, "key", F.shiftleft(F.col("group") + 1, ROW_BITS))).otherwise(F.array(start)))
    return cuts.select(both.alias("key")).agg(F.sort_array(F.collect_set("key")).alias("cuts"))


def _range_of(key: Column, cuts: Column, count: int) -> Column:
    """Number of the range: how many cuts are not above the key, by bisection."""
    steps = max(1, count.bit_length())
    middle = lambda s: F.floor((s["low"] + s["high"]) / 2).cast("int")

    def step(s: Column, _: Column) -> Column:
        open_, here = s["low"] < s["high"], middle(s)
        below = F.get(cuts, here) <= key
        return F.struct(
            F.when(open_ & below, here + 1).otherwise(s["low"]).alias("low"), F.when(open_ & ~below, here).otherwise(s["high"]).alias("high")
        )

    first = F.struct(F.lit(0).alias("low"), F.lit(count).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, step, lambda s: s["low"])


def shards(
    documents: DataFrame, count: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard and place of every document; shards 0 to ``count`` - 1 hold nearly equal bytes.

    A document has the UTF-8 bytes of its text plus 1, and a key: a hash of the text, then one of the id. Cuts between
    key ranges come from a size-weighted sample (``splitters``); exact sums per range and a running sum over the ranges
    give every range its place among all bytes, and rows are sorted only within their range. A row goes where the
    middle of its bytes lies in the order of keys. A group of equal texts goes where its own middle lies, so it stays
    together, if it has at most 1/32 of a shard; a larger one is divided at the shard's border. So a
    shard differs from an equal part by 1/32 of it, or by the longest document, at most. The sample decides which task
    does what, never the result.

    One row per row that goes in: doc_id, size, text_crc32 (of the UTF-8 text), law (``bytes``), shard, slot (from 0 without
    gaps in each shard, by key, then id) and grown_shard, which this law leaves null. Null texts count as empty; a null id is
    an id like any other; equal rows follow each other; texts whose 40-bit hashes agree count as one group; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = stored(keyed(documents, id_col, text_col), "shard-rows")
    totals = rows.agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows")).first()
    total, n = totals["bytes"] or 1, totals["rows"] or 1
    # at most 3 x MOST_RANGES numbers; from_json folds to one array literal
    cuts = splitters(rows, total, n, count).first()["cuts"]
    rows = stored(rows.withColumn("range", _range_of(F.col("key"), F.from_json(F.lit(str(cuts)), "array<bigint>"), len(cuts))), "ranged-rows")
    # one row per range, of which there are at most MOST_RANGES and what overfull groups add
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("range").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows"))
    ranges = ranges.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before")
    )
    rows = rows.join(F.broadcast(ranges), "range").withColumn("group", _group(F.col("key")))
    ordered = Window.partitionBy("range").orderBy("group", "key", F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    running = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("range", "group")
    rows = rows.withColumn("start", F.col("bytes_before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(running), F.lit(0)))
    rows = rows.withColumn("place", F.col("rows_before") + F.coalesce(F.sum("n").over(running), F.lit(0)))
    rows = rows.withColumn("group_start", F.min("start").over(whole)).withColumn("group_bytes", F.sum(F.col("size") * F.col("n")).over(whole))
    # groups that cuts divide are overfull, so there are fewer than WHOLE x count of them
    divided = sorted({c >> ROW_BITS for c in cuts if c % (1 << ROW_BITS)})
    together = (F.col("group_bytes") * (WHOLE * count) <= total) & ~F.col("group").isin(divided)
    rows = rows.withColumn("middle2", F.when(together, 2 * F.col("group_start") + F.col("group_bytes")))
    rows = rows.select("doc_id", "size", "text_crc32", "start", "place", "middle2", "n")
    # equal rows come out one by one again; a great many of them first as portions, dealt anew
    few = rows.filter(F.col("n") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    portions = rows.filter(F.col("n") > COPIES)
    portions = portions.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    portions = portions.repartition(F.col("doc_id"), F.col("text_crc32"), F.col("first"))
    last = F.least(F.col("first") + COPIES, F.col("n")) - 1
    many = portions.withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("first")
    every = few.unionByName(many)
    middle2 = F.coalesce("middle2", 2 * (F.col("start") + F.col("copy") * F.col("size")) + F.col("size"))
    shard = F.least(F.expr("least(m2 * :c div (2 * :t), :c - 1)".replace(":c", str(count)).replace(":t", str(total))), F.lit(count - 1))
    every = every.withColumn("m2", middle2).withColumn("shard", shard.cast("int")).withColumn("place", F.col("place") + F.col("copy"))
    every = stored(every.select("doc_id", "size", "text_crc32", "shard", "place"), "sharded")
    first = every.groupBy("shard").agg(F.min("place").alias("first"))
    return every.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
