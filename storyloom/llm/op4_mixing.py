"""Mixing sources to target weights, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storyloom.llm.common import digest, stored, word_count

# Sources numbered by one window; more are numbered by ranges.
RANGE = 100_000


def order_key(doc_id: Column, seed: int) -> Column:
    """A hash-random key; as text it sorts alike in every engine."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(str(seed))))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (one row each) with ``place``, counted from 0 by code point, null last.

    The rows are sorted into ranges and written, so that ranges stay as they are; a running sum over the few range
    sizes then gives each range its first number.
    """
    n = sources.count()
    parts = max(1, -(-n // RANGE))
    order = [F.col("source").asc_nulls_last()]
    ranged = sources.repartitionByRange(parts, *order) if parts > 1 else sources.coalesce(1)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "source-ranges")
    sizes = ranged.groupBy("part").count()
    before = sizes.select(
        "part", (F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before")
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.join(before, "part").select(
        *sources.columns, (F.coalesce("before", F.lit(0)) + within).cast("long").alias("place")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int, name: str = "targets") -> DataFrame:
    """(source, source_size, n, target): shares of all words by weight, none above ``most`` times its source.

    What a capped source leaves is shared anew among the others by weight. The share per unit of weight only
    grows from round to round, so a capped source stays capped; each round brings two sums to the driver.
    """
    table = numbered(sizes)
    place = F.col("place") % len(weights)
    weight = F.get(F.array(*map(F.lit, weights)), place.cast("int"))
    table = stored(table.withColumn("weight", weight), name)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap, share = F.lit(most) * F.col("source_size"), 0.0
    while total:
        full = cap < F.lit(share) * F.col("weight")
        row = table.agg(
            F.sum(F.when(full, cap).otherwise(0)).alias("fixed"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open")
        ).first()
        new = (total - row["fixed"]) / row["open"] if row["open"] else share
        if new <= share:
            break
        share = new
    target = F.least(F.lit(share) * F.col("weight"), cap.cast("double"))
    return table.select("source", "source_size", "n", target.alias("target"))


def _taken(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, doc_id, size, key, ...) rows with source_size, target and taken."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goals = targets(sizes, weights, most)
    largest = goals.agg(F.max("n")).first()[0] or 0
    # ranges of a source, and rows in a range, both grow with the square root of its rows
    digits = 1
    while largest > 256**digits:
        digits += 1
    # whole passes over a source, then what is left of the budget
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = F.floor(F.col("target")).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    # equal ranges of the random key; words before each range, per source
    ranges = rows.groupBy("source", F.substring("key", 1, digits).alias("range")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    cut = F.col("source").eqNullSafe(F.col("of"))
    goals = stored(
        goals.join(ranges.withColumnRenamed("source", "of"), cut & (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")), "left")
        .select("source", "source_size", "target", "epochs", "rest", F.col("range").alias("cut"), "before"),
        "mix-budgets",
    )
    g = goals.withColumnRenamed("source", "of")
    joined = rows.join(g, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    range_ = F.substring("key", 1, digits)
    # sources whose rest is zero or all of it have no cut range, or one that nothing reaches into
    below = F.col("rest") > 0
    part = F.when(~below, 0).when(F.col("cut").isNull() | (range_ < F.col("cut")), 1).when(range_ > F.col("cut"), 0).otherwise(2)
    joined = joined.withColumn("part", part)
    plain = joined.filter("part < 2").withColumn("extra", F.col("part") * F.col("size"))
    within = Window.partitionBy("source").orderBy("key", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    near = joined.filter("part = 2")
    used = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    near = near.withColumn("extra", F.least(F.greatest(F.col("rest") - used, F.lit(0)), F.col("size")))
    out = plain.unionByName(near)
    return out.withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))


def mix(
    documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Words that a mix takes of every document, so that sources meet their target shares.

    Sources in order of code point, null last, have ``weights``, repeating, and share all words; a target stops
    at ``most`` times its source's size. Documents get a hash-random key, which is sorted in equal ranges; sums
    per range give each range's place in the running sum, and only the range that holds a source's cut is
    sorted row by row. A source is taken whole as often as its target holds it, then up to the cut; the
    document at the cut gives the words that are missing, so a source gives ``floor(target)`` exactly.

    One row per row that goes in: doc_id, size, source_size, target, taken. Null and empty texts have size 0 and
    give nothing; null is a source of its own; documents of one id follow each other by size; an empty table gives
    an empty result; other columns are ignored. Reruns agree.
    """
    d = documents
    rows = d.select(d[source_col].alias("source"), d[id_col].alias("doc_id"), word_count(d[text_col]).alias("size"))
    rows = stored(rows.withColumn("key", order_key(F.col("doc_id"), seed)).withColumn("tie", F.lit(0)), "mix-rows")
    return _taken(rows, weights, most).select("doc_id", "size", "source_size", "target", "taken")


def mixed(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``documents``, all columns, each as often as the mix takes it.

    A document at a cut counts as taken once more. Documents without words give no words and are left out, and so are
    those that lie beyond their source's cut. Rows that agree in id and text share one decision per row.
    """
    d = documents
    whole = d.select(F.struct(*(d[f"`{c}`"] for c in d.columns)).alias("row"))
    k1, k2 = digest(F.col("row.doc_id"), F.col("row.text"), F.col("row.source"))
    rows = whole.select(
        F.col("row.source").alias("source"), F.col("row.doc_id").alias("doc_id"), word_count(F.col("row.text")).alias("size"),
        k1.alias("tie"), k2.alias("d2"),
    )
    rows = stored(rows.withColumn("key", order_key(F.col("doc_id"), seed)), "mix-rows")
    taken = _taken(rows, weights, most).filter("size > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    # rows that agree are summed, then dealt out evenly: their sum is what counts
    counts = taken.groupBy("tie", "d2").agg(F.sum(copies).alias("copies"), F.count("*").alias("rows")).filter("copies > 0")
    found = whole.withColumn("tie", k1).withColumn("d2", k2).join(counts, ["tie", "d2"])
    single = found.filter("rows = 1").select("row", "copies")
    # of a repeated row one stands for all
    several = found.filter("rows > 1").dropDuplicates(["tie", "d2"]).select("row", "copies")
    every = single.union(several)
    return every.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
