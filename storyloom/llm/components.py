"""Connected components of a link table by star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storyloom.llm.common import stored


def _state(links: DataFrame) -> tuple[int, int]:
    n, mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return n, int(mark or 0)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of the component.

    ``links`` has two orderable columns, of which each row links one pair. Large-star hangs a node's larger
    neighbours below its smallest one, small-star its smaller ones; they alternate until nothing changes, in
    a number of rounds that grows with the logarithm of the table. A minimum per node is taken before
    the join, so that a hub's rows are not gathered; each round is written, so a lost executor costs one round.
    """
    u, v = links.columns
    links = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u != v").distinct()
    links = stored(links, name)
    before = _state(links)
    while before[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.union(low.select("u", F.col("m").alias("v"))).distinct()
        links = stored(small, name)
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
