"""Connected components over a table of links, by repeated joins and stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.llm.text import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def roots(links: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node of its component, for every node of `links(u, v)`.

    Alternating stars shrink every component to one star; the number of rounds grows with the
    logarithm of its size.  Each round is a stored table, so a lost executor costs one round.  Nulls,
    loops and repeated links are ignored; without links the result is empty.
    """
    links = links.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).select("u", "v")
    current = stored(_small_star(stored(links.distinct(), "links")), "links")
    print_of = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = print_of(current)
    while before[0]:
        current = stored(_small_star(_large_star(current)), "links")
        now = print_of(current)
        if now == before:
            break
        before = now
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
