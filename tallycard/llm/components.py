"""Connected components of a table of links, by alternating star contraction."""

from pyspark.sql import functions as F

from tallycard.llm.tables import kept


def components(links, purpose="components"):
    """One row (node, root) for each node of the links (a, b); root is the component's smallest node.

    Each round hangs neighbours onto the smallest node near them, first the larger ones, then all. Minima are
    reduced before the shuffle, so a node with very many links sends one row per task. The links of a round are
    stored, and the rounds end when all nodes hang on a root; their number grows with the logarithm of the size.
    """
    links = kept(_ordered(links), purpose)
    while not _are_stars(links):
        large = _star(links, both_ways=True).persist()
        links = kept(_ordered(_star(large, both_ways=False)), purpose)
        large.unpersist()
    roots = links.select(F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("root").alias("node"), "root")
    )


def _are_stars(links):
    """Whether each node hangs on one other, on which others hang and which hangs on none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.where((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).limit(1).count()


def _ordered(links):
    """Distinct links with a > b."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(links, both_ways):
    """Links from neighbours to the smallest node among a node and its neighbours.

    `links` have a > b. Both ways, the larger neighbours of a node are linked to its minimum; else the smaller ones
    and the node itself.
    """
    if both_ways:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Larger neighbours of x are the a of links whose b is x.
        out = links.join(least.select(F.col("a").alias("b"), "m"), "b")
        return _ordered(out.select("a", F.col("m").alias("b")))
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    out = links.join(least, "a")
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )
