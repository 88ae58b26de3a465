"""Connected components by alternating large-star and small-star steps, each stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; root is the smallest node reachable.

    The loop ends when a round leaves the edges as they were: then they are
    stars. Rounds grow with the logarithm of the largest component. Edges are
    only counted and summed on the driver, never collected.
    """
    current = stored(edges.where("a != b").select("a", "b").distinct(), "edges")
    state = None
    while True:
        r = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not r[0] or (r[0], r[1]) == state:
            break
        state = (r[0], r[1])
        large = stored(_large_star(current), "large-star")
        small = stored(_small_star(large), "small-star")
        discard(current, large)
        current = small
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def with_links(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components ``label`` (node, root; as ``components`` returns them) with further ``links`` a, b.

    Only the components that these links bring together are worked on, a node each; not the links that made them.
    """
    if label is None:
        return components(links)
    ends = links
    for c in ("a", "b"):
        ends = ends.join(label.select(F.col("node").alias(c), F.col("root").alias(f"_{c}")), c, "left")
    merged = components(ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
    fresh = merged.select("node", F.col("node").alias("root")).join(label.select("node"), "node", "left_anti")
    moved = merged.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return label.unionByName(fresh).join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))


def smallest_reachable(edges: DataFrame, values: DataFrame) -> DataFrame:
    """``node, value``: the smallest ``value`` of the component, for every node that has an edge.

    ``values``: ``node, value``, one row per node; NULL values do not count.
    """
    found = stored(components(edges), "components")
    least = found.join(values, "node").groupBy("root").agg(F.min("value").alias("value"))
    return found.join(least, "root").select("node", "value")
