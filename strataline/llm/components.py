"""Connected components of links, by alternating large-star and small-star steps.

Both steps are grouped minima, written, and a join with them: by a broadcast while
they are few, else between two plain shuffles, of which adaptive execution splits a
hub with very many links like any other skewed key. Each step is written to the
shared folder, which cuts the lineage. Chains shrink exponentially, so rounds grow
with the logarithm of the longest path; no links are ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import small_enough, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for each node that has a link to another; the root is the smallest.

    Repeated links and links of a node to itself change nothing; links with a null
    end are left out; no links give no rows.
    """
    edges = written(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .distinct(),
        "links",
    )
    while not _are_stars(edges):
        edges = written(_small_star(written(_large_star(edges), "links")), "links")
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one link downwards, or only links upwards."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select("low", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node it knows."""
    smallest = (
        edges.select(F.col("low").alias("node"), F.col("low").alias("other"))
        .unionAll(edges.select("high", "low"))
        .groupBy("node")
        .agg(F.min("other").alias("least"))
    )
    smallest = small_enough(written(smallest, "links-smallest"))
    return edges.join(smallest, edges["low"] == smallest["node"]).select("high", F.col("least").alias("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    smallest = small_enough(written(smallest, "links-smallest"))
    found = edges.join(smallest, edges["high"] == smallest["node"])
    return (
        found.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .where(F.col("high") != F.col("low"))
        .unionAll(smallest.select("node", "least"))
        .distinct()
    )
