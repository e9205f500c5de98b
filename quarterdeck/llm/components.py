"""Connected components of a table of links, by alternating large and small stars.

Each round replaces links by links to smaller nodes until nothing changes. A node's links are
never gathered: its least neighbour is an aggregate that is joined back. Every round is written to
the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b); the component is its least node."""
    now, before = written(_down(links), "links"), None
    while before != (before := _state(now)):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                            F.col("m").alias("b"))
        now = written(_down(large), "links")
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        small = now.join(least, "a")
        now = written(_down(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(least.select("a", F.col("m").alias("b")))), "links")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                        F.least("a", "b").alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
