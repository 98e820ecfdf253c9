"""Connected components of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import temporary_steps, write_through


def _contracted(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links to the least neighbour: from larger neighbours (``both_ways``), else from smaller ones and the node."""
    if both_ways:
        near = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        hung = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.unionAll(least.select("u", F.col("m").alias("v")))
    return hung.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) but the roots; a root is its component's least node.

    Each round hangs neighbours on the least node of a neighbourhood; a component of d links
    across takes about log d rounds. Links are stored after each round, and only a count and a
    checksum of them reach the driver. A node with very many links is one row of the grouped
    side and a skewed key of the other, which Spark splits.
    """
    def seal(rows: DataFrame):
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    with temporary_steps(links.sparkSession) as steps:
        held = write_through(ordered, "links")
        before = seal(held)
        while before[0]:
            held = write_through(_contracted(_contracted(held, True), False), "links")
            now = seal(held)
            if now == before:
                break
            before = now
        return steps.keep(held.select(F.col("u").alias("node"), F.col("v").alias("root")), "roots")
