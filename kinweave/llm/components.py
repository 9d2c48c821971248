"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node; the root is the smallest node it can reach.

    Alternates two rewritings of the links: every node hands its larger neighbours to its
    smallest one, then every node's smaller neighbours and itself to the smallest. A node
    is only ever reduced to its minimum, so no task holds the neighbours of a node. The minima
    are stored before they are joined, so that adaptive execution can split a node with very
    many links. The links are written after each round; only a count and a checksum reach the
    driver.
    """
    low, high = F.least(a, b).alias("low"), F.greatest(a, b).alias("high")
    edges = materialise(links.select(low, high).filter("low < high").distinct(), "links")
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
        ).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).distinct()
        seen = tuple(state)
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        least = materialise(least, "minima")
        larger = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("m").alias("low"), F.col("v").alias("high"))
            .distinct()
        )
        larger = materialise(larger, "links")
        roots = materialise(larger.groupBy("high").agg(F.min("low").alias("m")), "minima")
        handed = larger.join(roots, "high").filter("low <> m")
        edges = materialise(
            handed.select(F.col("m").alias("low"), F.col("low").alias("high"))
            .unionByName(roots.select(F.col("m").alias("low"), "high"))
            .distinct(),
            "links",
        )
