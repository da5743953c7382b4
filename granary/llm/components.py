"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link, root being the least node of its component.

    Alternates large-star and small-star steps, each two shuffles over the links, until neither changes a link; the
    links never outnumber those given, and each step's are cut by a checkpoint. Of a hub's links only its least
    neighbour is aggregated, before the shuffle, and adaptive execution splits its join."""
    edges = checkpointed(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = checkpointed(large)
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        joined = large.join(low, F.col("u") == F.col("k"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
        small = checkpointed(small.where("u <> v").distinct())
        changed = small.join(edges, ["u", "v"], "left_anti").limit(1).count() or edges.join(small, ["u", "v"], "left_anti").limit(1).count()
        edges = small
        if not changed:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
