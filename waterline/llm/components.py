"""Connected components of a graph given as a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.sources.storage import materialise


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every linked node, ``component`` being the smallest node reachable.

    Each round every node steps to the node of smallest hash next to it (or stays), and the graph is contracted
    along these steps. Ranking by a hash that differs by round makes long chains shrink by a constant
    factor. The smallest node of each contracted group is worked out at the end. Links with a null end
    are left out; a link of a node to itself makes the node appear, alone if nothing else links it.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    ends = materialise(ends.distinct())
    steps, rounds = None, 0
    graph = ends.filter("u <> v")
    while rounds == 0 or not graph.isEmpty():
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = F.xxhash64("v", F.lit(rounds))
        # The node itself is a candidate, so that roots are the nodes that no neighbour beats.
        best = both.groupBy("u").agg(F.min(F.struct(rank.alias("r"), "v")).alias("next"))
        step = materialise(
            best.select(
                "u",
                F.when(F.struct(F.xxhash64("u", F.lit(rounds)).alias("r"), F.col("u").alias("v")) < F.col("next"), F.col("u"))
                .otherwise(F.col("next.v"))
                .alias("root"),
            )
        )
        moved = step.filter("u <> root")
        graph = (
            graph.join(moved.select("u", F.col("root").alias("ru")), "u", "left")
            .join(moved.select(F.col("u").alias("v"), F.col("root").alias("rv")), "v", "left")
            .select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
            .filter("u <> v")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            .distinct()
        )
        graph = materialise(graph)
        hop = moved.select(F.col("u").alias("root"), F.col("root").alias("further"))
        steps = step if steps is None else materialise(
            steps.join(hop, "root", "left").select("u", F.coalesce("further", "root").alias("root"))
        )
        rounds += 1
    nodes = ends.select(F.explode(F.array("u", "v")).alias("u")).distinct()
    placed = nodes.join(steps, "u", "left").select("u", F.coalesce("root", "u").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("u").alias("component"))
    return placed.join(smallest, "root").select(F.col("u").alias("node"), "component")
