"""Connected components by alternating star operations; every step is a join and a minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from demandkit.runtime import settle

#: Links of a task at least, as far as there are more than LEAST_TASKS tasks.
TASK_LINKS, LEAST_TASKS = 50_000, 8


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has a link.

    Large-star hangs the larger neighbours of each node on its smallest neighbour,
    small-star the node and its smaller neighbours; both keep the components and end
    in stars around the smallest nodes after few rounds. No neighbour list is gathered.
    """
    u, v = F.col(left).cast("long"), F.col(right).cast("long")
    edges = settle(
        links.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links"
    )
    before = _mark(edges)

    def stored(table: DataFrame, purpose: str) -> DataFrame:
        # Few links are not worth a task for each shuffle partition in every step.
        return settle(table.coalesce(max(LEAST_TASKS, before[0] // TASK_LINKS)), purpose)

    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The smallest neighbours are written first, so that the joins can split a node with most of the edges.
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = stored(small.filter("u > v").distinct(), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
