"""Connected components of a graph given as rows of links."""

from pyspark.sql import functions as F

from stowline.llm.storage import forget, saved


def components(links, name="links"):
    """Rows (node, component): each linked node with the smallest node it reaches.

    ``links`` has two columns, a and b, of one type that has an order (numbers, or structs of
    them); direction, repeats and self-links don't matter, rows with a null are left out. Alternates two steps until nothing moves: every
    node hands its larger neighbours, then its smaller ones, to its smallest. The number of
    links never grows, and chains halve in each round. The smallest neighbour comes from an
    aggregation and goes back by a join, so no node's neighbours meet in one row.
    """
    edges = saved(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        name,
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v"))).distinct()
        )
        old, edges = edges, saved(small, name)
        forget(old)
    least = edges.groupBy("u").agg(F.min("v").alias("component"))
    return least.select(F.col("u").alias("node"), "component").union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def joined(parent, a, b):
    """Join nodes a[k] and b[k] for all k in an array of each node's smallest known node."""
    import numpy as np

    while True:
        left, right = parent[a], parent[b]
        apart = left != right
        if not apart.any():
            return parent
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
