"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtide.plans.lineage import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "stars") -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node reachable.

    `edges` has two columns of one sortable type; loops, repeated and null ends are ignored. Each round hangs
    the neighbours of a node under its smallest neighbour: first the larger ones, then the smaller ones. Minima
    are combined within tasks, written and joined back, so a node with a third of all edges is never one group, and
    adaptive execution can split its join (with the aggregation still below it, it could not). The rounds end when every tree is a star, after about log² of the longest
    path; each writes its edges to the shared folder, so plans stay short and lost executors cost one round.
    """
    a, b = edges.columns
    pairs = edges.filter(F.col(a) != F.col(b))
    pairs = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    mark = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"))
    now, seen = scratch.save(pairs, f"{name}0", *mark)
    turn = 0
    while seen["n"]:
        turn += 1
        hung = _small_star(_large_star(now, scratch, f"{name}{turn}-large"), scratch, f"{name}{turn}-small")
        now, found = scratch.save(hung, f"{name}{turn}", *mark)
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _large_star(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Larger neighbours of a node go under the smallest of the node and its neighbours. u > v throughout."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minima = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least, _ = scratch.save(minima, name)
    # (u, v) with v larger than u is the reverse of a stored pair
    up = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """A node and its smaller neighbours go under the smallest of these."""
    pairs, _ = scratch.save(pairs, f"{name}-pairs")  # read twice
    least, _ = scratch.save(pairs.groupBy("u").agg(F.min("v").alias("m")), name)
    moved = pairs.join(least, "u").filter(F.col("v") != F.col("m"))
    hung = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
