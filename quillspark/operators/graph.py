"""Graph operators on edge tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import cut


def signature(links: DataFrame) -> tuple:
    """Number of edges (columns u, v) and two sums over their hashes; no shuffle but one row for each task."""
    low = lambda h: h.bitwiseAND(F.lit((1 << 31) - 1))
    return tuple(links.agg(F.count(F.lit(1)), F.coalesce(F.sum(low(F.xxhash64("u", "v"))), F.lit(0)), F.coalesce(F.sum(low(F.xxhash64("v", "u", F.lit(1)))), F.lit(0))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node of its component) for every node of an edge.

    Alternating large-star and small-star contraction: the rounds grow with the logarithm of the diameter, and
    every round keeps at most as many edges as there were. A node with very many edges is handled by partial
    aggregation; nothing is gathered to a node's task. Self loops give singletons; repeated and reversed edges
    count once; null ends are left out. Each round is cut at the checkpoint folder; the rounds end
    when the number of edges and two sums of their hashes stay the same, which one aggregation tells.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    nodes = cut(both.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    links = cut(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    seen = signature(links)
    while True:
        # large star: every greater neighbour of u is joined to the least of u's neighbourhood
        around = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: u and its lesser neighbours are joined to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        links = cut(small.where("u != v").distinct())
        now = signature(links)
        if now == seen:
            break
        seen = now
    return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def hop_distances(edges: DataFrame, seeds: DataFrame, fold_every: int = 32) -> DataFrame:
    """node, distance: least hops from any seed (column node) along undirected edges (columns a, b).

    A frontier loop that goes on until a round finds nothing new, however long the paths are. Neighbours of a
    node are at most one level away from it, so a new level is what its frontier's neighbours have beyond the
    last two levels: no round touches all nodes seen. Every fold_every levels what was found is written
    together, so that the plan stays short. Unreachable nodes have no row; seeds have distance 0 whether or
    not they have edges. Null ends and seeds are left out.
    """
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
    links = cut(both.where("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct())
    frontier = cut(seeds.select("node").where("node IS NOT NULL").distinct())
    before = frontier
    done: list[DataFrame] = [frontier.withColumn("distance", F.lit(0))]
    hop = 0
    while True:
        hop += 1
        reached = frontier.join(links, F.col("node") == F.col("u")).select(F.col("v").alias("node")).distinct()
        found = cut(reached.join(frontier.union(before), "node", "left_anti"))
        if found.isEmpty():
            return functools.reduce(DataFrame.unionByName, done)
        done.append(found.withColumn("distance", F.lit(hop)))
        frontier, before = found, frontier
        if len(done) >= fold_every:
            done = [cut(functools.reduce(DataFrame.unionByName, done))]
