"""Whole-graph measures as rounds of joins: betweenness by batches of sources, bridges by labels summed up a spanning forest."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frames import settled, skew_join, superseded
from graphloom.operators.graph import both_ways, connected_components, simple_edges


def _levels(e: DataFrame, sources: DataFrame) -> list[DataFrame]:
    """Of a breadth-first search from each of sources(source), level by level: (source, node, paths), paths how many shortest ones lead there."""
    front = settled(sources.select("source", F.col("source").alias("node"), F.lit(1.0).alias("paths")))
    levels = [front]
    while True:
        step = front.join(e, front.node == e.src).groupBy("source", F.col("dst").alias("node")).agg(F.sum("paths").alias("paths"))
        # whoever is a neighbour of a level lies on the level before, on it, or behind it
        for near in levels[-2:]:
            step = step.join(near.select("source", "node"), ["source", "node"], "left_anti")
        front = settled(step)
        if front.isEmpty():
            superseded(front)
            return levels
        levels.append(front)


def _shares(e: DataFrame, levels: list[DataFrame]) -> list[DataFrame]:
    """(node, b) of each level but the first: what the shortest paths from all sources through a node add up to, from the last level back."""
    sums, below = [], None
    for level in reversed(levels[1:]):
        if below is None:
            rows = level.withColumn("b", F.lit(0.0))
        else:
            given = below.join(e, below.node == e.src).select("source", F.col("dst").alias("node"), ((1 + F.col("b")) / F.col("paths")).alias("g"))
            given = given.groupBy("source", "node").agg(F.sum("g").alias("g"))
            rows = level.join(given, ["source", "node"], "left").select("source", "node", "paths", (F.col("paths") * F.coalesce("g", F.lit(0.0))).alias("b"))
        last, below = below, settled(rows.select("source", "node", "paths", "b"))
        sums.append(settled(below.groupBy("node").agg(F.sum("b").alias("b"))))
        if last is not None:
            superseded(last)
    if below is not None:
        superseded(below)
    return sums


def betweenness(edges: DataFrame, batch: int = 4096, sources: DataFrame | None = None) -> DataFrame:
    """(node, betweenness) of the simple undirected graph: over all pairs of other nodes, the share of shortest paths that lead through a
    node, added up and divided by (n-1)(n-2)/2; 0 for all nodes of a graph of two.

    Sources are searched from in batches of about `batch`: forwards level by level with path counts, then
    backwards with the sums. A batch holds a row for each of its sources and each node, and only its own levels stay
    on disk. sources(node), if given, are the only ones searched from, for an estimate: the sums are then scaled up to all nodes.
    Parallel edges count once, loops not at all; a graph without edges gives no rows.
    """
    e = settled(both_ways(edges))
    nodes = settled(e.select(F.col("src").alias("node")).distinct())
    n = nodes.count()
    start = nodes if sources is None else nodes.join(sources.select("node").distinct(), "node", "left_semi")
    start = settled(start.select(F.col("node").alias("source")))
    m = start.count()
    batches = max(1, -(-m // batch))
    total: list[DataFrame] = []
    for i in range(batches):
        own = start if batches == 1 else start.filter(F.pmod(F.xxhash64("source"), F.lit(batches)) == i)
        levels = _levels(e, own)
        parts = _shares(e, levels)
        for level in levels:
            superseded(level)
        if total or len(parts) > 1:  # one table for all batches so far
            both = total + parts
            joined = both[0]
            for more in both[1:]:
                joined = joined.unionByName(more)
            total = [settled(joined.groupBy("node").agg(F.sum("b").alias("b")))]
            for done in both:
                superseded(done)
        else:
            total = parts
    scale = n / m / ((n - 1) * (n - 2)) if n > 2 and m else 0.0
    if not total:
        return nodes.select("node", F.lit(0.0).alias("betweenness"))
    return nodes.join(total[0], "node", "left").select("node", (F.coalesce("b", F.lit(0.0)) * scale).alias("betweenness"))


def spanning_forest(edges: DataFrame) -> DataFrame:
    """(node, parent, depth) of a breadth-first tree in each component, whose root, the smallest node, is its own parent.

    One round for each level, so the longest shortest path from a root bounds the rounds.
    """
    e = settled(both_ways(edges))
    roots = connected_components(edges).select(F.col("component").alias("node")).distinct()
    front = settled(roots.select("node", F.col("node").alias("parent"), F.lit(0).alias("depth")))
    levels = [front]
    for depth in itertools.count(1):
        step = front.join(e, front.node == e.src).groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
        for near in levels[-2:]:
            step = step.join(near.select("node"), "node", "left_anti")
        front = settled(step.withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            superseded(front)
            break
        levels.append(front)
    forest = levels[0]
    for level in levels[1:]:
        forest = forest.unionByName(level)
    forest = settled(forest)
    for level in levels:
        superseded(level)
    superseded(e)
    return forest


def subtree_xor(forest: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """(node, *columns): the XOR of values(node, *columns) over the node and all below it; missing values are 0.

    By doubling: when sums reach 2^i levels down, the ancestor 2^i levels up takes them over, so the logarithm
    of the depth bounds the rounds.
    """
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in columns]
    up = F.when(F.col("parent") != F.col("node"), F.col("parent")).alias("up")
    state = settled(forest.join(values, "node", "left").select("node", up, *zero))
    while True:
        rising = state.filter("up is not null")
        if rising.isEmpty():
            return state.drop("up")
        given = rising.groupBy(F.col("up").alias("node")).agg(*(F.bit_xor(c).alias(f"_{c}") for c in columns))
        # the number of nodes that share an ancestor is known, so that a hot one can be joined by broadcast
        above = state.select(F.col("node").alias("up"), F.col("up").alias("next"))
        counted = rising.groupBy("up").agg(F.count("*").alias("n")).join(above, "up")
        jumped = skew_join(rising.select("node", "up"), counted, ["up"], "n", state.count()).select("node", "next")
        sums = [F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0).cast("long"))).alias(c) for c in columns]
        fresh = state.drop("up").join(given, "node", "left").select("node", *sums).join(jumped, "node", "left")
        fresh = settled(fresh.select("node", F.col("next").alias("up"), *columns))
        superseded(state)
        state = fresh


def bridges(edges: DataFrame) -> DataFrame:
    """(src, dst), src < dst, of the edges of the simple undirected graph whose removal splits a component.

    Every edge outside a spanning forest gets two fixed pseudo-random 64-bit labels, which are XORed into both its ends and from there up
    the tree. Above a node they cancel out just where no such edge leads out of its subtree, and the edge to its parent is then a bridge. An edge
    that isn't one is taken for one with a chance of 2^-128. Parallel edges count once, loops not at all.
    """
    e = settled(simple_edges(edges))
    forest = spanning_forest(e)
    tree = forest.filter("node <> parent")
    tree = tree.select(F.least("node", "parent").alias("src"), F.greatest("node", "parent").alias("dst"), "node")
    rest = e.join(tree.select("src", "dst"), ["src", "dst"], "left_anti")
    labels: list[Column] = [F.xxhash64(F.lit(salt), "src", "dst").alias(name) for salt, name in ((1, "x"), (2, "y"))]
    ends = rest.select(F.explode(F.array("src", "dst")).alias("node"), *labels)
    values = ends.groupBy("node").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    sums = subtree_xor(forest, values, ["x", "y"])
    return tree.join(sums.filter("x = 0 and y = 0"), "node").select("src", "dst")
