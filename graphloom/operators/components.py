"""Connected components of a link table, by alternating stars: no step gathers a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import frames
from graphloom.operators.frames import settled, skew_join, superseded


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger id u to the smaller v."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n"))
    return skew_join(both.filter("v > u"), least.filter("n > 0"), ["u"], "n", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return skew_join(edges, least, ["u"], "n", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) of every linked id but the smallest of its component; component is that smallest id.

    Each round is written to the shared folder, and takes the place of the last. Nodes with very many
    links are joined without a shuffle. The number of rounds grows with the logarithm of the longest chain. Nulls and self-links are ignored; no links give no rows.
    """
    edges = settled(_oriented(links.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()))
    state = None
    while True:
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not sums[0] or tuple(sums) == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = tuple(sums)
        larger = _oriented(_large_star(edges, sums[0]))
        larger = settled(larger) if sums[0] > frames.FEW_ROWS else larger
        smaller = settled(_oriented(_small_star(larger, 2 * sums[0])))
        for done in (edges, larger):
            superseded(done)
        edges = smaller
