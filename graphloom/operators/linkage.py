"""Hierarchical clustering of a similarity table, by rounds in which all reciprocally nearest clusters merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import frames
from graphloom.operators.components import components
from graphloom.operators.frames import settled, skew_join, superseded


def _named(rows: DataFrame, table: DataFrame, key: str, n: int) -> DataFrame:
    """rows joined with a table of unique keys, any of which may have a large share of the n rows."""
    if n <= frames.FEW_ROWS:
        return rows.join(table, key)
    return skew_join(rows, rows.groupBy(key).agg(F.count("*").alias("_n")).join(table, key), [key], "_n", n).drop("_n")


#: How the similarity of two clusters follows from that of their members; pairs that the table lacks have similarity 0.
LINKAGES = ("average", "single", "complete")


def linkage_clusters(pairs: DataFrame, nodes: DataFrame, threshold: float, linkage: str = "average", merges: bool = False) -> DataFrame:
    """(id, cluster) of all nodes(id): the clusters that are left when the most similar two are merged until none reaches `threshold` (above 0).

    pairs(a, b, similarity) is a sparse table, each pair once in either order; a pair that it lacks has similarity 0, and others
    shouldn't be below 0. Clusters are as similar as the mean over all pairs of their members (average), the most similar pair
    (single), or the least similar (complete). cluster is the smallest id in it.

    In each round every cluster finds its nearest, and all pairs that are each other's nearest merge at once. These
    linkages never bring a merged cluster nearer to a third one than its nearer part was, so the clusters are those that
    merging one pair at a time gives. Of equally similar pairs that with the smallest ids counts as nearest. The table shrinks
    with each round, and each round takes the place of the last on disk; no task holds a cluster. Pairs with an id that nodes lack, a
    null, or twice the same id are left out; repeated ones count once, with the largest similarity.

    merges: also how each cluster came about, as rows (round, cluster, merged, similarity) instead.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"linkage is one of {LINKAGES}, not {linkage!r}")
    if threshold <= 0:
        raise ValueError("the threshold must be above 0, as pairs that the table lacks have similarity 0")
    place = settled(nodes.select("id").filter("id is not null").distinct().select("id", F.col("id").alias("cluster")))
    p = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("similarity").cast("double").alias("s")).filter("a < b and s > 0")
    p = p.groupBy("a", "b").agg(F.max("s").alias("s"))
    p = p.join(place.select(F.col("id").alias("a")), "a", "left_semi").join(place.select(F.col("id").alias("b")), "b", "left_semi")
    if linkage == "single" and not merges:  # whatever a chain of similar pairs joins
        found = components(p.filter(F.col("s") >= threshold), "a", "b")
        return place.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("cluster"))
    # t: the sum over pairs of members, or the extreme; m: how many pairs of members the table has
    table = settled(p.select("a", "b", F.col("s").alias("t"), F.lit(1).cast("long").alias("m"), F.lit(1).cast("long").alias("x"), F.lit(1).cast("long").alias("y")))
    joined_at: list[DataFrame] = []
    round_, n_rows, n = 0, place.count(), table.count()  # the table only shrinks
    while True:
        round_ += 1
        if linkage == "average":
            near = F.col("t") / (F.col("x") * F.col("y"))
        elif linkage == "single":
            near = F.col("t")
        else:
            near = F.when(F.col("m") == F.col("x") * F.col("y"), F.col("t")).otherwise(0.0)
        live = table.withColumn("s", near).filter(F.col("s") >= threshold)
        both = live.select(F.explode(F.array(F.struct(F.col("a").alias("c"), "a", "b", "s"), F.struct(F.col("b").alias("c"), "a", "b", "s"))).alias("r")).select("r.*")
        # the order is of pairs, the same from both sides: most similar, then smallest ids
        best = both.groupBy("c").agg(F.max("s").alias("s"), F.min_by(F.struct("a", "b"), F.struct(-F.col("s"), "a", "b")).alias("p"))
        chosen = settled(best.groupBy("p.a", "p.b").agg(F.count("*").alias("k"), F.max("s").alias("s")).filter("k = 2").select("a", "b", "s"))
        if chosen.isEmpty():
            superseded(chosen)
            break
        if merges:
            joined_at.append(chosen.select(F.lit(round_).alias("round"), F.col("a").alias("cluster"), F.col("b").alias("merged"), F.col("s").alias("similarity")))
        into = chosen.select(F.col("b").alias("cluster"), F.col("a").alias("into"))
        if n_rows > frames.FEW_ROWS:
            rows = settled(place.join(into.select("cluster"), "cluster", "left_semi"))
            changed = _named(rows, into, "cluster", rows.count()).select("id", F.col("into").alias("cluster"))
            fresh = place.join(into.select("cluster"), "cluster", "left_anti").select("id", "cluster").unionByName(changed)
        else:
            fresh = place.join(into, "cluster", "left").select("id", F.coalesce("into", "cluster").alias("cluster"))
        last, place = place, settled(fresh)
        superseded(last)
        # new numbers and sizes of both ends; the pair that has become one cluster goes
        sizes = chosen.select("a", "b").join(_sizes(table), F.col("a") == F.col("c")).select("a", "b", F.col("n").alias("n_a")).join(_sizes(table), F.col("b") == F.col("c")).select("a", "b", (F.col("n_a") + F.col("n")).alias("n"))
        names = settled(sizes.select(F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("a").alias("to"), "n"), F.struct(F.col("b").alias("c"), F.col("a").alias("to"), "n"))).alias("r")).select("r.*"))
        rows = table
        for end, weight in (("a", "x"), ("b", "y")):
            hit = names.select(F.col("c").alias(end), F.col("to").alias("_to"), F.col("n").alias("_size"))
            if n <= frames.FEW_ROWS:
                rows = rows.join(hit, end, "left")
            else:
                touched = settled(rows.join(hit.select(end), end, "left_semi"))
                known = _named(touched, hit, end, n)
                bare = rows.join(hit.select(end), end, "left_anti").withColumns({"_to": F.lit(None).cast(dict(hit.dtypes)["_to"]), "_size": F.lit(None).cast("long")})
                rows = known.unionByName(bare.select(*known.columns))
            rows = rows.select(*(F.coalesce("_to", end).alias(c) if c == end else F.coalesce("_size", weight).alias(c) if c == weight else F.col(c) for c in ("a", "b", "t", "m", "x", "y")))
        turned = F.col("a") > F.col("b")
        rows = rows.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "t", "m", F.when(turned, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(turned, F.col("x")).otherwise(F.col("y")).alias("y"))
        total = {"average": F.sum, "single": F.max, "complete": F.min}[linkage]
        last, table = table, settled(rows.groupBy("a", "b").agg(total("t").alias("t"), F.sum("m").alias("m"), F.max("x").alias("x"), F.max("y").alias("y")))
        for done in (last, names) if merges else (last, names, chosen):
            superseded(done)
    if merges:
        empty = place.sparkSession.createDataFrame([], f"round int, cluster {dict(place.dtypes)['id']}, merged {dict(place.dtypes)['id']}, similarity double")
        for rows in joined_at:
            empty = empty.unionByName(rows)
        return empty
    return place


def _sizes(table: DataFrame) -> DataFrame:
    """(c, n): how many members each cluster of the table has."""
    ends = table.select(F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("x").alias("n")), F.struct(F.col("b").alias("c"), F.col("y").alias("n")))).alias("r"))
    return ends.select("r.*").groupBy("c").agg(F.max("n").alias("n"))
