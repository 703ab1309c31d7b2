"""Communities of large graphs: rounds of local moves that raise modularity, then the same on the contracted graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import frames
from graphloom.operators.components import components
from graphloom.operators.frames import settled, skew_join, superseded
from graphloom.operators.graph import simple_edges


def _weighted(edges: DataFrame, weight: str | None) -> DataFrame:
    """(src, dst, w) in both directions, src <> dst; parallel edges are added up, or count once without a weight."""
    if weight is None:
        e = simple_edges(edges).withColumn("w", F.lit(1.0))
    else:
        e = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), F.col(weight).cast("double").alias("w"))
        e = e.filter("src < dst and w > 0").groupBy("src", "dst").agg(F.sum("w").alias("w"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


def _kept(df: DataFrame, rows: int) -> DataFrame:
    """df, written once where it is large; small tables are computed anew faster than they are written."""
    return settled(df) if rows > frames.FEW_ROWS else df


def _known(rows: DataFrame, table: DataFrame, key: str, n: int) -> DataFrame:
    """rows joined with a table of unique keys, of which any may have a large share of the n rows."""
    if n <= frames.FEW_ROWS:
        return rows.join(table, key)
    return skew_join(rows, rows.groupBy(key).agg(F.count("*").alias("_n")).join(table, key), [key], "_n", n).drop("_n")


def _ends(state: DataFrame, node: str, community: str) -> DataFrame:
    """What an edge's end joins with: its community, and how many rows the end has, so that a hot one is known."""
    return state.select(F.col("node").alias(node), F.col("community").alias(community), F.col("n").alias("_n"))


def _links(e: DataFrame, state: DataFrame, n_edges: int) -> DataFrame:
    """(src, own, k, to, w): each node's community and weighted degree, and its weight to each community around it, loops left out."""
    links = skew_join(e.filter("src <> dst"), _ends(state, "dst", "to"), ["dst"], "_n", n_edges)
    links = links.groupBy("src", "to").agg(F.sum("w").alias("w"))
    return settled(links.join(state.select(F.col("node").alias("src"), F.col("community").alias("own"), "k"), "src"))


def _totals(state: DataFrame) -> DataFrame:
    return state.groupBy("community").agg(F.sum("k").alias("t"))


def _quality(links: DataFrame, state: DataFrame, loops: float, twice: float, resolution: float) -> tuple[float, int]:
    """The modularity of the state that links are of, and how many rows these are; loops: the weight of the edges from a node to itself."""
    inner = links.agg(F.coalesce(F.sum(F.when(F.col("to") == F.col("own"), F.col("w"))), F.lit(0.0)).alias("inner"), F.count("*").alias("n"))
    spread = _totals(state).agg(F.sum(F.col("t") * F.col("t")).alias("spread"))
    row = inner.crossJoin(F.broadcast(spread)).first()
    return (row["inner"] + loops) / twice - resolution * row["spread"] / twice**2, row["n"]


def _moved(links: DataFrame, state: DataFrame, n_links: int, twice: float, resolution: float, turn: int) -> DataFrame | None:
    """state after a round in which nodes move to the community around them that gains most; None if no node gains by moving.

    A community either takes or gives in a round, by whether its best arrival gains more than its best departure, so none
    that takes loses members meanwhile, and nodes don't swap places. The best move of all is always made.
    """
    totals = _kept(_totals(state), n_links)
    away = _known(links.filter("to <> own"), totals.select(F.col("community").alias("to"), "t"), "to", n_links)
    away = _known(_kept(away, n_links), totals.select(F.col("community").alias("own"), F.col("t").alias("t_own")), "own", n_links)
    away = away.join(links.filter("to = own").select("src", F.col("w").alias("w_own")), "src", "left")
    gain = F.col("w") - resolution * F.col("k") * F.col("t") / twice
    keep = F.coalesce("w_own", F.lit(0.0)) - resolution * F.col("k") * (F.col("t_own") - F.col("k")) / twice
    away = away.withColumn("gain", gain - keep).filter("gain > 1e-9")
    best = away.groupBy("src", "own").agg(F.max(F.struct("gain", F.xxhash64("src", "to", F.lit(turn)).alias("h"), "to")).alias("m"))
    best = settled(best.select("src", "own", "m.to", F.struct("m.gain", "m.h", "src").alias("rank")))
    if best.isEmpty():
        superseded(best)
        return None
    arrivals = best.groupBy(F.col("to").alias("c")).agg(F.max("rank").alias("arrival"))
    departures = best.groupBy(F.col("own").alias("c")).agg(F.max("rank").alias("departure"))
    takers = arrivals.join(departures, "c", "left").filter("departure is null or arrival > departure").select("c")
    takers = _kept(takers, n_links)
    moves = _known(best, takers.select(F.col("c").alias("to")), "to", n_links)
    # whoever belongs to a taker stays
    if n_links > frames.FEW_ROWS:
        moves = settled(moves)
        staying = _known(moves, takers.select(F.col("c").alias("own")), "own", n_links).select("src")
        moves = moves.join(staying, "src", "left_anti")
    else:
        moves = moves.join(takers.select(F.col("c").alias("own")), "own", "left_anti")
    fresh = state.join(moves.select(F.col("src").alias("node"), "to"), "node", "left")
    fresh = settled(fresh.select("node", F.coalesce("to", "community").alias("community"), "k", "n"))
    superseded(best)
    return fresh


def _between(e: DataFrame, state: DataFrame, n_edges: int) -> DataFrame:
    """(src, dst, c_src, c_dst, w): edges with the communities of both ends."""
    named = _kept(skew_join(e, _ends(state, "dst", "c_dst"), ["dst"], "_n", n_edges).select("src", "dst", "c_dst", "w"), n_edges)
    return skew_join(named, _ends(state, "src", "c_src"), ["src"], "_n", n_edges)


def _connected(e: DataFrame, state: DataFrame, n_edges: int) -> DataFrame:
    """state with each community cut into its connected parts, named by their smallest nodes."""
    parts = components(_between(e, state, n_edges).filter("c_src = c_dst and src < dst"), "src", "dst").select(F.col("id").alias("node"), "component")
    return state.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("community"), "k", "n")


def _best_state(e: DataFrame, state: DataFrame, n_edges: int, loops: float, twice: float, resolution: float, rounds: int, tolerance: float, turn: int) -> tuple[DataFrame, float, float]:
    """The best state that rounds from `state` on reach, its modularity, and that of `state`."""
    best, current, idle, start, top = state, state, 0, None, float("-inf")
    for i in range(rounds + 1):
        links = _links(e, current, n_edges)
        now, n_links = _quality(links, current, loops, twice, resolution)
        if start is None:
            start = top = now
        elif now > top:
            idle = idle + 1 if now < top + tolerance else 0
            superseded(best)
            best, top = current, now
        else:
            idle += 1
        if idle >= 2 or i == rounds:
            superseded(links)
            break
        last, fresh = current, _moved(links, current, n_links, twice, resolution, turn + i)
        superseded(links)
        if fresh is None:
            break
        current = fresh
        if last is not best:
            superseded(last)
    return best, top, start


def louvain(
    edges: DataFrame,
    weight: str | None = None,
    resolution: float = 1.0,
    levels: int = 10,
    rounds: int = 12,
    cycles: int = 2,
    tolerance: float = 1e-3,
    connected: bool = False,
) -> DataFrame:
    """(node, community) of all nodes with an edge, by rounds of local moves and contraction; community is one of its nodes, the smallest.

    On each level, rounds go on until no node gains by moving, modularity has not risen by `tolerance` in two of them running, or for
    `rounds`; the best state of the level counts. Communities then become the nodes of the next level, with the
    weights between and within them added up, until a level gains less than `tolerance`. A further cycle starts from the nodes again, with the
    communities found, as long as that gains. With `connected`, communities are cut into their connected parts at last, so that each is connected.

    Loops don't count; parallel edges count once, or with `weight` as much as all together. A graph without edges gives no rows.
    No step gathers a node's or a community's rows in one task.
    """
    plain = settled(_weighted(edges, weight))
    twice = plain.agg(F.sum("w")).first()[0]
    if not twice:
        return plain.select(F.col("src").alias("node"), F.col("src").alias("community"))
    size = plain.count()
    nodes = settled(plain.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"), F.count("*").alias("n")))
    n_nodes = nodes.count()
    placed, quality, turn = settled(nodes.select("node", F.col("node").alias("community"))), float("-inf"), 0
    for _ in range(cycles):
        begun, e = quality, plain
        for level in range(levels):
            sums = e.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("src") == F.col("dst"), F.col("w"))), F.lit(0.0)).alias("loops")).first()
            n_edges, loops = sums["n"], sums["loops"]
            if level:
                state = settled(e.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"), F.count("*").alias("n")).select("node", F.col("node").alias("community"), "k", "n"))
            else:
                state = settled(nodes.join(placed, "node").select("node", "community", "k", "n"))
            best, top, start = _best_state(e, state, n_edges, loops, twice, resolution, rounds, tolerance, turn)
            turn += rounds
            if level and top < max(quality, start) + tolerance:
                break
            quality = max(quality, top)
            least = best.groupBy("community").agg(F.min("node").alias("least"))
            groups = settled(_known(best, least, "community", n_nodes).select("node", F.col("least").alias("community"), "n"))
            superseded(best)
            if level:
                last, into = placed, groups.select(F.col("node").alias("community"), F.col("community").alias("into"))
                placed = settled(_known(placed, into, "community", n_nodes).select("node", F.col("into").alias("community")))
                superseded(last)
            else:
                superseded(placed)
                placed = groups.select("node", "community")
            named = _between(e, groups, n_edges)
            last, e = e, settled(named.groupBy(F.col("c_src").alias("src"), F.col("c_dst").alias("dst")).agg(F.sum("w").alias("w")))
            if last is not plain:
                superseded(last)
            if groups.filter("node <> community").isEmpty():
                break
        if quality < begun + tolerance:
            break
    if not connected:
        return placed
    state = settled(nodes.join(placed, "node").select("node", "community", "k", "n"))
    return _connected(plain, state, size).select("node", "community")
