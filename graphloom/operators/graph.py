"""Graph operators over edge tables (src, dst).

Undirected measures work on simple edges: each once, without loops. Iterations write each round to the shared folder.
"""

from __future__ import annotations

import heapq
import itertools
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.components import components
from graphloom.operators.frames import settled


def simple_edges(edges: DataFrame) -> DataFrame:
    """Undirected edges with src < dst, each once."""
    e = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return e.filter("src < dst").distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """Simple edges in both directions."""
    e = simple_edges(edges)
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """degree / (n - 1); n counts nodes with an edge."""
    d = degrees(edges)
    n = d.agg(F.count("*").alias("n"))
    return d.crossJoin(F.broadcast(n)).select("node", "degree", (F.col("degree") / F.greatest(F.col("n") - 1, F.lit(1))).alias("centrality"))


def directed_degrees(nodes: DataFrame, edges: DataFrame, direction: str = "both") -> DataFrame:
    """Degrees of all nodes(node), 0 for those without an edge; parallel edges count."""
    ends = {"out": ["src"], "in": ["dst"], "both": ["src", "dst"]}[direction]
    hit = edges.select(F.explode(F.array(*ends)).alias("node")).groupBy("node").agg(F.count("*").alias("d"))
    return nodes.join(hit, "node", "left").select("node", F.coalesce("d", F.lit(0)).alias("degree"))


def graph_metrics(edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, mean, largest and smallest degree."""
    g = degrees(edges).agg(F.count("*").alias("n_nodes"), (F.sum("degree") / 2).cast("long").alias("n_edges"), F.avg("degree").alias("mean_degree"), F.max("degree").alias("max_degree"), F.min("degree").alias("min_degree"))
    return g.withColumn("density", F.col("n_edges") / (F.col("n_nodes") * (F.col("n_nodes") - 1) / 2))


def structure_kind(metrics: DataFrame, n_components: Column) -> DataFrame:
    kind = F.when(n_components > 1, "disconnected").when(F.col("density") > 0.5, "dense").when(F.col("density") < 0.1, "sparse").otherwise("moderate")
    return metrics.withColumn("kind", kind)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge: component is the smallest node reachable, by alternating stars."""
    e = settled(simple_edges(edges))
    found = settled(components(e, "src", "dst").select(F.col("id").alias("node"), "component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def bfs(edges: DataFrame, sources: DataFrame, hops: int | None, directed: bool = False, keep: Column | None = None) -> DataFrame:
    """(source, node, distance) of every node within `hops` (None: any number) of each of sources(node), sources included at 0.

    keep: a condition on edges, such as their validity.
    """
    e = edges.filter(keep) if keep is not None else edges
    e = settled(e.select("src", "dst").distinct() if directed else both_ways(e))
    seen = settled(sources.select(F.col("node").alias("source"), "node", F.lit(0).alias("distance")).distinct())
    front = seen
    for d in itertools.count(1) if hops is None else range(1, hops + 1):
        step = front.join(e, front.node == e.src).select("source", F.col("dst").alias("node")).distinct()
        front = settled(step.join(seen, ["source", "node"], "left_anti").withColumn("distance", F.lit(d)))
        if not front.take(1):
            break
        seen = seen.unionByName(front)
    return seen


def neighbors(edges: DataFrame, node: object, hops: int = 1, directed: bool = True) -> DataFrame:
    """(node, hop) of nodes reached over outgoing edges, each once."""
    start = edges.sparkSession.createDataFrame([(node,)], f"node {dict(edges.dtypes)['src']}")
    return bfs(edges, start, hops, directed).filter("distance > 0").select("node", F.col("distance").alias("hop"))


def shortest_path(edges: DataFrame, source: object, target: object, hops: int = 10, directed: bool = False, keep: Column | None = None) -> DataFrame:
    """(path, distance): one shortest path, of equal ones the smallest by nodes; no row if none is short enough."""
    e = edges.filter(keep) if keep is not None else edges
    e = settled(e.select("src", "dst").distinct() if directed else both_ways(e))
    kind = dict(edges.dtypes)["src"]
    front = edges.sparkSession.createDataFrame([(source,)], f"node {kind}").select("node", F.array("node").alias("path"))
    seen = front.select("node")
    for _ in range(hops + 1):
        hit = front.filter(F.col("node") == F.lit(target))
        if hit.take(1):
            return hit.select("path", (F.size("path") - 1).alias("distance"))
        step = front.join(e, front.node == e.src).groupBy(F.col("dst").alias("node")).agg(F.min("path").alias("path"))
        front = settled(step.join(seen, "node", "left_anti").select("node", F.concat("path", F.array("node")).alias("path")))
        if not front.take(1):
            break
        seen = seen.unionByName(front.select("node"))
    return front.filter(F.lit(False)).select("path", F.lit(0).alias("distance"))


def temporal_paths(edges: DataFrame, source: object, target: object, start: str, end: str, hops: int = 5) -> DataFrame:
    """shortest_path along directed edges whose validity meets [start, end]; an open bound is null."""
    meets = (F.col("valid_from").isNull() | (F.col("valid_from") <= F.lit(end).cast("timestamp"))) & (F.col("valid_until").isNull() | (F.col("valid_until") >= F.lit(start).cast("timestamp")))
    return shortest_path(edges, source, target, hops, True, meets)


def _few_nodes(edges: DataFrame, most: int) -> DataFrame:
    """All nodes, for measures over all pairs; an error beyond `most`."""
    nodes = settled(degrees(edges).select("node"))
    if nodes.limit(most + 1).count() > most:
        raise ValueError(f"this measure compares all pairs of nodes and takes at most {most}")
    return nodes


def closeness(edges: DataFrame, hops: int | None = None, most: int = 50_000) -> DataFrame:
    """((r - 1) / sum of distances) * ((r - 1) / (n - 1)), r the nodes reached; all pairs, so the number of nodes is checked."""
    nodes = _few_nodes(edges, most)
    n = nodes.agg(F.count("*").alias("n"))
    d = bfs(edges, nodes, hops).groupBy(F.col("source").alias("node")).agg(F.count("*").alias("r"), F.sum("distance").alias("total"))
    return d.crossJoin(F.broadcast(n)).select("node", (((F.col("r") - 1) / F.col("total")) * ((F.col("r") - 1) / (F.col("n") - 1))).alias("closeness"))


def average_path_length(edges: DataFrame, hops: int | None = None, most: int = 50_000) -> DataFrame:
    """One row: the mean distance over connected ordered pairs, and how many there are; the number of nodes is checked."""
    d = bfs(edges, _few_nodes(edges, most), hops).filter("distance > 0")
    return d.agg(F.avg("distance").alias("mean_distance"), F.count("*").alias("n_pairs"))


def eigenvector(edges: DataFrame, rounds: int = 20) -> DataFrame:
    """Power iteration on A + I with L2 norm, a fixed number of rounds from equal weights."""
    e = settled(both_ways(edges))
    nodes = e.select(F.col("src").alias("node")).distinct()
    x = settled(nodes.withColumn("x", F.lit(1.0)))
    for _ in range(rounds):
        pulled = e.join(x, e.dst == x.node).groupBy("src").agg(F.sum("x").alias("s"))
        y = x.join(pulled, x.node == pulled.src, "left").select("node", (F.col("x") + F.coalesce("s", F.lit(0.0))).alias("y"))
        norm = y.agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("norm"))
        x = settled(y.crossJoin(F.broadcast(norm)).select("node", (F.col("y") / F.col("norm")).alias("x")))
    return x.withColumnRenamed("x", "centrality")


def label_propagation(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(node, community): each round a node takes the commonest label of its neighbours, the smallest on ties, keeping its own if that is among them."""
    e = settled(both_ways(edges))
    labels = settled(e.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node")))
    for i in range(rounds):
        votes = e.join(labels, e.dst == labels.node).groupBy("src", "community").agg(F.count("*").alias("v"))
        own = labels.select(F.col("node").alias("src"), F.col("community").alias("own"))
        ranked = votes.join(own, "src").withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("v"), F.col("community") != F.col("own"), "community")))
        fresh = settled(ranked.filter("r = 1").select(F.col("src").alias("node"), "community", "own"))
        changed = fresh.filter("community <> own").limit(1).count()
        labels = fresh.select("node", "community")
        if not changed:
            break
    return labels


def modularity(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """One row: Newman's modularity of (node, community), sum over communities of L/m - (d/2m)^2."""
    e = simple_edges(edges)
    a, b = (communities.select(F.col("node").alias(x), F.col("community").alias(f"c_{x}")) for x in ("src", "dst"))
    inner = e.join(a, "src").join(b, "dst").filter("c_src = c_dst").groupBy(F.col("c_src").alias("community")).agg(F.count("*").alias("l"))
    d = degrees(edges).join(communities, "node").groupBy("community").agg(F.sum("degree").alias("d"))
    m = e.agg(F.count("*").alias("m"))
    q = d.join(inner, "community", "left").crossJoin(F.broadcast(m))
    return q.agg(F.sum(F.coalesce("l", F.lit(0)) / F.col("m") - F.pow(F.col("d") / (2 * F.col("m")), 2)).alias("modularity"), F.count("*").alias("n_communities"))


def community_structure(edges: DataFrame, communities: DataFrame) -> DataFrame:
    """One row: edges within and between communities, each counted from both ends, and their ratio."""
    a, b = (communities.select(F.col("node").alias(x), F.col("community").alias(f"c_{x}")) for x in ("src", "dst"))
    e = both_ways(edges).join(a, "src").join(b, "dst")
    g = e.agg(F.count_if(F.expr("c_src = c_dst")).alias("intra"), F.count_if(F.expr("c_src <> c_dst")).alias("inter"))
    return g.withColumn("ratio", F.col("intra") / (F.col("inter") + 1))


def triangles(edges: DataFrame) -> DataFrame:
    """(a, b, c) with a < b < c. Edges point from the node of lower degree, which bounds what any node fans out to."""
    e, d = simple_edges(edges), degrees(edges)
    r = e.join(d.select(F.col("node").alias("src"), F.col("degree").alias("p")), "src").join(d.select(F.col("node").alias("dst"), F.col("degree").alias("q")), "dst")
    low = F.expr("p < q or (p = q and src < dst)")
    o = settled(r.select(F.when(low, F.col("src")).otherwise(F.col("dst")).alias("u"), F.when(low, F.col("dst")).otherwise(F.col("src")).alias("v")))
    x, y = o.alias("x"), o.alias("y")
    w = x.join(y, F.expr("x.u = y.u and x.v < y.v")).select(F.col("x.u").alias("n"), F.col("x.v").alias("src"), F.col("y.v").alias("dst"))
    return w.join(e, ["src", "dst"]).select(F.sort_array(F.array("n", "src", "dst")).alias("t")).select(F.col("t")[0].alias("a"), F.col("t")[1].alias("b"), F.col("t")[2].alias("c"))


def clique_communities(edges: DataFrame) -> DataFrame:
    """(community, node) by 3-clique percolation: triangles that share an edge belong together; community is its smallest triangle edge's key."""
    t = settled(triangles(edges))
    key = lambda x, y: F.concat_ws("-", F.col(x).cast("string"), F.col(y).cast("string"))
    links = t.select(key("a", "b").alias("e1"), key("a", "c").alias("e2"), key("b", "c").alias("e3"))
    pairs = links.select(F.col("e1").alias("src"), F.col("e2").alias("dst")).unionByName(links.select(F.col("e1").alias("src"), F.col("e3").alias("dst")))
    parts = connected_components(pairs)
    members = t.select(key("a", "b").alias("node"), F.explode(F.array("a", "b", "c")).alias("member"))
    return members.join(parts, "node").select(F.col("component").alias("community"), F.col("member").alias("node")).distinct()


def _adjacency(edges: DataFrame, most: int) -> dict:
    rows = simple_edges(edges).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"this measure runs on the driver and takes at most {most} edges")
    near = defaultdict(list)
    for a, b in rows:
        near[a].append(b)
        near[b].append(a)
    return near


def greedy_modularity(edges: DataFrame, most: int = 20_000) -> DataFrame:
    """(node, community) by merging the pair of communities that raises modularity most; on the driver, so the edge count is checked."""
    near = _adjacency(edges, most)
    m = sum(map(len, near.values())) / 2
    group = {n: n for n in near}
    links = {n: {x: 1 for x in near[n]} for n in near}
    degree = {n: len(near[n]) for n in near}
    heap = [(-(1 / m - degree[a] * degree[b] / (2 * m * m)), a, b) for a in near for b in near[a] if a < b]
    heapq.heapify(heap)
    while heap:
        gain, a, b = heapq.heappop(heap)
        if a not in links or b not in links or b not in links[a]:
            continue
        now = links[a][b] / m - degree[a] * degree[b] / (2 * m * m)
        if now <= 1e-12:
            continue
        if abs(now + gain) > 1e-12:
            heapq.heappush(heap, (-now, a, b))
            continue
        for x, k in links.pop(b).items():
            del links[x][b]
            if x != a:
                links[a][x] = links[x][a] = links[a].get(x, 0) + k
                heapq.heappush(heap, (-(links[a][x] / m - (degree[a] + degree[b]) * degree[x] / (2 * m * m)), min(a, x), max(a, x)))
        degree[a] += degree.pop(b)
        for n, g in group.items():
            if g == b:
                group[n] = a
    kind = dict(edges.dtypes)["src"]
    return edges.sparkSession.createDataFrame(sorted(group.items()), f"node {kind}, community {kind}")


# -- checks --------------------------------------------------------------------------------------


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that isn't among nodes(node)."""
    src, dst = nodes.select(F.col("node").alias("src")).distinct(), nodes.select(F.col("node").alias("dst")).distinct()
    return edges.join(src, "src", "left_anti").unionByName(edges.join(src, "src", "left_semi").join(dst, "dst", "left_anti"))


def orphan_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return nodes.join(ends, "node", "left_anti")


def validation_issues(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(issue, n): missing ids, repeated ids, dangling edges, self-loops, orphans; only those that occur."""
    rows = [
        ("missing_id", nodes.filter("node is null")),
        ("duplicate_id", nodes.filter("node is not null").groupBy("node").count().filter("count > 1")),
        ("dangling_edge", dangling_edges(edges, nodes.filter("node is not null"))),
        ("self_loop", edges.filter("src = dst")),
        ("orphan_node", orphan_nodes(edges, nodes.filter("node is not null"))),
    ]
    out = None
    for name, df in rows:
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("issue"), "n")
        out = one if out is None else out.unionByName(one)
    return out.filter("n > 0")


def network_kind(edges: DataFrame) -> DataFrame:
    """One row: mean degree over both ends of parallel edges, and sparse < 2, moderate < 5, dense."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("d"))
    return ends.agg(F.avg("d").alias("mean_degree")).withColumn("kind", F.when(F.col("mean_degree") < 2, "sparse").when(F.col("mean_degree") < 5, "moderate").otherwise("dense"))


def type_counts(rows: DataFrame, kind: str) -> DataFrame:
    return rows.groupBy(F.col(kind).alias("type")).agg(F.count("*").alias("n"))
