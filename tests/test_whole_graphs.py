"""Whole-graph measures, communities, hierarchical clustering and vector indexes against plain versions of them."""

import itertools
import random
from collections import defaultdict, deque

import numpy as np
import pytest

from graphloom.operators import communities as LC
from graphloom.operators import frames
from graphloom.operators import graph as G
from graphloom.operators import indexes as IX
from graphloom.operators import measures as M
from graphloom.operators.linkage import linkage_clusters


def edge_table(spark, pairs):
    return spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, w int")


def near_of(pairs):
    near = defaultdict(set)
    for a, b in pairs:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return near


def plain_betweenness(pairs):
    """By counting shortest paths between all pairs."""
    near = near_of(pairs)
    far, many = {}, {}
    for s in near:
        far[s], many[s], queue = {s: 0}, defaultdict(int, {s: 1}), deque([s])
        while queue:
            v = queue.popleft()
            for w in near[v]:
                if w not in far[s]:
                    far[s][w] = far[s][v] + 1
                    queue.append(w)
                if far[s][w] == far[s][v] + 1:
                    many[s][w] += many[s][v]
    out, n = dict.fromkeys(near, 0.0), len(near)
    for s, t in itertools.combinations(near, 2):
        for v in near:
            if v not in (s, t) and t in far[s] and v in far[s] and far[s][v] + far[v].get(t, 10**9) == far[s][t]:
                out[v] += many[s][v] * many[v][t] / many[s][t]
    return {v: x / ((n - 1) * (n - 2) / 2) if n > 2 else 0.0 for v, x in out.items()}


def plain_bridges(pairs):
    """By taking each edge away and looking whether its ends still reach each other."""
    near = near_of(pairs)
    out = set()
    for a in near:
        for b in near[a]:
            seen, queue = {a}, [a]
            while queue:
                v = queue.pop()
                for w in near[v] - seen:
                    if {v, w} != {a, b}:
                        seen.add(w)
                        queue.append(w)
            if b not in seen:
                out.add((min(a, b), max(a, b)))
    return out


def graphs():
    rng = random.Random(7)
    sparse = [(rng.randrange(50), rng.randrange(50)) for _ in range(60)]
    chain = [(i, i + 1) for i in range(40)] + [(40, 35), (100, 101), (101, 102), (102, 100), (102, 103)]
    star = [(0, i) for i in range(1, 30)] + [(0, 1), (5, 6)]
    return {"sparse": sparse, "chain": chain, "star": star, "one edge": [(1, 2)], "loops only": [(3, 3)], "nothing": []}


@pytest.mark.parametrize("name", graphs())
def test_bridges_split_components(spark, name):
    pairs = graphs()[name]
    assert {tuple(r) for r in M.bridges(edge_table(spark, pairs).select("src", "dst")).collect()} == plain_bridges(pairs)


def test_bridges_where_keys_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(frames, "FEW_ROWS", 0)
    pairs = graphs()["star"]
    assert {tuple(r) for r in M.bridges(edge_table(spark, pairs)).collect()} == plain_bridges(pairs)


@pytest.mark.parametrize("name, batch", [("sparse", 4096), ("sparse", 20), ("star", 4096), ("one edge", 4096), ("loops only", 4096), ("nothing", 4096)])
def test_betweenness_counts_shortest_paths(spark, name, batch):
    pairs = graphs()[name]
    got = {r["node"]: r["betweenness"] for r in M.betweenness(edge_table(spark, pairs), batch).collect()}
    want = plain_betweenness(pairs)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_betweenness_from_some_sources_is_scaled_up(spark):
    pairs = graphs()["star"]
    some = spark.createDataFrame([(i,) for i in range(1, 30)], "node long")
    got = {r["node"]: r["betweenness"] for r in M.betweenness(edge_table(spark, pairs), sources=some).collect()}
    assert abs(got[0] - plain_betweenness(pairs)[0] * 30 / 29) < 1e-9


def test_louvain_finds_planted_communities(spark):
    rng = random.Random(3)
    pairs = [(i, j) for i in range(90) for j in range(i + 1, 90) if rng.random() < (0.5 if i // 15 == j // 15 else 0.02)]
    e = edge_table(spark, pairs)
    got = LC.louvain(e, connected=True).cache()
    groups = defaultdict(set)
    for r in got.collect():
        groups[r["community"]].add(r["node"])
    assert {frozenset(g) for g in groups.values()} == {frozenset(range(i, i + 15)) for i in range(0, 90, 15)}
    assert all(c == min(g) for c, g in groups.items())


@pytest.mark.parametrize("few", [400_000, 0])
def test_louvain_is_as_good_as_greedy_merging(spark, monkeypatch, few):
    monkeypatch.setattr(frames, "FEW_ROWS", few)
    rng = random.Random(1)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(75)] if few else graphs()["star"]
    e = edge_table(spark, pairs)
    found = LC.louvain(e).cache()
    assert found.count() == found.select("node").distinct().count() == G.degrees(e).count()
    assert G.modularity(e, found).first()[0] >= G.modularity(e, G.greedy_modularity(e)).first()[0] - 1e-9


def test_louvain_of_little_and_weighted(spark):
    assert LC.louvain(edge_table(spark, [])).count() == 0
    assert LC.louvain(edge_table(spark, [(1, 1)])).count() == 0
    assert {tuple(r) for r in LC.louvain(edge_table(spark, [(1, 2)])).collect()} == {(1, 1), (2, 1)}
    heavy = spark.createDataFrame([(1, 2, 9.0), (2, 3, 0.1), (3, 4, 9.0), (4, 1, 0.1), (1, 3, 0.1), (2, 4, 0.1)], "src long, dst long, w double")
    got = {r["node"]: r["community"] for r in LC.louvain(heavy, "w").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}


def plain_linkage(pairs, ids, threshold, linkage):
    """One merge at a time, of the most similar pair, of equal ones that with the smallest ids."""
    sim = defaultdict(float)
    for a, b, s in pairs:
        if a != b:
            sim[min(a, b), max(a, b)] = max(s, sim[min(a, b), max(a, b)])
    groups = {i: [i] for i in ids}
    how = {"average": lambda v: sum(v) / len(v), "single": max, "complete": min}[linkage]
    while True:
        scored = [(-how([sim.get((min(x, y), max(x, y)), 0.0) for x in groups[a] for y in groups[b]]), a, b) for a, b in itertools.combinations(sorted(groups), 2)]
        best = min(scored, default=(0, 0, 0))
        if -best[0] < threshold:
            return {x: a for a, g in groups.items() for x in g}
        groups[best[1]] += groups.pop(best[2])


@pytest.mark.parametrize("linkage, few", [("average", 400_000), ("complete", 400_000), ("single", 400_000), ("average", 0), ("complete", 0)])
def test_linkage_clusters_are_those_of_one_merge_at_a_time(spark, monkeypatch, linkage, few):
    monkeypatch.setattr(frames, "FEW_ROWS", few)
    rng = random.Random(11)
    ids = list(range(32))
    pairs = [(b, a, round(rng.random(), 4)) for a in ids for b in ids if a < b and (rng.random() < 0.25 or a // 5 == b // 5)]
    extra = [*pairs[:5], (1, 1, 0.9), (3, 999, 0.9), (None, 4, 0.9)]
    df = spark.createDataFrame(pairs + extra, "a long, b long, similarity double")
    nodes = spark.createDataFrame([(i, "x") for i in ids] + [(None, "x"), (4, "y")], "id long, cluster string")
    got = {r["id"]: r["cluster"] for r in linkage_clusters(df, nodes, 0.4, linkage).collect()}
    assert got == plain_linkage(pairs, ids, 0.4, linkage)


def test_linkage_merges_and_little(spark):
    df = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.5), (1, 3, 0.5), (4, 5, 0.8)], "a long, b long, similarity double")
    nodes = spark.createDataFrame([(i,) for i in range(1, 7)], "id long")
    rows = sorted(tuple(r) for r in linkage_clusters(df, nodes, 0.4, merges=True).collect())
    assert [(r, c, m) for r, c, m, _ in rows] == [(1, 1, 2), (1, 4, 5), (2, 1, 3)] and [s for *_, s in rows] == [0.9, 0.8, 0.5]
    assert {r["cluster"] for r in linkage_clusters(df.limit(0), nodes, 0.4).collect()} == set(range(1, 7))
    assert linkage_clusters(df, nodes.limit(0), 0.4).count() == 0
    with pytest.raises(ValueError, match="threshold"):
        linkage_clusters(df, nodes, 0.0)
    with pytest.raises(ValueError, match="linkage"):
        linkage_clusters(df, nodes, 0.5, "ward")


# -- vector indexes ----------------------------------------------------------------------------


def clustered(n=3000, d=16, groups=40, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d)) * 3
    x = centres[rng.integers(groups, size=n)] + rng.normal(size=(n, d)) * 0.6
    rows = [(i, [float(y) for y in v]) for i, v in enumerate(x)]
    return rows + [(n + i, rows[0][1]) for i in range(n // 3)]  # a quarter of all rows share a vector


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cell int, v int")


def plain_search(rows, queries, k, metric):
    x, ids = np.array([v for _, v in rows], np.float32).astype(float), np.array([i for i, _ in rows])
    out = {}
    for q, v in queries:
        y = np.array(v, np.float32).astype(float)
        score = -(x * y).sum(1) if metric == "inner_product" else np.sqrt(((x - y) ** 2).sum(1))
        out[q] = [int(ids[j]) for j in np.lexsort((ids, score))[:k]]
    return out


def hits(found):
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append(r["id"])
    return got


@pytest.mark.parametrize("metric", IX.METRICS)
def test_indexes_find_what_a_scan_finds(spark, monkeypatch, metric):
    monkeypatch.setattr(IX, "PART_ROWS", 300)
    monkeypatch.setattr(IX, "PART_QUERIES", 20)
    rows = clustered()
    odd = [(90_001, None), (90_002, []), (90_003, [1.0]), (90_004, [float("nan")] * 16), (None, rows[1][1]), (90_005, [None] * 16)]
    df, queries = vector_table(spark, rows + odd), [r for r in rows if r[0] % 60 == 0 and r[0] < 3000]
    asked, want = vector_table(spark, queries + odd[:4]), plain_search(rows, queries, 10, metric)
    for kind in ("flat", "ivf"):  # all cells: nothing is missed
        index = IX.build_index(df, "vec_id", "embedding", kind, metric, cells=30)
        assert hits(index.search(asked, 10, "vec_id", "embedding")) == want
        assert index.rows.count() == len(rows)
        assert index.cells().filter("n > 300 and parts < 2").count() == 0
    for kind, probes in (("ivf", 4), ("ivfpq", 4), ("pq", 1)):
        index = IX.build_index(df, "vec_id", "embedding", kind, metric, cells=30, parts=4, bits=6)
        got = hits(index.search(asked, 10, "vec_id", "embedding", probes, rerank=20))
        # by score, as the last of ten may be one of many equal rows
        x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
        near = (lambda q, i: x[q] @ x[i]) if metric == "inner_product" else (lambda q, i: -np.sqrt(((x[q] - x[i]) ** 2).sum()))
        recall = np.mean([sum(near(q, i) >= near(q, want[q][-1]) - 1e-9 for i in got[q]) / 10 for q in want])
        assert recall >= 0.9, (kind, recall)
        if kind != "pq":
            assert index.scanned_share(asked.filter("size(embedding) = 16 and not isnan(embedding[0])"), "vec_id", "embedding", probes) < 0.5


def test_recall_on_the_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet".replace("sf0.001", "sf0.1"))
    asked = df.filter("vec_id % 50 = 0")
    want = hits(IX.build_index(df, "vec_id", "embedding", "flat").search(asked, 10, "vec_id", "embedding"))
    for kind, probes in (("ivf", 50), ("ivfpq", 60)):
        index = IX.build_index(df, "vec_id", "embedding", kind)
        got = hits(index.search(asked, 10, "vec_id", "embedding", probes, rerank=40))
        assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
        assert index.scanned_share(asked, "vec_id", "embedding", probes) < probes / 100 + 0.1


def test_indexes_grow_shrink_and_are_kept(spark, tmp_path):
    rows = clustered(400)
    df = vector_table(spark, rows)
    index = IX.build_index(df, "vec_id", "embedding", "ivfpq", cells=8, parts=4, bits=5)
    more = index.add(vector_table(spark, [(5, rows[9][1]), (7000, rows[5][1])]), "vec_id", "embedding")
    assert more.rows.count() == len(rows) + 1
    less = more.remove(df.filter("vec_id < 100"), "vec_id")
    now = [r for r in rows if r[0] >= 100] + [(7000, rows[5][1])]
    less.save(str(tmp_path / "index"))
    again = IX.VectorIndex.load(spark, str(tmp_path / "index"))
    queries = [r for r in now if r[0] % 40 == 0]
    got = hits(again.search(vector_table(spark, queries), 5, "vec_id", "embedding", rerank=200))
    assert got == plain_search(now, queries, 5, "l2")
    empty = IX.build_index(df.limit(0), "vec_id", "embedding", "ivfpq")
    assert empty.search(df, 5, "vec_id", "embedding").count() == 0 == empty.rows.count()
    with pytest.raises(ValueError, match="kind"):
        IX.build_index(df, "vec_id", "embedding", "hnsw")
