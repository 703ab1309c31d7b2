"""Methods by task and name: registered ones first, built-in ones second."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from graphloom.functions import similarity
from graphloom.operators import chunking, communities, conflicts, dedup, graph, linkage, measures

_METHODS: dict[str, dict[str, Callable]] = defaultdict(dict)

BUILT_IN: dict[str, dict[str, Callable]] = {
    "split": chunking.METHODS,
    "conflicts": conflicts.RESOLVERS,
    "similarity": {"jaro_winkler": similarity.jaro_winkler, "levenshtein": similarity.levenshtein, "cosine": similarity.bigram_jaccard, "jaccard": similarity.word_jaccard},
    "deduplication": {"pairs": dedup.candidate_pairs, "incremental": dedup.incremental_pairs, "leader": dedup.leader_clusters, "agglomerative": dedup.agglomerative, "linkage": linkage.linkage_clusters},
    "centrality": {"degree": graph.degree_centrality, "closeness": graph.closeness, "eigenvector": graph.eigenvector, "betweenness": measures.betweenness},
    "community": {"louvain": communities.louvain, "label_propagation": graph.label_propagation, "greedy_modularity": graph.greedy_modularity, "k_clique": graph.clique_communities},
}


def register(task: str, name: str, method: Callable) -> None:
    _METHODS[task][name] = method


def unregister(task: str, name: str) -> None:
    _METHODS[task].pop(name, None)


def clear(task: str | None = None) -> None:
    _METHODS.clear() if task is None else _METHODS.pop(task, None)


def get(task: str, name: str) -> Callable:
    found = _METHODS[task].get(name) or BUILT_IN.get(task, {}).get(name)
    if found is None:
        raise KeyError(f"no method {name!r} for {task!r}; there are {list_all(task)}")
    return found


def list_all(task: str) -> list[str]:
    return sorted({*_METHODS[task], *BUILT_IN.get(task, {})})
