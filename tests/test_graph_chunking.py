"""Chunks by graph and ontology on small texts, with a plain version of the propagation."""

import re
from collections import Counter

import pytest
from conftest import DATA

from graphloom.operators import graph_chunking as GC


def texts(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, at int, label string")


def plain_communities(sentences, rounds=3):


    own = [sorted({e.lower() for e in re.findall(GC.ENTITY, s)}) for s in sentences]
    label = {i: i for i, e in enumerate(own) if e}
    for _ in range(rounds):
        votes = {}
        for i, names in enumerate(own):
            for e in names:
                votes.setdefault(e, Counter())[label[i]] += 1
        named = {e: min(c, key=lambda x: (-c[x], x)) for e, c in votes.items()}
        label = {i: min(c := Counter(named[e] for e in own[i]), key=lambda x: (-c[x], x)) for i in label}
    out, last = [], -1
    for i in range(len(sentences)):
        last = label.get(i, last)
        out.append(last)
    return out


DOCS = [
    (1, "Alice met Bob. then it rained. Carol saw Dave. Bob left with Alice. Dave phoned Carol! nobody else. Eve and Alice and Bob talked."),
    (2, None),
    (3, ""),
    (4, "no names at all. none here either."),
    (5, "Solo."),
    (6, "First thing. Other thing. First again. plain."),
    (None, "Nameless Document here. Nameless again."),
]


def test_communities_are_those_of_the_plain_rounds(spark):
    got = GC.by_graph(texts(spark, DOCS), "doc_id", "text").collect()
    for i, text in DOCS:
        if i is None or not text:
            assert i is None or not [r for r in got if r["doc_id"] == i]
            continue
        parts = re.split(r"(?<=[.!?])\s+", text)
        label = plain_communities(parts)
        groups = {}
        for s, c in zip(parts, label):
            groups.setdefault(c, []).append(s)
        want = [(n, len(g), " ".join(g)) for n, g in enumerate(groups.values())]
        assert sorted((r["chunk_index"], r["n_parts"], r["text"]) for r in got if r["doc_id"] == i) == want
    both = sorted(r["text"] for r in got if r["doc_id"] == 1)
    assert both == ["Alice met Bob. then it rained. Bob left with Alice. Eve and Alice and Bob talked.", "Carol saw Dave. Dave phoned Carol! nobody else."]


def test_hubs_and_strategies(spark):
    got = {(r["doc_id"], r["chunk_index"]): r["text"] for r in GC.by_graph(texts(spark, DOCS), "doc_id", "text", "centrality", hubs=1).collect()}
    assert got[1, 0].startswith("Alice met Bob. then it rained. Carol saw Dave.") and got[6, 0] == "First thing. Other thing. First again. plain."
    assert GC.by_graph(texts(spark, []), "doc_id", "text").count() == 0
    with pytest.raises(ValueError, match="strategy"):
        GC.by_graph(texts(spark, DOCS), "doc_id", "text", "luck")


def test_every_sentence_is_in_one_chunk(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    n = GC.sentence_table(docs, "doc_id", "text").count()
    for strategy in ("community", "centrality"):
        assert GC.by_graph(docs, "doc_id", "text", strategy).agg({"n_parts": "sum"}).first()[0] == n


def test_ontology_chunks_end_where_the_common_class_changes(spark):
    terms = {"dog": "Dog", "cat": "Cat", "oak": "Tree", "car": "Car"}
    above = [("Dog", "Pet"), ("Cat", "Pet"), ("Pet", "Animal"), ("Animal", "Living"), ("Tree", "Plant"), ("Plant", "Living"), ("Living", "Animal")]  # with a cycle
    rows = [
        (1, "Nothing yet. A dog ran. The dog and a cat. Some rest. The CAT, a dog. An oak. A car and an oak. A car."),
        (2, "Only words."),
        (3, None),
        (4, ""),
    ]
    got = sorted((r["doc_id"], r["chunk_index"], r["concept"], r["n_parts"]) for r in GC.by_ontology(texts(spark, rows), "doc_id", "text", terms, above).collect() if r["concept"])
    # a car and an oak have no class in common, so that sentence goes on
    assert got == [(1, 1, "Dog", 1), (1, 2, "Pet", 3), (1, 3, "Tree", 2), (1, 4, "Car", 1)]
    bare = GC.by_ontology(texts(spark, rows[1:]), "doc_id", "text", terms, above)
    assert [(r["doc_id"], r["chunk_index"], r["concept"], r["n_parts"]) for r in bare.collect()] == [(2, 0, None, 1)]
