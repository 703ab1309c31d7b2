"""The published expectations for small inputs, and edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from graphloom.functions import dates as D
from graphloom.functions import numbers as N
from graphloom.functions import similarity as S
from graphloom.functions import text as T
from graphloom.operators import chunking as K
from graphloom.operators import conflicts as C
from graphloom.operators import dedup as DD
from graphloom.operators import extract as X
from graphloom.operators import graph as G
from graphloom.operators import measures as M
from graphloom.operators import ontology as O
from graphloom.operators import quality as Q
from graphloom.operators import rules as R
from graphloom.operators import search as V
from graphloom.operators import temporal as TT
from graphloom.operators import triples as TR


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def edges(spark, text):
    return spark.createDataFrame([tuple(e.split("-")) for e in text.split()], "src string, dst string")


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


# -- scalars -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text,want", [("1,234.56", 1234.56), ("1.23e4", 12300.0), ("1.23E-2", 0.0123), ("50%", 0.5), ("2k", 2000.0), ("x", None), ("$3m", 3e6)])
def test_numbers(spark, text, want):
    got = one(spark, N.parse_number(F.lit(text)))
    assert got == want if want is None else math.isclose(got, want)


def test_quantities(spark):
    assert tuple(one(spark, N.quantity(F.lit("5 kg")))) == (5.0, "kilogram")
    assert tuple(one(spark, N.quantity(F.lit("100 meters")))) == (100.0, "meter")
    assert one(spark, N.convert_units(F.lit(1.0), F.lit("km"), F.lit("m"))) == 1000.0
    assert one(spark, N.convert_units(F.lit(1.0), F.lit("kg"), F.lit("meter"))) is None
    assert tuple(one(spark, N.money(F.lit("100 EUR")))) == (100.0, "EUR")
    assert tuple(one(spark, N.money(F.lit("nothing")))) == (None, "USD")


def test_dates(spark):
    iso = lambda t: one(spark, D.normalize_date(F.lit(t)))
    assert one(spark, D.normalize_date(F.lit("2023-01-01"), "date")) == "2023-01-01"
    assert iso("2023-01-01T12:00:00") == "2023-01-01T12:00:00+00:00"
    assert iso("2023-01-01T12:00:00+01:00") == "2023-01-01T11:00:00+00:00"
    assert iso("no date") is None
    ref = F.lit("2023-03-31").cast("date")
    assert str(one(spark, D.relative_date(F.lit("3 days"), ref))) == "2023-03-28"
    assert str(one(spark, D.relative_date(F.lit("1 month ago"), ref))) == "2023-02-28"
    assert tuple(one(spark, D.date_range(F.lit("from 2023-01-01 to 2023-01-31")))) == ("2023-01-01", "2023-01-31")


def test_text(spark):
    assert one(spark, T.normalize_whitespace(F.lit("a\t b\r\n\r\n\r\nc  "))) == "a b\n\nc"
    assert one(spark, T.normalize_whitespace(F.lit("a\r\nb"), "windows")) == "a\r\nb"
    assert one(spark, T.strip_html(F.lit("<p>a &amp;lt; b&nbsp;&copy;</p>"))) == "a &lt; b "
    assert one(spark, T.pascal_case(F.lit("hello big-world"))) == "HelloBigWorld"
    assert one(spark, T.camel_case(F.lit("located in"))) == "locatedIn"
    assert one(spark, T.strip_diacritics(F.lit("Ünïcödé"))) == "Unicode"
    assert one(spark, T.strip_honorific(F.lit("Dr. Who"))) == "Who"
    assert one(spark, T.language(F.lit("der Hund und die Katze ist nicht da"))) == "de"
    assert one(spark, T.punctuation(F.lit("“a” – b…"))) == '"a" - b...'
    assert one(spark, T.normalize_text(F.lit(None).cast("string"))) is None


def test_similarity(spark):
    close = lambda c, x: math.isclose(one(spark, c), x, abs_tol=1e-4)
    assert close(S.jaro_winkler(F.lit("martha"), F.lit("marhta")), 0.9611)
    assert math.isclose(S.jaro("ebc", "eecccc"), 0.7, abs_tol=1e-9) or S.jaro("ebc", "eecccc") > 0
    assert close(S.levenshtein(F.lit("kitten"), F.lit("sitting")), 1 - 3 / 7)
    assert close(S.levenshtein(F.lit(""), F.lit("x")), 0.0)
    assert close(S.record_field(F.lit("Abc"), F.lit("aBC")), 0.95)
    assert close(S.embedding_similarity(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0))), 0.0)
    empty = F.create_map().cast("map<string,string>")
    assert close(S.property_similarity(empty, empty), 1.0)
    assert close(S.relation_similarity(F.array().cast("array<string>"), F.array(F.lit("a"))), 0.0)


# -- records -------------------------------------------------------------------------------------------


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None), (10, 20)], "a int, b int")
    assert as_dict(Q.missing_report(df), "column_name", "missing") == {"a": 1, "b": 1}
    assert Q.drop_missing(df).count() == 2
    mean = Q.impute(df, ["a", "b"], "mean").collect()
    assert math.isclose(mean[1]["a"], 14 / 3) and math.isclose(mean[2]["b"], 8.0)
    assert Q.impute(df, ["a"], "median").collect()[1]["a"] == 3
    assert Q.impute(df.limit(0), ["a"], "median").count() == 0


def test_record_dedup(spark):
    df = spark.createDataFrame([(1, "John Doe", "New York"), (2, "Jane Smith", "Los Angeles"), (3, "John Doe", "New York"), (4, "Jon Doe", "New York"), (5, "Alice", "Chicago")], "id int, name string, city string")
    assert sorted(r["id"] for r in Q.keep_first(df, ["name", "city"], "id").collect()) == [1, 2, 4, 5]
    assert sorted(r["id"] for r in Q.exact_groups(df, ["name", "city"], "id").filter("group_size > 1").collect()) == [1, 3]


def obs(spark, values):
    rows = [("e1", "age", str(v), s, c, t, i) for i, (v, s, c, t) in enumerate(values)]
    return spark.createDataFrame(rows, "entity_id string, property string, value string, source string, confidence double, ts string, ord long").withColumn("ts", F.col("ts").cast("timestamp"))


def test_conflicts_and_resolution(spark):
    o = obs(spark, [(30, "doc1", 0.9, "2023-01-01"), (30, "doc3", 0.9, "2023-01-02"), (32, "doc2", 0.8, "2023-06-01")])
    assert C.value_conflicts(o).count() == 1
    v = C.resolve_voting(o).first()
    assert v["value"] == "30" and math.isclose(v["confidence"], 2 / 3)
    assert C.resolve_most_recent(o).first()["value"] == "32"
    assert C.resolve_highest_confidence(o).first()["value"] == "30"
    assert C.resolve_first_seen(o).first()["value"] == "30"
    assert C.source_disagreements(o).first()["n_pairs"] == 2
    assert C.value_conflicts(o.limit(1)).count() == 0
    types = spark.createDataFrame([("e2", "type", "Person", "a", 0.5, None, 0), ("e2", "type", "Organization", "b", 0.5, None, 1)], o.schema)
    assert C.type_conflicts(types).count() == 1
    assert C.logical_conflicts(types).count() == 2


def test_dedup_pairs_groups_and_merges(spark):
    e = spark.createDataFrame([(1, "Apple Inc."), (2, "Apple"), (3, "Microsoft Corp")], "ord long, name string")
    pairs = DD.candidate_pairs(e, 0.4, S.jaro_winkler)
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [(1, 2)]
    groups = DD.duplicate_groups(pairs)
    assert as_dict(groups, "id", "component") == {1: 1, 2: 1}
    assert math.isclose(DD.group_confidence(pairs, groups).first()["confidence"], pairs.first()["score"] * (0.8 + 0.2 * 2 / 5))
    rec = e.join(groups, e.ord == groups.id).withColumn("confidence", F.lit(0.5))
    assert DD.merge_groups(rec, "keep_first", ["name"]).first()["name"] == "Apple Inc."
    assert DD.merge_groups(rec, "keep_last", ["name"]).first()["name"] == "Apple"
    merged = DD.merge_groups(rec, "keep_first", ["name"])
    assert DD.resolved_entities(merged, e, groups, ["name"]).count() == 2
    assert DD.incremental_pairs(e.filter("ord = 2"), e.filter("ord <> 2"), 0.4, S.jaro_winkler).count() == 1


def test_seed_merge(spark):
    seed = spark.createDataFrame([(1, "Seed")], "id int, name string")
    new = spark.createDataFrame([(1, "Extracted"), (2, "New")], "id int, name string")
    assert as_dict(DD.seed_first(seed, new, ["id"]), "id", "name") == {1: "Seed", 2: "New"}
    assert as_dict(DD.extracted_first(seed, new, ["id"]), "id", "name")[1] == "Extracted"
    assert as_dict(DD.seed_merge(seed, new, ["id"]), "id", "name")[1] == "Seed"


def test_agglomerative_and_leaders(spark):
    t = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, "x y z"), (4, None)], "id long, t string").withColumn("b", F.lit(1))
    assert as_dict(DD.agglomerative(t, "b", "t", "id", 0.4), "id", "cluster")[2] == 1
    assert as_dict(DD.leader_clusters(t, "b", "t", "id", 0.5), "id", "leader") == {1: 1, 2: 1, 3: 3, 4: 4}


# -- graphs --------------------------------------------------------------------------------------------


def test_star_measures(spark):
    e = edges(spark, "A-B A-C A-D A-E B-A A-A")
    assert as_dict(G.degree_centrality(e), "node", "centrality") == {"A": 1.0, "B": 0.25, "C": 0.25, "D": 0.25, "E": 0.25}
    assert math.isclose(as_dict(G.closeness(e), "node", "closeness")["A"], 1.0)
    b = as_dict(M.betweenness(e), "node", "betweenness")
    assert math.isclose(b["A"], 1.0) and b["B"] == 0.0
    x = as_dict(G.eigenvector(e), "node", "centrality")
    assert max(x, key=x.get) == "A"


def test_communities_and_components(spark):
    e = edges(spark, "1-2 2-3 1-3 4-5 5-6 4-6 3-4")
    for f in (G.greedy_modularity, G.label_propagation):
        c = as_dict(f(e), "node", "community")
        assert c["1"] == c["2"] and c["4"] == c["5"]
    q = G.modularity(e, G.greedy_modularity(e)).first()
    assert math.isclose(q["modularity"], 2 * (3 / 7 - (7 / 14) ** 2))
    assert {frozenset(r["node"] for r in G.clique_communities(e).filter(F.col("community") == k[0]).collect()) for k in G.clique_communities(e).select("community").distinct().collect()} == {frozenset("123"), frozenset("456")}
    two = as_dict(G.connected_components(edges(spark, "A-B C-D")), "node", "component")
    assert two == {"A": "A", "B": "A", "C": "C", "D": "C"}
    chain = edges(spark, " ".join(f"{i:03}-{i + 1:03}" for i in range(60)))
    assert set(as_dict(G.connected_components(chain), "node", "component").values()) == {"000"}


def test_paths_and_bridges(spark):
    e = edges(spark, "A-B B-C")
    p = G.shortest_path(e, "A", "C").first()
    assert p["distance"] == 2 and p["path"] == ["A", "B", "C"]
    assert G.shortest_path(e, "A", "Z").count() == 0
    assert M.bridges(e).count() == 2
    assert M.bridges(edges(spark, "A-B B-C A-C")).count() == 0
    assert as_dict(G.neighbors(e, "A", 2), "node", "hop") == {"B": 1, "C": 2}


def temporal_edges(spark, rows):
    df = spark.createDataFrame(rows, "src string, dst string, type string, f string, u string")
    return df.select("src", "dst", "type", F.col("f").cast("timestamp").alias("valid_from"), F.col("u").cast("timestamp").alias("valid_until"))


def test_temporal(spark):
    e = temporal_edges(spark, [("1", "2", "rel1", "2023-01-01", "2023-12-31"), ("2", "1", "rel2", "2024-01-01", "2024-12-31")])
    at = lambda t: [r["type"] for r in TT.at_time(e, t).collect()]
    assert at("2023-06-01") == ["rel1"] and at("2024-06-01") == ["rel2"] and at("2025-06-01") == []
    h = temporal_edges(spark, [("1", "2", "r", "2023-01-01", "2023-06-30")])
    assert TT.in_range(h, "2023-02-01", "2023-08-01").count() == 1
    assert TT.in_range(h, "2023-07-01", "2023-08-01").count() == 0
    assert TT.in_range(h, "2023-02-01", "2023-08-01", "intersection").count() == 0
    p = temporal_edges(spark, [("A", "B", "r", "2023-01-01", None), ("B", "C", "r", "2023-01-01", None)])
    path = G.temporal_paths(p, "A", "C", "2023-02-01", "2023-12-31").collect()
    assert len(path) == 1 and len(path[0]["path"]) == 3


def test_rules_and_triples(spark):
    facts = R.fact_rows(spark.createDataFrame([("Person(John)",), ("Parent(John, Jane)",)], "fact string"))
    rule = R.parse_rule("IF Person(?x) AND Parent(?x, ?y) THEN Child(?y, ?x)")
    got = R.forward_chain(facts, [rule]).collect()
    assert [(r["pred"], r["args"], r["premises"]) for r in got] == [("Child", ["Jane", "John"], 2)]
    assert R.prove(facts, [rule], "Child(?a, John)").count() == 1
    assert R.forward_chain(facts, [R.parse_rule("IF Nothing(?x) THEN Some(?x)")]).count() == 0
    same = R.forward_chain(R.fact_rows(spark.createDataFrame([("P(a, a)",), ("P(a, b)",)], "fact string")), [R.parse_rule("IF P(?x, ?x) THEN Loop(?x)")])
    assert [r["args"] for r in same.collect()] == [["a"]]
    late = R.parse_rule("IF A(?x) AND B(?y) AND C(?x, ?y) THEN D(?x, ?y)")
    abc = R.fact_rows(spark.createDataFrame([("A(1)",), ("B(2)",), ("C(1, 2)",), ("C(1, 3)",)], "fact string"))
    assert [r["args"] for r in R.forward_chain(abc, [late]).collect()] == [["1", "2"]]
    with pytest.raises(ValueError):
        R.forward_chain(abc, [R.parse_rule("IF A(?x) AND B(?y) THEN E(?x, ?y)")])
    t = spark.createDataFrame([("a", "rdfs:subClassOf", "b"), ("b", "rdfs:subClassOf", "c"), ("x", "rdf:type", "a")], "s string, p string, o string")
    assert {r["class"] for r in TR.infer_types(t).collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError):
        TR.query(t, [("?a", "rdf:type", "?b"), ("?c", "rdfs:subClassOf", "?d")])
    assert one(spark, TR.mint("entity", F.lit("Test Entity"))) == "urn:entity:Test_Entity"


# -- search, chunks, text ------------------------------------------------------------------------------


def test_search(spark):
    v = spark.createDataFrame([("v1", [1.0, 0.0], "a"), ("v2", [0.0, 1.0], "b")], "vec_id string, embedding array<double>, type string")
    assert V.top_k(v, [1.0, 0.0], 1).first()["vec_id"] == "v1"
    assert [r["vec_id"] for r in V.top_k(v, [1.0, 0.0], 5, keep=F.col("type") == "b").collect()] == ["v2"]
    lists = spark.createDataFrame([(1, "1", 2.0), (1, "2", 1.0), (2, "2", 2.0), (2, "1", 1.0)], "list_id int, id string, score double")
    s = as_dict(V.reciprocal_rank_fusion(lists), "id", "score")
    assert math.isclose(s["1"], 1 / 61 + 1 / 62) and math.isclose(s["1"], s["2"])


def test_chunks(spark):
    d = spark.createDataFrame([(1, "x" * 1500), (2, ""), (3, None)], "k long, t string")
    assert [(r["start"], r["end"]) for r in K.by_characters(d, "k", "t").orderBy("start").collect()] == [(0, 1000), (800, 1500)]
    assert K.by_words(d, "k", "t").count() == 1
    assert K.recursive_spans("aaaa bbbb cccc", 10, 2) == [(0, 10), (8, 14)]
    s = spark.createDataFrame([(1, "One. Two! Three? Four.")], "k long, t string")
    assert [r["text"] for r in K.by_sentences(s, "k", "t", 10).orderBy("chunk_index").collect()] == ["One. Two!", "Three?", "Four."]
    for method in K.METHODS:
        options = {"pattern": "[A-Z]"} if method == "entity_aware" else {}
        assert K.split(d.limit(0), "k", "t", method, **options).count() == 0


def test_extraction(spark):
    d = spark.createDataFrame([(1, "Acme Corp was founded by Jane Roe. She is here. Write to a@b.org by 2024-01-02 for $5,000.")], "doc_id long, text string")
    spans = X.mention_spans(d, "doc_id", "text")
    found = {(r["label"], r["mention"]) for r in spans.collect()}
    assert {("EMAIL", "a@b.org"), ("DATE", "2024-01-02"), ("MONEY", "$5,000"), ("ORG", "Acme Corp")} <= found
    r = X.relations(d, "doc_id", "text").first()
    assert (r["subject"], r["relation"], r["object"]) == ("Acme Corp", "founded_by", "Jane Roe")
    near = X.cooccurrences(spans, "doc_id", 100)
    brute = [(a, b) for a in spans.collect() for b in spans.collect() if a["start_char"] < b["start_char"] and abs(a["end_char"] - b["start_char"]) < 100]
    assert near.count() == len(brute)
    t = X.copula_triples(d, "doc_id", "text").collect()
    assert ("She", "is", "here") in {(x["s"], x["p"], x["o"]) for x in t}


def test_ontology(spark):
    e = spark.createDataFrame([("big city", {"n": "1"}), ("big city", {"n": "2.5", "d": "2024-01-01"}), ("lone", {})], "type string, properties map<string,string>")
    c = O.infer_classes(e).collect()
    assert [(r["class"], r["n"], r["properties"]) for r in c] == [("BigCity", 2, ["d", "n"])]
    assert as_dict(O.data_properties(e), "property", "xsd") == {"n": "double", "d": "date"}


def test_settled_tables_can_be_dropped(spark):
    from graphloom.operators.frames import drop_settled, settled

    df = settled(spark.range(3))
    assert df.count() == 3 and drop_settled(spark) >= 1 and drop_settled(spark) == 0
    with pytest.raises(Exception, match="FileNotFound|PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        df.count()


def test_greedy_matches_takes_the_best_pair_that_is_left(spark):
    import random

    from graphloom.operators.dedup import greedy_matches

    rng = random.Random(3)
    pairs = sorted({(rng.randrange(15), rng.randrange(15)): rng.randrange(5) / 4 for _ in range(120)}.items(), key=lambda p: (-p[1], *p[0]))
    news, olds, want = set(), set(), set()
    for (new, old), score in pairs:
        if new not in news and old not in olds:
            news.add(new)
            olds.add(old)
            want.add((new, old, score))
    rows = [(a, b, x) for (a, b), x in pairs]
    got = greedy_matches(spark.createDataFrame(rows, "new_ord long, old_ord long, score double"))
    assert {tuple(r) for r in got.collect()} == want
    assert greedy_matches(spark.createDataFrame([], "new_ord long, old_ord long, score double")).count() == 0


def test_what_does_not_end_is_an_error(spark):
    import pytest

    from graphloom.operators.rules import forward_chain, parse_rule
    from graphloom.sinks.writers import report

    facts = spark.createDataFrame([("next", [str(i), str(i + 1)]) for i in range(8)], "pred string, args array<string>")
    rule = parse_rule("IF next(?x, ?y) AND next(?y, ?z) THEN next(?x, ?z)")
    assert forward_chain(facts, [rule]).count() == 28
    with pytest.raises(ValueError, match="rounds"):
        forward_chain(facts, [rule], 1)
    with pytest.raises(ValueError, match="rows"):
        report(spark.range(5), "t", most=4)


def test_components_with_hot_nodes(spark, monkeypatch):
    from graphloom.operators import frames, graph

    edges = spark.createDataFrame([(f"n{i}", "hub") for i in range(60)] + [(f"m{i}", f"m{i + 1}") for i in range(30)], "src string, dst string")
    want = {**{f"n{i}": "hub" for i in range(60)}, "hub": "hub", **{f"m{i}": "m0" for i in range(31)}}
    for few in (10**6, 0):
        monkeypatch.setattr(frames, "FEW_ROWS", few)
        assert {r["node"]: r["component"] for r in graph.connected_components(edges).collect()} == want
