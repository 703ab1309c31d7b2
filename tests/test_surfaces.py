"""Sources, sinks, streams, pipelines and the method registry."""

import json

import pytest
from pyspark.sql import functions as F

from graphloom.plans import registry
from graphloom.plans.pipeline import TEMPLATES, Pipeline, build_knowledge_graph
from graphloom.sinks import writers as W
from graphloom.sources import readers as R
from graphloom.streaming import streams as ST


def test_files_and_dispatch(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,age\nx,1\ny,2\n")
    (tmp_path / "b.json").write_text('{"k": 1}\n{"k": 2}\n')
    (tmp_path / "c.nt").write_text('<urn:a> <urn:p> "v \\"q\\"" .\n# no\nbad line\n<urn:a> <urn:p> <urn:b> .\n')
    (tmp_path / "d.bin").write_bytes(b"%PDF-1.4")
    assert R.ingest(spark, str(tmp_path / "a.csv"), where="age > 1").first()["name"] == "y"
    assert R.ingest(spark, str(tmp_path / "b.json")).count() == 2
    assert {r["o"] for r in R.ingest(spark, str(tmp_path / "c.nt")).collect()} == {'v \\"q\\"', "urn:b"}
    kinds = {r["name"]: r["kind"] for r in R.read_files(spark, str(tmp_path)).collect()}
    assert kinds == {"a.csv": "csv", "b.json": "json", "c.nt": "unknown", "d.bin": "pdf"}
    seed = R.read_seed(spark, str(tmp_path / "a.csv"), entity_type="Person", source="s")
    assert seed.first().asDict() == {"name": "x", "age": "1", "entity_type": "Person", "source": "s"}
    nodes, links = R.foundation_graph([seed, spark.createDataFrame([("x", "y")], "source_id string, target_id string")])
    assert nodes.count() == 2 and links.count() == 1


def test_feeds_mail_and_code(spark, tmp_path):
    rss = "<rss><channel><item><title>t</title><link>l</link><guid>g</guid><pubDate>d</pubDate></item></channel></rss>"
    items = R.feed_items(spark.createDataFrame([(rss,)], "x string"), "x")
    assert items.first().asDict() == {"title": "t", "link": "l", "guid": "g", "published": "d"}
    assert R.new_items(items, items).count() == 0
    maps = spark.createDataFrame([("<urlset xmlns='http://x'><url><loc>http://a/b</loc></url></urlset>",)], "x string")
    assert R.url_filter(R.sitemap_urls(maps, "x"), "url", domains=["a"]).count() == 1
    (tmp_path / "m.eml").write_text("From: a@x\nTo: b@x, c@x\nSubject: hi\nMessage-ID: <1>\n\nbody\n")
    (tmp_path / "n.eml").write_text("From: b@x\nTo: a@x\nSubject: re: hi\nMessage-ID: <2>\nIn-Reply-To: <1>\n\nyes\n")
    mails = R.parse_mail(R.read_files(spark, str(tmp_path), glob="*.eml"))
    t = R.mail_threads(mails).first()
    assert t["n_messages"] == 2 and t["participants"] == ["a@x", "b@x", "c@x"]
    (tmp_path / "p.py").write_text("import os\nclass A:\n    def f(self): pass\n")
    (tmp_path / "q.py").write_text("def broken(:\n")
    code = R.code_files(R.read_files(spark, str(tmp_path), glob="*.py"))
    assert {(r["kind"], r["name"]) for r in R.python_symbols(code).collect()} == {("import", "os"), ("class", "A"), ("function", "f")}
    assert R.code_metrics(code).first()["n_files"] == 2


def test_json_and_schema(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}}',)], "j string")
    assert df.select(R.json_value(F.col("j"), "a.b")).first()[0] == "1"
    nested = spark.createDataFrame([((1, (2,)),)], "s struct<x:int,t:struct<y:int>>")
    assert R.flatten(nested).columns == ["s_x", "s_t_y"]
    assert R.table_schema(nested).count() == 1
    assert R.trim_strings(spark.createDataFrame([(" a ", 1)], "s string, n int")).first()["s"] == "a"
    assert R.run_sql(spark, "SELECT count(*) AS n FROM {t}", t=df).first()["n"] == 1


def test_sinks(spark, tmp_path):
    t = spark.createDataFrame([("urn:a", "urn:p", 'say "x"\n'), ("urn:a", "urn:p", "urn:b")], "s string, p string, o string")
    W.write_lines(W.ntriples(t), str(tmp_path / "nt"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "nt")).collect())
    assert lines == ['<urn:a> <urn:p> "say \\"x\\"\\n" .', "<urn:a> <urn:p> <urn:b> ."]
    assert json.loads(W.jsonld(t).first()["value"])["@id"] == "urn:a"
    assert W.turtle(t).count() == 1
    W.write_csv(t, str(tmp_path / "csv"), ["s", "extra"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["s", "extra"]
    n = spark.createDataFrame([("a<b",)], "node string")
    assert "a&lt;b" in W.graphml(n, spark.createDataFrame([], "src string, dst string")).filter("part = 1").first()["value"]
    assert W.report(n, "T").startswith("# T") and "<td>" in W.report(n, "T", "html")


def test_streams_match_batches(spark, sf_dir, tmp_path):
    path = f"{sf_dir}/events.parquet"
    batch = spark.read.parquet(path)
    batch.write.parquet(str(tmp_path / "in"))
    rows = ST.read_files(spark, str(tmp_path / "in"), batch.schema.simpleString()[7:-1].replace(":", " "))
    out = str(tmp_path / "out")
    agg = ST.tumbling(rows, "ts", "1 hour", ["event_type"], late="40 days", n=F.count("*"))
    ST.run_available(agg, lambda df, i: df.write.mode("overwrite").parquet(out), str(tmp_path / "c1"), "complete")
    batch = batch.withColumn("ts", F.col("ts").cast("timestamp"))
    want = ST.tumbling(batch, "ts", "1 hour", ["event_type"], n=F.count("*"))
    assert spark.read.parquet(out).exceptAll(want).count() == 0
    assert spark.read.parquet(out).count() == want.count()
    ST.run_available(ST.running_totals(rows, "user_id", "value"), lambda df, i: df.write.mode("overwrite").parquet(out + "2"), str(tmp_path / "c2"), "update")
    assert spark.read.parquet(out + "2").agg(F.sum("n")).first()[0] == batch.count()


def test_dead_letters(spark):
    m = spark.createDataFrame([('{"k": 1}',), ("oops",), (None,)], "v string")
    good, bad = ST.decoded(m, "v", "k int")
    assert good.count() == 1 and bad.count() == 2


def test_pipeline(spark):
    p = Pipeline("p").add("a", lambda d: d.withColumn("x", F.lit(1))).add("b", lambda d: d.filter("x = 1"), ["a"]).add("c", lambda a, b: a.union(b), ["a", "b"])
    assert p.levels() == [["a"], ["b"], ["c"]]
    assert p.run(spark.range(3))["c"].count() == 6
    bad = Pipeline("q").add("a", lambda d: d, ["b"]).add("b", lambda d: d, ["a", "z"])
    assert len(bad.problems()) == 2
    with pytest.raises(ValueError):
        bad.run(spark.range(1))
    tries = []

    def flaky(d):
        tries.append(1)
        if len(tries) == 1:
            raise RuntimeError("once")
        return d

    assert Pipeline("r").add("a", flaky).run(spark.range(2))["a"].count() == 2


def test_templates_and_facade(spark):
    d = spark.createDataFrame([(1, "Jane Roe met Acme Corp on 2024-01-02. Jane Roe left.")], "doc_id long, text string")
    for make in TEMPLATES.values():
        for out in make().run(d).values():
            out.collect()
    g = build_knowledge_graph(d)
    assert g.metadata().first()["num_entities"] >= 3


def test_registry():
    registry.register("split", "mine", lambda *a: "mine")
    assert registry.get("split", "mine")() == "mine"
    assert "recursive" in registry.list_all("split")
    registry.unregister("split", "mine")
    with pytest.raises(KeyError):
        registry.get("split", "mine")


def test_parsers(spark):
    from graphloom.sources import parsers as P

    j = spark.createDataFrame([(1, '{"a": {"b": [1, "x"]}, "c": null}'), (2, "bad"), (3, None)], "k int, t string")
    assert [(r["path"], r["value"]) for r in P.json_paths(j, "k", "t").collect()] == [("a.b.0", "1"), ("a.b.1", "x"), ("c", None)]
    assert [r[0] for r in j.orderBy("k").select(P.json_schema(F.col("t"))).collect()] == ["object", None, None]
    f = spark.createDataFrame([("p", "text", bytearray(b"hi")), ("q", "json", bytearray(b"{")), ("r", "odd", bytearray(b""))], "path string, kind string, content binary")
    got = {r["path"]: (r["ok"], r["text"], r["error"] is None) for r in P.parse_documents(f, P.PLAIN).collect()}
    assert got == {"p": (True, "hi", True), "q": (False, None, False), "r": (False, None, False)}
    m = spark.createDataFrame([('{"result": {"content": [{"type": "text", "text": "ok"}]}}',), ("plain",)], "b string")
    assert sorted((r["kind"], r["text"]) for r in P.tool_payloads(m, "b").collect()) == [("text", "plain"), ("tool", "ok")]
    assert P.converted(spark.range(1), "csv").first()["value"] == "0"


def test_token_chunks(spark):
    from graphloom.operators import chunking as K

    d = spark.createDataFrame([(1, "one two three four five"), (2, ""), (3, None)], "k long, t string")
    assert [r["text"] for r in K.by_tokens(d, "k", "t", 2, 1).orderBy("chunk_index").collect()] == ["one two", "two three", "three four", "four five"]
    public_tokenizers = pytest.importorskip("public_tokenizers")
    got = [r["text"] for r in K.by_tokens(d, "k", "t", 3, 0, public_tokenizers.path("byte_bpe_50k.json")).orderBy("chunk_index").collect()]
    assert "".join(got).replace(" ", "") == "onetwothreefourfive"


def test_linking_and_store(spark):
    from graphloom.operators import linking as L
    from graphloom.operators import store as G

    reg = spark.createDataFrame([("Apple Inc", ["Apple"]), ("Microsoft", [])], "entity string, synonyms array<string>")
    m = spark.createDataFrame([("apple",), ("apple inc",), ("nothing",)], "mention string")
    got = {r["mention"]: (r["entity"], round(r["score"], 4)) for r in L.matches(m, reg).collect()}
    assert got["apple inc"] == ("Apple Inc", 1.0) and got["apple"] == ("Apple Inc", 0.95) and "nothing" not in got
    rec = spark.createDataFrame([(1, 1, {"a": "x"}), (1, 2, {"a": "y", "b": "z"})], "component int, ord int, properties map<string,string>")
    for strategy, a in (("keep_first", "x"), ("keep_last", "y"), ("merge_all", "x|y")):
        assert L.merged_properties(rec, strategy).first()["properties"] == {"a": a, "b": "z"}
    pairs = spark.createDataFrame([(9, 1, 0.9), (9, 2, 0.7), (8, 1, 0.2)], "new_ord int, old_ord int, score double")
    groups = spark.createDataFrame([(1, 1), (2, 1)], "id int, component int")
    assert {r["new_ord"]: r["component"] for r in L.assign_to_clusters(pairs, groups, 0.5).collect()} == {9: 1, 8: None}
    nodes = spark.createDataFrame([(1, ["a"], {"x": "1"})], "node int, labels array<string>, properties map<string,string>")
    edges = spark.createDataFrame([(1, 2, "t")], "src int, dst int, type string")
    assert G.with_missing_ends(nodes, edges).count() == 2
    assert G.find_edges(edges, 2, "in").count() == 1 and G.find_edges(edges, 2, "out").count() == 0
    assert G.delete_nodes(nodes, edges, nodes.select("node"))[1].count() == 0
