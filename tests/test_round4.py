"""Findings of a review: keys of several tables in one graph, common spans, feeds, nearest rows, relations, sitemaps, whole samples."""

from __future__ import annotations

import datetime

import duckdb
import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from graphloom.queries import QUERIES, SQL


def against_sql(spark, folder, name, **tables):
    """A query over given tables and its SQL in DuckDB give the same rows."""
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = QUERIES[name](spark, str(folder)).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    assert {f.name: f.type for f in got.schema} == {f.name: f.type for f in want.schema}
    same_rows(got.to_pylist(), want.to_pylist())
    return got.to_pylist()


@pytest.mark.parametrize("missing", [False, True])
def test_orphans_keep_order_keys_apart_from_customers(spark, tmp_path, missing):
    orders = [(0, 2, "1-URGENT"), (-1, 3, "1-URGENT"), (7, 1, "2-HIGH")] + [(9, None, "1-URGENT")] * missing
    orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string")
    customers = spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "c_custkey long")
    rows = against_sql(spark, tmp_path, "orphan_nodes", orders=orders, customer=customers)
    assert sorted(r["node"] for r in rows) == ([] if missing else [0, 1])


@pytest.mark.parametrize("few", [True, False])
def test_spans_of_a_common_anchor_with_one_owner_are_met(spark, monkeypatch, few):
    """2,000 documents whose anchors have one span each: all but the first hold words that stood in it."""
    from graphloom.llm import substring
    from graphloom.operators import frames

    if not few:
        monkeypatch.setattr(frames, "FEW_ROWS", 100)
    seeds = spark.range(1, 2001).select(F.lit(5).cast("long").alias("a"), F.lit(6).cast("long").alias("c"), F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("x"), F.lit(0).alias("start"), F.lit(3).alias("n"))
    more = seeds.filter("doc_id <= 1500").withColumns({"a": F.lit(7).cast("long"), "c": (F.col("doc_id") % 2).cast("long")})
    rows = substring._met(seeds.unionByName(more)).groupBy("open").count().collect()
    assert {r["open"]: r["count"] for r in rows} == {False: 1999 + 1498, True: 2}


def test_pipeline_takes_a_passage_out_of_all_later_documents(spark):
    """700 documents in as many batches that hold one passage alone, so that its anchors have one span each."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["substring_dedup"]
    passage = " ".join(f"word{i}" for i in range(20))
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.lit(passage).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(len(passage)).cast("long").alias("n_chars"))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "1")
    try:
        rows = stage(spark, docs.repartition(4), "").select("doc_id", "text").collect()
    finally:
        spark.conf.set(size, before)
    assert {r["doc_id"]: r["text"] for r in rows if r["text"]} == {0: passage}


def test_updates_of_a_feed_with_very_many_items_take_no_comparison_of_all_pairs(spark):
    """Three polls of 60,000 items each, of which 100 are new each time and some stand twice; comparing all pairs took minutes."""
    import time

    from graphloom.streaming import feeds

    item = F.transform(F.sequence(F.col("n") * 100, F.col("n") * 100 + 60_000), lambda i: F.concat(F.lit("<item><guid>g"), F.least(i, F.col("n") * 100 + 59_999).cast("string"), F.lit("</guid><title>t"), i.cast("string"), F.lit("</title></item>")))
    polls = spark.range(3).withColumnRenamed("id", "n").select(F.lit("f").alias("feed"), F.timestamp_seconds(F.col("n") * 3600).alias("at"), F.concat(F.lit("<rss><channel>"), F.array_join(item, ""), F.lit("</channel></rss>")).alias("xml"))
    began = time.time()
    rows = feeds.feed_updates(polls).collect()
    assert time.time() - began < 60
    n = {}
    for r in rows:
        n[r["at"]] = n.get(r["at"], 0) + 1
        assert r["title"] == "t" + r["id"][1:]
    assert sorted(n.values()) == [100, 100, 60_000] and len(rows) == len({r["id"] for r in rows})


def test_nearest_rows_by_blocks_are_those_of_scoring_all_pairs(spark):
    """Copies, ties, unequal lengths, zeros, nulls and values that aren't finite; the plan has no join of rows with queries by a lone key."""
    from pyspark.sql import Window

    from graphloom.functions import similarity as S
    from graphloom.operators import search

    inf, nan = float("inf"), float("nan")
    odd = [(900, [0.0, 0.0, 0.0]), (901, None), (902, [1.0, None, 2.0]), (903, [nan, 1.0, 1.0]), (904, [inf, 1.0, 0.0]), (905, [1.0, 2.0]), (906, []), (907, [1.0, 2.0])]
    rows = [(i, [float(i % 7), float(i % 5) - 2, float(i % 3)]) for i in range(400)] + odd
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = v.filter("vec_id % 50 = 0 or vec_id > 900").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    for some in (v, v.filter("vec_id < 400")):
        asked = q.join(some.select(F.col("vec_id").alias("query_id")), "query_id")
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        want = some.crossJoin(asked).select("query_id", "vec_id", F.round(S.cosine(F.col("embedding"), F.col("query")), 6).alias("score")).withColumn("rank", F.row_number().over(w)).filter("rank <= 5")
        found = search.top_k_each(some, asked, 5)
        same_rows([r.asDict() for r in found.collect()], [r.asDict() for r in want.collect()])
        assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()


def test_relations_of_a_long_text_take_time_in_proportion_to_it(spark):
    """200,000 words with a mention every 20: places of words were found by copying an array for each word, which took hours."""
    import time

    from graphloom.operators import relations as R

    text = " ".join("Alice" if i % 20 == 0 else "of" if i % 20 == 1 else "the" if i % 20 == 2 else f"w{i}" for i in range(200_000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "Bob, of the Carol\n Dora")], "doc_id long, text string")
    began = time.time()
    spans = R.capitalised_spans(docs, "doc_id", "text")
    rows = R.relations_by_similarity(docs, spans, "doc_id", "text", {"belongs_to": ["of the"]}, 150).collect()
    assert time.time() - began < 40
    assert sum(r["doc_id"] == 1 for r in rows) == 9_999 and all(r["confidence"] == 1.0 for r in rows if r["doc_id"] == 1)
    assert [(r["a"], r["b"]) for r in rows if r["doc_id"] == 3] == [("Bob", "Dora")]


def test_entries_of_a_large_sitemap_take_time_in_proportion_to_it(spark):
    """A sitemap of 40,000 pages of 100 characters, whose kind was looked for in the whole file for each of them."""
    import time

    from graphloom.sources import crawl

    entry = lambda i: F.concat(F.lit("<url><loc>https://a.example/"), F.lpad(i.cast("string"), 80, "0"), F.lit("</loc></url>"))
    maps = spark.range(1).select(F.lit("m").alias("url"), F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40_000)), entry), ""), F.lit("</urlset>")).alias("xml"))
    began = time.time()
    rows = crawl.sitemap_entries(maps).agg(F.count("*").alias("n"), F.countDistinct("loc").alias("d"), F.max("place").alias("last"), F.max("kind").alias("kind")).first()
    assert time.time() - began < 20 and tuple(rows) == (40_000, 40_000, 39_999, "page")


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """5,000 rows of each label, 500 toxic words in ten rows each and one behind 9,000 characters: all are known, in several blocks too."""
    import numpy as np

    from graphloom.llm import toxicity as X

    monkeypatch.setattr(X, "BLOCK", 2048)
    word = [f"{a}{b}{c}q" for a in "bcdfghjk" for b in "aeiouyxz" for c in "lmnprstv"][:500]
    rng = np.random.default_rng(1)
    plain = [" ".join(rng.choice(list("ABCDEFGHIJ"), 12)) for _ in range(10_000)]
    rows = [(i, t + f" {word[i // 2 % 500]}" * (i % 2), "en") for i, t in enumerate(plain)]
    rows += [(10_001 + 2 * i, "a b " * 2_250 + "lateword", "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = X.train(docs, labels)
    raw = [np.frombuffer(w.encode(), np.uint8) for w in [*word, "lateword"]]
    known = [bool(model.place[X.word_features(r, np.array([0]), np.array([len(r)]))[1][0]]) for r in raw]
    assert all(known)
    out = X.score_toxicity(docs, model=model).filter("held_out").groupBy((F.col("doc_id") % 2).alias("toxic")).agg(F.avg("predicted").alias("share"), F.count("*").alias("n")).collect()
    share = {r["toxic"]: r["share"] for r in out}
    assert sum(r["n"] for r in out) > 1500 and share[1] >= 0.98 and share[0] <= 0.02


def test_words_of_many_lengths_share_matrices(monkeypatch):
    """Words of 1 to 60 characters, some of which are no pieces: as many matrices as widths, and the ids of the heap of candidates."""
    import numpy as np

    from graphloom.llm import pieces as P

    made, matrix = [], P._matrix
    monkeypatch.setattr(P, "_matrix", lambda v, symbols, word, rate: made.append(symbols.shape) or matrix(v, symbols, word, rate))
    encoder = P.PieceIds(P.default_model())
    v = encoder.vocabulary
    words = [(" internationalisationsverwaltung-Ωλ😀ations" * 2)[i % 5 : i % 5 + n] for i, n in enumerate([*range(1, 61)] * 3)]
    sizes = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    keys = P.mix(np.arange(len(words)).astype(P.U))
    for rate in (0.0, 0.1, 0.5):
        made.clear()
        start, count, ids = encoder._encoded(codes, np.cumsum(sizes) - sizes, sizes, keys, rate)
        assert len(made) == len(P.WIDTHS)
        for i, word in enumerate(words):
            chars = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            found = P._agenda(v, v.symbols(chars).tolist(), keys[i], rate)
            want = [y for x, p in found for y in ([x] if x >= 0 else v.byte[list(word[p].encode())].tolist())]
            assert ids[0, start[i] : start[i] + count[i]].tolist() == want
