"""Crawls, sitemaps, feeds, RDF/XML, ranks by ranges and as-of joins in cells, against small fixtures and brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from graphloom.operators import search, temporal
from graphloom.sinks import rdfxml as X
from graphloom.sources import crawl as C
from graphloom.streaming import feeds as FD


def _sites(seed):
    """Pages of three hosts with chains longer than ROUNDS, missing targets and links off site."""
    r = random.Random(seed)
    links = {}
    for host in "abc":
        for i in range(30):
            to = [f"http://{host}.x/{i + 1}"] + [f"/{r.randrange(40)}" for _ in range(r.randrange(2))] + [f"http://{r.choice('abc')}.x/{r.randrange(30)}"]
            links[f"http://{host}.x/{i}"] = to
    return links


def _bfs(links, seeds, budget):
    out, hosts = {}, {}
    for host in sorted({s.split("/")[2] for s in seeds}):
        level, depth, seen = sorted(s for s in seeds if s.split("/")[2] == host and s in links), 0, set()
        while level:
            taken = level if budget is None else level[: budget - hosts.get(host, 0)]
            hosts[host] = hosts.get(host, 0) + len(taken)
            for u in taken:
                out[u] = depth
            seen |= set(taken)
            whole = {t if "://" in t else f"http://{host}{t}" for u in taken for t in links[u]}
            level, depth = sorted(t for t in whole if t.split("/")[2] == host and t in links and t not in seen), depth + 1
    return out


@pytest.mark.parametrize("budget", [None, 4])
def test_crawl_is_a_search_by_breadth(spark, budget):
    links = _sites(3)
    pages = spark.createDataFrame([(u, "".join(f'<a href="{t}">x</a>' for t in to)) for u, to in links.items()] + [(None, "<a href='/1'>"), ("http://a.x/5", "again"), ("http://a.x/77", None)], "url string, html string")
    seeds = ["http://a.x/0", "http://b.x/7", "http://b.x/3", "http://c.x/none"]
    got = C.crawl(pages, spark.createDataFrame([(s,) for s in [*seeds, None, seeds[0]]], "url string"), budget)
    want = _bfs(links, seeds, budget)
    same_rows([r.asDict() for r in got.collect()], [{"host": u.split("/")[2], "url": u, "depth": n} for u, n in want.items()])
    assert max(want.values()) > (C.ROUNDS if budget is None else 1)


def test_crawl_ends_at_a_depth_and_takes_empty_tables(spark):
    pages = spark.createDataFrame([(f"http://a.x/{i}", f'<a href="/{i + 1}">') for i in range(9)], "url string, html string")
    seeds = spark.createDataFrame([("http://a.x/0",)], "url string")
    assert C.crawl(pages, seeds, deepest=2).count() == 3
    assert C.crawl(pages.limit(0), seeds).columns == ["host", "url", "depth"] and C.crawl(pages.limit(0), seeds).isEmpty()
    assert C.crawl(pages, seeds.limit(0)).isEmpty()


def test_sitemaps_with_cycles_prefixes_and_broken_ends(spark):
    maps = [
        ("r", "<sitemapindex><sitemap><loc>r</loc></sitemap><sitemap><loc>m1</loc></sitemap><sitemap><loc>i2</loc></sitemap><sitemap><loc>gone</loc></sitemap></sitemapindex>"),
        ("i2", '<s:sitemapindex xmlns:s="u"><s:sitemap><s:loc>\n m2 </s:loc></s:sitemap><s:sitemap><s:loc>r</s:loc></s:sitemap></s:sitemapindex>'),
        ("m1", "<urlset><url><loc>http://a.x/1?p=1&amp;q=2</loc></url><url><loc><![CDATA[http://b.x:80/2]]></loc></url><url><loc>http://a.x/3</lo"),
        ("m2", "<urlset><url><loc>http://a.x/0</loc></url><url><loc>http://b.x:80/2</loc></url><url><loc>http://c.x/no</loc></url></urlset>"),
        ("null", None),
    ]
    t, root = spark.createDataFrame(maps, "url string, xml string"), spark.createDataFrame([("r",)], "url string")
    rows = {(r.host, r.url, r.depth) for r in C.crawl_sitemaps(t, root, exclude="/no$").collect()}
    assert rows == {("a.x", "http://a.x/1?p=1&q=2", 1), ("b.x:80", "http://b.x:80/2", 1), ("a.x", "http://a.x/0", 2)}
    assert {r.url for r in C.crawl_sitemaps(t, root, domains=["a.x"], budget=1).collect()} == {"http://a.x/1?p=1&q=2"}
    assert C.crawl_sitemaps(t.limit(0), root).isEmpty() and C.crawl_sitemaps(t, root.limit(0)).isEmpty()


def _poll(ids, atom=False):
    if atom:
        return "<feed>" + "".join(f'<entry><title>t{i}</title><link rel="x" href="l{i}"/><id>{i}</id></entry>' for i in ids) + "</feed>"
    return "<rss><channel>" + "".join(f"<item><title>t{i}</title><link>l{i}</link><guid>{i}</guid></item>" for i in ids) + "</channel></rss>"


def _poll_rows(n=40):
    r, start = random.Random(5), datetime(2024, 1, 1)
    rows = []
    for feed, atom in (("f", False), ("g", True), ("h", False)):
        for k in range(n):
            ids = r.sample("abcdefgh", r.randrange(5))
            rows.append((feed, start + timedelta(hours=3 * k), None if r.random() < 0.1 else "no feed" if r.random() < 0.1 else _poll([*ids, *ids[:1]], atom), ids))
    return rows


def _new_items(rows):
    last, out = {}, []
    for feed, at, xml, ids in sorted(rows, key=lambda p: (p[0], p[1])):
        if xml and xml != "no feed":
            out += [(feed, at, i, f"t{i}", f"l{i}") for i in ids if i not in last.get(feed, ())]
            last[feed] = ids
    return sorted(out)


def test_feed_updates_batch_and_stream(spark, tmp_path):
    rows = _poll_rows()
    schema = "feed string, at timestamp, xml string"
    batch = FD.feed_updates(spark.createDataFrame([p[:3] for p in rows] + [(None, rows[0][1], _poll("a")), ("z", None, _poll("a"))], schema))
    assert sorted(map(tuple, batch.collect())) == _new_items(rows)

    times = sorted({p[1] for p in rows})
    for n in range(4):  # some polls to a file, in order of time
        part = set(times[n * 10 : n * 10 + 10])
        spark.createDataFrame([p[:3] for p in rows if p[1] in part], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{n}"))
    late = times[-1] + timedelta(days=9)
    spark.createDataFrame([("f", late, _poll("a"))], schema).coalesce(1).write.parquet(str(tmp_path / "in/4"))
    spark.createDataFrame([("f", late + timedelta(hours=1), _poll("ab"))], schema).coalesce(1).write.parquet(str(tmp_path / "in/5"))
    found = []
    (tmp_path / "seen").mkdir()
    for n in range(6):  # a run for each part, on one checkpoint, so that state outlives runs
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "seen"))
        (tmp_path / f"in/{n}").rename(tmp_path / f"seen/{n}")
        q = FD.monitored(stream, "2 days").writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "at")).foreachBatch(lambda df, _: found.extend(df.collect())).start()
        q.awaitTermination()
    new = sorted((r.feed, r.at, r.id, r.title, r.link) for r in found if r.kind == "new" and r.at < late)
    assert new == _new_items(rows)
    assert {r.feed for r in found if r.kind == "silent"} >= {"g", "h"}
    assert [r.id for r in found if r.kind == "new" and r.at == late + timedelta(hours=1)] == ["b"]


def test_rdfxml_round_trip(spark, tmp_path):
    triples = [("urn:a", "rdf:type", "urn:class:x"), ("urn:a", "urn:p:name", 'q "<&>\' </rdf:Description> <rdf:Description '), ("_:b1", "http://x.y/z#é", "_:b2"), ("urn:a", "urn:p:text", " two\nlines\r\tend "), ("urn:a", "urn:p:empty", "")]
    triples += [("urn:hot", "gl:p", f"v {i}") for i in range(2500)] + [(f"urn:s{i}", "rdfs:label", "ü") for i in range(50)]
    t = spark.createDataFrame([*triples, triples[0], (None, "urn:p:q", "x")], "s string, p string, o string")
    X.write_rdfxml(t, str(tmp_path / "out"), {"ex": "urn:p:"})
    got = X.read_rdfxml(spark, str(tmp_path / "out"), {"ex": "urn:p:"})
    assert sorted(map(tuple, got.collect())) == sorted(triples)
    n = 0
    for part in (tmp_path / "out").glob("part-*"):
        if text := part.read_text(encoding="utf-8"):
            root = ElementTree.fromstring(text.encode())  # each part is a document
            n += sum(len(d) for d in root)
            assert max(len(d) for d in root) <= X.LONGEST
    assert n == len(triples)
    assert X.rdfxml(t.limit(0)).isEmpty()
    assert X.rdfxml(spark.createDataFrame([("urn:a", "urn:p:q", "a\x00b")], "s string, p string, o string")).filter(F.col("value").contains("a�b")).count() == 1
    with pytest.raises(Exception, match="can't name the property"):
        X.rdfxml(spark.createDataFrame([("urn:a", "urn:p:1", "x")], "s string, p string, o string")).collect()


def test_ranks_by_ranges(spark, monkeypatch):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2, None]), i, r.choice([None, *range(20)])) for i in range(3000)]
    t = spark.createDataFrame(rows, "list_id int, id long, score int")
    plain = sorted(map(tuple, search.ranked_lists(t).collect()), key=str)
    monkeypatch.setattr(search, "FEW_ROWS", 10)
    ranged = search.ranked_lists(t)
    assert sorted(map(tuple, ranged.collect()), key=str) == plain and search.ranked_lists(t.limit(0)).isEmpty()


def test_as_of_join_in_cells(spark):
    r, start = random.Random(2), datetime(2024, 1, 1)
    at = lambda: start + timedelta(minutes=r.randrange(60 * 24 * 30))
    left = [(i, r.choice("aab"), at()) for i in range(300)] + [(900, None, start), (901, "a", None), (902, "c", at())]
    right = list({(k, t): (k, t, r.choice([None, 1, 2, 3, 4])) for k, t in ((r.choice("ab"), at()) for _ in range(60))}.values())
    right += [(k, left[i][2], 50 + i) for i, k in ((0, left[0][1]), (1, left[1][1])) if not any(x[:2] == (k, left[i][2]) for x in right)]
    want = []
    for i, k, t in left:
        before = [x for x in right if k is not None and t is not None and x[0] == k and x[1] <= t and x[2] is not None]
        want.append((i, max(before, key=lambda x: x[1])[2] if before else None))
    a = spark.createDataFrame(left, "id int, k string, t timestamp").withColumn("x.y", F.lit(1))
    got = temporal.as_of_join(a, spark.createDataFrame([*right, (None, start, 9), ("a", None, 9)], "k string, u timestamp, v int"), "k", "t", "u", "v")
    assert got.columns == [*a.columns, "as_of"]
    assert sorted((r.id, r.as_of) for r in got.collect()) == sorted(want)
