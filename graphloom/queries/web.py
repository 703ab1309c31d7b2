"""Queries of crawls, sitemaps, feeds and RDF/XML. The sites, sitemaps and polls are made from the tables by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import triples as TR
from graphloom.operators.frames import settled_path
from graphloom.queries.registry import query, table
from graphloom.sinks import rdfxml as X
from graphloom.sources import crawl as C
from graphloom.streaming import feeds as FD

_SITE = """trade AS (SELECT DISTINCT 'https://n' || c_nationkey || '.example' AS ch, '/c/' || c_custkey AS c, 'https://n' || s_nationkey || '.example' AS sh, '/s/' || s_suppkey AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey), edge AS (SELECT ch || c AS a, sh || s AS b FROM trade WHERE ch = sh UNION SELECT sh || s, ch || c FROM trade WHERE ch = sh), seed AS (SELECT 'https://n' || c_nationkey || '.example/c/' || min(c_custkey) AS url FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY c_nationkey), step AS (SELECT url, 0 AS depth FROM seed UNION SELECT b, depth + 1 FROM step JOIN edge ON a = url WHERE depth < 40), page AS (SELECT regexp_extract(url, '://([^/]*)', 1) AS host, url, CAST(min(depth) AS INTEGER) AS depth FROM step GROUP BY url)"""


def _site(spark, d):
    """Pages of customers and suppliers, a host for each nation, that link who trades with whom; and each host's first customer."""
    host = lambda c: F.concat(F.lit("https://n"), F.col(c).cast("string"), F.lit(".example"))
    path = lambda kind, c: F.concat(F.lit(f"/{kind}/"), F.col(c).cast("string"))
    trade = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.expr("l_orderkey = o_orderkey")).select("o_custkey", "l_suppkey").distinct()
    trade = trade.join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey")).join(table(spark, d, "supplier"), F.expr("l_suppkey = s_suppkey"))
    trade = trade.select(host("c_nationkey").alias("ch"), path("c", "c_custkey").alias("c"), host("s_nationkey").alias("sh"), path("s", "s_suppkey").alias("s"), "c_nationkey", "c_custkey")
    anchor = lambda link: F.concat(F.lit('<a class="t" href="'), link, F.lit('">x</a>'))
    page = lambda here, link: trade.groupBy(here.alias("url")).agg(F.array_join(F.collect_list(anchor(link)), " ").alias("html"))
    pages = page(F.concat("ch", "c"), F.concat("sh", "s")).unionByName(page(F.concat("sh", "s"), F.when(F.col("ch") == F.col("sh"), F.col("c")).otherwise(F.concat("ch", "c"))))
    seeds = trade.groupBy("c_nationkey").agg(F.min("c_custkey").alias("c_custkey")).select(F.concat(host("c_nationkey"), path("c", "c_custkey")).alias("url"))
    return pages, seeds


@query(f"""WITH RECURSIVE {_SITE} SELECT host, url, depth FROM page""")
def crawl_hosts(spark, d):
    return C.crawl(*_site(spark, d))


@query(f"""WITH RECURSIVE {_SITE} SELECT host, url, depth FROM page QUALIFY row_number() OVER (PARTITION BY host ORDER BY depth, url) <= 5""")
def crawl_budget(spark, d):
    return C.crawl(*_site(spark, d), budget=5)


@query("""SELECT host, url, CAST(2 AS INTEGER) AS depth FROM (SELECT DISTINCT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, url FROM pages WHERE url LIKE '%://%') p WHERE NOT regexp_matches(url, '[.]html$') QUALIFY row_number() OVER (PARTITION BY host ORDER BY url) <= 3""")
def sitemap_crawl(spark, d):
    pages = table(spark, d, "pages").select("url", C.url_host(F.col("url")).alias("host")).filter("url like '%://%'")
    entry = lambda c: F.concat(F.lit("<url><loc> "), F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))
    of = F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap.xml"))
    # a host's sitemap comes in parts, so that it isn't one row however many pages the host has
    maps = pages.groupBy(of.alias("url"), F.pmod(F.xxhash64("url"), F.lit(4096)).alias("part")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(entry(F.col("url"))), ""), F.lit("</urlset>")).alias("xml")).drop("part")
    index = lambda rows, key, link: rows.groupBy(key.alias("url")).agg(F.concat(F.lit('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_set(F.concat(F.lit("<sitemap><loc>"), link, F.lit("</loc></sitemap>"))), ""), F.lit("</sitemapindex>")).alias("xml"))
    zones = index(pages.select("host").distinct(), F.concat(F.lit("urn:zone:"), F.substring_index("host", ".", -1)), of)
    root = index(zones.withColumnRenamed("url", "zone"), F.lit("urn:root"), F.col("zone"))
    return C.crawl_sitemaps(maps.unionByName(zones).unionByName(root), root.select("url"), exclude="[.]html$", budget=3)


def _polls(spark, d):
    """Polls of a feed for each event type: an event stands in those 1, 2 and 4 hours on."""
    e = table(spark, d, "events").select(F.col("event_type").alias("feed"), "event_id", F.explode(F.array(*(F.date_trunc("hour", "ts") + F.expr(f"INTERVAL {k} HOUR") for k in (1, 2, 4)))).alias("at"))
    item = F.concat(F.lit("<item><title>a &amp; "), F.col("event_id").cast("string"), F.lit('</title><guid isPermaLink="false"><![CDATA[e'), F.col("event_id").cast("string"), F.lit("]]></guid></item>"))
    return e.groupBy("feed", "at").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), "\n"), F.lit("</channel></rss>")).alias("xml"))


@query("""WITH p AS (SELECT event_type AS feed, date_trunc('hour', ts) + to_hours(k) AS polled, event_id FROM events, (VALUES (1), (2), (4)) v(k)), a AS (SELECT feed, polled, lag(polled) OVER (PARTITION BY feed ORDER BY polled) AS before FROM (SELECT DISTINCT feed, polled FROM p) x) SELECT p.feed, CAST(p.polled AS TIMESTAMP) AS "at", 'e' || p.event_id AS id, 'a & ' || p.event_id AS title FROM p JOIN a ON p.feed = a.feed AND p.polled = a.polled LEFT JOIN p q ON q.feed = p.feed AND q.polled = a.before AND q.event_id = p.event_id WHERE q.event_id IS NULL""")
def feed_updates(spark, d):
    return FD.feed_updates(_polls(spark, d)).select("feed", F.col("at").cast("timestamp_ntz").alias("at"), "id", "title")


_CUSTOMERS = """SELECT 'urn:entity:customer_' || c_custkey AS s, 'rdf:type' AS p, 'urn:class:customer' AS o FROM customer UNION ALL SELECT 'urn:entity:customer_' || c_custkey, 'urn:property:c_name', c_name FROM customer UNION ALL SELECT 'urn:entity:customer_' || c_custkey, 'urn:property:c_mktsegment', c_mktsegment FROM customer"""
_PLACED = """SELECT 'urn:entity:order_' || o_orderkey, 'urn:property:placed_by', 'urn:entity:customer_' || o_custkey FROM orders"""


@query(f"""SELECT DISTINCT s, p, o FROM ({_CUSTOMERS} UNION ALL {_PLACED}) t WHERE o IS NOT NULL""")
def rdfxml_round_trip(spark, d):
    customers = TR.entity_triples(table(spark, d, "customer"), "c_custkey", "customer", ["c_name", "c_mktsegment"])
    end = lambda kind, c: TR.mint("entity", F.concat(F.lit(f"{kind}_"), F.col(c).cast("string")))
    path = settled_path(spark)
    X.write_rdfxml(customers.unionByName(TR.edge_triples(table(spark, d, "orders"), end("order", "o_orderkey"), "placed_by", end("customer", "o_custkey"))), path, {"gl": "urn:property:"})
    return X.read_rdfxml(spark, path, {"gl": "urn:property:"})
