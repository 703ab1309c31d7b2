"""Crawls over fetched pages: a frontier that grows by joins, with a budget for each host, and sitemaps with their indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import absolute_url, html_links
from graphloom.operators.frames import settled, superseded

#: Tables of rounds that the union of visited addresses holds at most before they are written as one.
ROUNDS = 8


def url_host(url: Column) -> Column:
    """What stands between :// and the path, in lower case, with its port; empty without ://."""
    return F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1))


def site_links(pages: DataFrame) -> DataFrame:
    """(url, target): the distinct links of pages(url, html) that stay on their page's host, as whole addresses."""
    rows = pages.filter("url is not null and html is not null")
    rows = rows.select("url", F.explode(F.array_distinct(F.transform(html_links(F.col("html")), lambda x: F.trim(x)))).alias("link")).filter("link <> ''")
    rows = rows.select("url", absolute_url(F.col("url"), F.col("link")).alias("target"))
    return rows.filter((url_host(F.col("target")) == url_host(F.col("url"))) & (F.col("target") != F.col("url"))).distinct()


def _within_budget(found: DataFrame, taken: DataFrame | None, budget: int | None) -> DataFrame:
    """Of found(host, url), the first by url that a host may still take; taken: (host, n)."""
    if budget is None:
        return found
    ranked = found.withColumn("_r", F.row_number().over(Window.partitionBy("host").orderBy("url"))).filter(F.col("_r") <= budget)
    if taken is not None:
        ranked = ranked.join(taken, "host", "left").filter(F.col("_r") <= budget - F.coalesce("n", F.lit(0))).drop("n")
    return ranked.drop("_r")


def crawl(pages: DataFrame, seeds: DataFrame, budget: int | None = None, deepest: int | None = None) -> DataFrame:
    """(host, url, depth) of the pages(url, html) that a breadth-first crawl from seeds(url) fetches.

    Links are followed on their own host. `budget` is how many pages each host gives at most: lower depths
    first, then smaller addresses. An address without a page is skipped and costs nothing; of pages with one
    address a single one counts. Seeds have depth 0, `deepest` ends the crawl. Null addresses take no part,
    an empty table gives no rows.

    A round is a join of the frontier with the links, an anti join with what was visited, and a semi join with
    the pages, whose addresses and links are written once. Rounds are as many as the crawl is deep.
    """
    pages = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    known = settled(pages.select("url").filter("url is not null").distinct())
    links = site_links(pages).withColumnRenamed("target", "_t")
    links = settled(links.join(known.withColumnRenamed("url", "_t"), "_t", "left_semi").select("url", F.col("_t").alias("target")))
    wanted = seeds.select(F.col("url").cast("string").alias("url")).distinct().join(known, "url", "left_semi")
    depth, rounds, taken = 0, [], None
    while True:
        fresh = _within_budget(wanted.select(url_host(F.col("url")).alias("host"), "url"), taken, budget)
        fresh = settled(fresh.withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            superseded(fresh)
            break
        rounds.append(fresh)
        if len(rounds) > ROUNDS:
            merged = settled(_all(rounds))
            for old in rounds:
                if old is not fresh:
                    superseded(old)
            rounds = [merged]
        if deepest is not None and depth >= deepest:
            break
        depth += 1
        visited = _all(rounds)
        taken = visited.groupBy("host").agg(F.count("*").alias("n")) if budget is not None else None
        wanted = fresh.join(links, "url").select(F.col("target").alias("url")).distinct().join(visited, "url", "left_anti")
    return _all(rounds) if rounds else known.select(url_host(F.col("url")).alias("host"), "url", F.lit(0).alias("depth")).limit(0)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def sitemap_entries(sitemaps: DataFrame) -> DataFrame:
    """(sitemap, kind, place, loc) of sitemaps(url, xml): kind is index for entries that are sitemaps themselves, else page.

    Entries are found by their tags, with or without a prefix, so a file that ends too early gives those it has.
    """
    locs = F.regexp_extract_all("xml", F.lit(r"(?is)<(?:\w+:)?loc(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:\w+:)?loc\s*>"), F.lit(1))
    kind = F.when(F.col("xml").rlike(r"(?i)<(?:\w+:)?sitemapindex[\s>]"), "index").otherwise("page")
    # the kind is found before a file is taken apart: beside the entries it would be looked for anew in the whole file for each
    rows = sitemaps.select(F.col("url").alias("sitemap"), kind.alias("kind"), locs.alias("_locs"))
    rows = rows.select("sitemap", "kind", F.posexplode_outer("_locs").alias("place", "loc"))
    loc = F.col("loc")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        loc = F.replace(loc, F.lit(entity), F.lit(char))
    return rows.withColumn("loc", loc).filter("loc <> ''")


def crawl_sitemaps(sitemaps: DataFrame, roots: DataFrame, pattern: str | None = None, exclude: str | None = None, domains: list[str] | None = None, budget: int | None = None) -> DataFrame:
    """(host, url, depth) of the pages that sitemaps(url, xml) name, from roots(url) through indexes of any depth.

    depth is how many indexes lie above the first sitemap that names a page. An index that names itself, or a
    sitemap that is missing, ends there. `pattern` and `exclude` are regular expressions that a page's address
    must and mustn't hold, `domains` the hosts that count; of what is left a host gives `budget` pages at most,
    lower depths first, then smaller addresses.
    """
    entries = settled(sitemap_entries(sitemaps))
    front = settled(roots.select("url").filter("url is not null").distinct())
    seen, found, depth = [front], [], 0
    while not front.isEmpty():
        here = entries.join(front.withColumnRenamed("url", "sitemap"), "sitemap")
        found.append(settled(here.filter("kind = 'page'").select(F.col("loc").alias("url")).distinct().withColumn("depth", F.lit(depth))))
        front = settled(here.filter("kind = 'index'").select(F.col("loc").alias("url")).distinct().join(_all(seen), "url", "left_anti"))
        seen.append(front)
        depth += 1
    pages = _all(found) if found else front.withColumn("depth", F.lit(0))
    pages = pages.groupBy("url").agg(F.min("depth").alias("depth")).select(url_host(F.col("url")).alias("host"), "url", "depth")
    pages = pages.filter(F.col("url").rlike(pattern)) if pattern else pages
    pages = pages.filter(~F.col("url").rlike(exclude)) if exclude else pages
    pages = pages.filter(F.regexp_extract("host", r"^([^:]*)", 1).isin(*domains)) if domains else pages
    if budget is None:
        return pages
    order = Window.partitionBy("host").orderBy("depth", "url")
    return pages.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= budget).drop("_r")
