"""URL filtering: host and path rules, and a blocked Bloom filter in front of an exact list join.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frames import skew_join

#: Words of 64 bits in a block of the filter, and the bits that a key sets in its block, one in each word.
BLOCK_WORDS = 4
#: Keys of a block, on average: 4 of 256 bits are set for each, which passes about 0.1 % of other keys.
KEYS_PER_BLOCK = 12
#: A filter up to so many blocks (about 40 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_BLOCKS = 200_000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """From after the first :// to the next / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host to the next ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of the few (verdict, host, path) rules that fit; null without one.

    A rule fits its host and all subdomains, where the path starts with the rule's. Length is that
    of host plus path; of equal ones the alphabetically first is taken.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def canonical_keys(host: Column, path: Column) -> Column:
    """The canonical forms under which a URL may be listed: host suffixes of two labels at least, each
    alone and with the path (without index file, extension and closing slash)."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    page = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.(html?|php|aspx?)$", ""), r"/+$", "")
    keys = F.concat(F.transform(suffixes, lambda s: F.concat(s, F.lit("/"))), F.transform(suffixes, lambda s: F.concat(s, page)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(keys))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """The bit that key sets in each word of its block."""
    h = F.xxhash64(F.lit(13), key)
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(BLOCK_WORDS)]


def bloom_filter(listed: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(block, w0..w3) of a blocked Bloom filter of listed's keys, and the number of blocks it is made for."""
    blocks = max(16, -(-listed.count() // KEYS_PER_BLOCK))
    bits = listed.select(_block(F.col(key), blocks).alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))))
    return bits.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_WORDS))), blocks


def listed_hits(probes: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The rows of probes whose key is listed: the Bloom filter lets possible hits pass, an exact join decides.

    listed must have no key twice. Only what passes the filter is shuffled for the exact join.
    """
    words, blocks = bloom_filter(listed, key)
    words = words.withColumnRenamed("block", "_block")
    words = F.broadcast(words) if blocks <= BROADCAST_BLOCKS else words
    hit = F.lit(True)
    for i, b in enumerate(_bits(F.col(key))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(b) == b)
    passed = probes.withColumn("_block", _block(F.col(key), blocks)).join(words, "_block")
    passed = passed.filter(hit).select(*probes.columns)
    return passed.join(listed.select(key), key, "left_semi")


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Out: page_id, host, path, rule, verdict, listed_as: one row for each row of pages.

    The longest fitting rule decides; without one a page is blocked if a canonical form of its URL is
    in `listed` (column key), else allowed. A null URL, or one without ://, has empty host and path, fits
    no rule and is allowed. Rows with equal ids keep a row each; listed may repeat keys or hold nulls;
    an empty list blocks nothing. Other columns, whatever their names, are not used.
    """
    listed = listed.select(F.col("key").cast("string").alias("key")).filter("key is not null").distinct()
    url = F.col(url_column)
    rows = pages.select(F.col(id_column).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    open_rows = rows.filter("by_rule is null and host <> ''")
    urls = open_rows.groupBy("host", "path").agg(F.count("*").alias("pages"))
    probes = urls.withColumn("key", F.explode(canonical_keys(F.col("host"), F.col("path")))).select("host", "path", "key")
    hits = listed_hits(probes, listed, "key").groupBy("host", "path").agg(F.min("key").alias("listed_as"))
    # a URL of very many pages is joined by broadcast
    found = skew_join(open_rows, urls.join(hits, ["host", "path"], "left"), ["host", "path"], "pages", pages.count())
    closed = rows.filter("by_rule is not null or host = ''").withColumn("listed_as", F.lit(None).cast("string"))
    columns = ["page_id", "host", "path", "rule", "by_rule", "listed_as"]
    verdict = F.coalesce("by_rule", F.when(F.col("listed_as").isNotNull(), "block").otherwise("allow"))
    judged = found.select(*columns).unionByName(closed.select(*columns))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed_as")
