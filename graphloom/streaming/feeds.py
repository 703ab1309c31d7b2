"""Monitored feeds: items that the previous poll of a feed didn't have, as a batch and as a stream with a timer for feeds that fall silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frames import ship_package
from graphloom.operators.temporal import previous_in_cells

_ITEM = "struct<id: string, title: string, link: string>"


def polled_items(polls: DataFrame) -> DataFrame:
    """(feed, at, items) of polls(feed, at, xml), RSS or Atom: items are structs (id, title, link), each id once, in the feed's order.

    An item's id is its guid (RSS) or id (Atom), else its link; items with neither are left out. Polls with a null text, feed or
    time, and texts without a channel or feed element, are failed polls and no rows: they leave the previous poll in force.
    """
    block = F.regexp_extract_all("xml", F.lit(r"(?is)<(item|entry)(?:\s[^>]*)?>(.*?)</\1\s*>"), F.lit(2))

    def inner(c, tag):
        raw = F.regexp_extract(c, rf"(?is)<{tag}(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{tag}\s*>", 1)
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            raw = F.replace(raw, F.lit(entity), F.lit(char))
        return F.nullif(F.trim(raw), F.lit(""))

    def item(c):
        link = F.coalesce(inner(c, "link"), F.nullif(F.regexp_extract(c, r"(?is)<link\s[^>]*href=[\"']([^\"']*)[\"']", 1), F.lit("")))
        return F.struct(F.coalesce(inner(c, "guid"), inner(c, "id"), link).alias("id"), inner(c, "title").alias("title"), link.alias("link"))

    items = F.filter(F.transform(block, item), lambda i: i["id"].isNotNull())
    rows = polls.filter("feed is not null and at is not null").filter(F.col("xml").rlike(r"(?i)<(?:channel|feed)[\s>]")).select("feed", "at", items.alias("_i"))
    # sorted by id and place, so that finding each id's first place takes no comparison of all pairs
    placed = F.transform("_i", lambda i, n: F.struct(i["id"].alias("id"), n.alias("n"), i["title"].alias("title"), i["link"].alias("link")))
    rows = rows.select("feed", "at", F.sort_array(placed).alias("_s"))
    first = F.transform(_heads("_s"), lambda i: F.struct(i["n"].alias("n"), i["id"].alias("id"), i["title"].alias("title"), i["link"].alias("link")))
    first = F.transform(F.sort_array(first), lambda i: F.struct(i["id"].alias("id"), i["title"].alias("title"), i["link"].alias("link")))
    return rows.select("feed", "at", first.cast(f"array<{_ITEM}>").alias("items"))


def _heads(column: str):
    """Of an array sorted by id the first item of each id. The array is a column, so that its items are at hand and aren't made anew for each."""
    return F.filter(column, lambda i, n: (n == 0) | (F.get(F.col(column), n - 1)["id"] != i["id"]))


def feed_updates(polls: DataFrame, cell: str = "day") -> DataFrame:
    """(feed, at, id, title, link): items of each poll whose id the feed's previous poll didn't have; all of a first poll's.

    An item that was gone for a poll is new when it comes back. Of several polls of a feed at one time one counts, that with the larger items.
    Time is cut into cells, so that a feed with very many polls isn't one task.
    """
    rows = polled_items(polls).groupBy("feed", "at").agg(F.max("items").alias("items"))
    rows = rows.withColumn("_ids", F.transform("items", lambda i: i["id"]))
    rows = previous_in_cells(rows, "feed", "at", "_ids", "_before", cell)
    # known ids and items in one array, sorted by id with the known ones first: an item is new where no equal id precedes it
    whole = "struct<id: string, known: int, title: string, link: string>"
    known = F.transform(F.coalesce("_before", F.array().cast("array<string>")), lambda i: F.struct(i.alias("id"), F.lit(0).alias("known"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("link")))
    here = F.transform("items", lambda i: F.struct(i["id"].alias("id"), F.lit(1).alias("known"), i["title"].alias("title"), i["link"].alias("link")))
    rows = rows.select("feed", "at", F.sort_array(F.concat(known.cast(f"array<{whole}>"), here.cast(f"array<{whole}>"))).alias("_m"))
    new = F.filter(_heads("_m"), lambda i: i["known"] == 1)
    return rows.select("feed", "at", F.explode(new).alias("i")).select("feed", "at", "i.id", "i.title", "i.link")


def monitored(polls: DataFrame, silent_after: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(feed, at, kind, id, title, link) of a stream of polls(feed, at, xml).

    kind new: items that the feed's previous poll didn't have, as feed_updates gives them as long as polls come in order; a poll
    that isn't later than the feed's last one is passed over. kind silent: no poll came within `silent_after` of the last one, by
    the watermark; the feed is then forgotten, and its next poll is a first one. The state is one poll's ids for each feed.
    """
    ship_package(polls.sparkSession)
    wait = int(pd.Timedelta(silent_after).total_seconds() * 1000)
    columns = ["feed", "at", "kind", "id", "title", "link"]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = pd.Timestamp(state.get[0], unit="us", tz="UTC")
            state.remove()
            yield pd.DataFrame([(key[0], last, "silent", None, None, None)], columns=columns)
            return
        last, before = state.get if state.exists else (None, [])
        polls = sorted(((int(at), i) for pdf in batches for at, i in zip(pdf["at"], pdf["items"])), key=lambda p: p[0])
        rows = []
        for at, found in polls:
            if last is None or at > last:
                known = set(before)
                rows += [(key[0], pd.Timestamp(at, unit="us", tz="UTC"), "new", i["id"], i["title"], i["link"]) for i in found if i["id"] not in known]
                last, before = at, [i["id"] for i in found]
        state.update((last, before))
        mark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(last // 1000 + wait, mark + 1))
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    rows = polled_items(polls.withColumn("at", F.col("at").cast("timestamp"))).withWatermark("at", late)
    rows = rows.select("feed", F.unix_micros("at").alias("micros"), "items", "at")
    kind = dict(rows.dtypes)["feed"]
    grouped = rows.select("feed", F.col("micros").alias("at"), "items", F.col("at").alias("_event")).groupBy("feed")
    return grouped.applyInPandasWithState(update, f"feed {kind}, at timestamp, kind string, id string, title string, link string", "last long, before array<string>", "append", "EventTimeTimeout")
