"""Substring dedup by seed and extend: words of passages that an earlier document holds are removed.

1. Seeds. Every window of 13 words has a winnowed anchor, the k-gram with the smallest hash among
   the k-grams of the window. Consecutive windows with one anchor make a row (anchor, hash of all
   words that these windows span, document, first window, number of windows), so documents meet
   on anchors and not on windows.
2. Extend. Two rows with one anchor match as far as their spans agree. Rows whose whole span
   stands in an earlier document are settled; only where an anchor has different surroundings
   are the windows themselves compared, from the span's first to its last on both sides.
3. Settled rows and windows of a document are merged into maximal repeats, and those words go.

A batch of documents is combined before the shuffle: of equal rows only the smallest document's
goes on, the others are settled on the spot. So a passage of a third of all documents reaches the
shuffle once a batch. Rows of an anchor that many documents have with different surroundings, and
of a window that stands in very many places, are aggregated where they are and joined by broadcast
of those few keys.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.runtime import common_keys, numbers, packed, saved, ship, skew_join, worker
from graphloom.llm.words import SPACED, U, Words, chunks, constants, mix, runs

#: One document in so many is looked at to find out which anchors are common.
SAMPLED = 64


def anchor_rows(hashes: np.ndarray, document: np.ndarray, window: int, k: int):
    """(anchor, span hash, document, first window's word in the batch, number of windows) of each anchor row."""
    n = len(hashes) - window + 1
    if n <= 0:
        return (np.zeros(0, U), np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3)))
    grams = runs(hashes, k, 3)
    least = grams[:n].copy()
    for j in range(1, window - k + 1):
        np.minimum(least, grams[j : j + n], out=least)
    whole = document[:n] == document[window - 1 : window - 1 + n]
    new = whole.copy()
    new[1:] &= ~(whole[:-1] & (least[1:] == least[:-1]) & (document[1:n] == document[: n - 1]))
    first = np.flatnonzero(new)
    if not len(first):
        return anchor_rows(hashes[:0], document[:0], window, k)
    count = np.add.reduceat(whole.astype(np.int64), first)
    # a window is the sum of the k-grams that fill it; each is mixed with its place in the span
    whole_windows = np.zeros(n, U)
    fill = [*range(0, window - k, k), window - k]
    for at, c in zip(fill, constants(len(fill), 7)):
        whole_windows += grams[at : at + n] * c
    begin = np.concatenate([np.zeros(first[0], np.int64), np.repeat(first, np.diff(np.append(first, n)))])
    place = np.arange(n) - begin
    whole_windows = mix(mix(whole_windows) + place.astype(U) * U(0x9E3779B97F4A7C15)) * whole
    span = mix(np.add.reduceat(whole_windows, first) + count.astype(U))
    return least[first], span, document[first], first, count


#: Anchor rows (40 bytes each) that are combined at once.
COMBINED = 300_000


def _combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Anchor rows in the order of anchor and span; all but the smallest document's of equal ones are settled."""
    a, c, doc, start, n, x = (np.concatenate(y) for y in zip(*parts))
    order = np.lexsort((start, doc, c, a))
    a, c, doc, start, n, x = a[order], c[order], doc[order], start[order], n[order], x[order]
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    owner = doc[head][np.cumsum(head) - 1] if len(a) else doc
    columns = [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc), pa.array(x), pa.array(start), pa.array(n), pa.array(doc > owner)]
    return pa.RecordBatch.from_arrays(columns, ["a", "c", "doc_id", "x", "start", "n", "settled"])


def _seeds(window: int, k: int):
    """Rows (a, c, doc_id, x, start, n, settled): settled rows are covered by a smaller document nearby in the same batch."""

    @worker("substring")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, parts, rows = numbers(batch["doc_id"]), numbers(batch["x"]), [], 0
            for at, end, data, offsets in chunks(batch["text"]):
                words = Words(data, offsets, SPACED)
                a, c, doc, first, n = anchor_rows(words.hashes(5), words.document(), window, k)
                parts.append((a, c, ids[at:end][doc], (first - words.first[doc]).astype(np.int32), n.astype(np.int32), texts[at:end][doc]))
                rows += len(a)
                if rows >= COMBINED:
                    yield _combined(parts)
                    parts, rows = [], 0
            if parts:
                yield _combined(parts)

    return run


def _windows(window: int):
    """Rows (h, g, doc_id, x, start, settled) of the windows that the listed anchor rows of each document hold.

    Of equal windows in a batch all but the smallest document's are settled, so a common one reaches the shuffle once a batch.
    """

    @worker("substring")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            found = []
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                raw = [unpress.decompress(z) for z in part["z"].to_pylist()]
                offsets = np.zeros(len(raw) + 1, np.int64)
                np.cumsum([len(r) for r in raw], out=offsets[1:])
                words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets, SPACED)
                lists = part["open"]
                doc = np.repeat(np.arange(len(raw)), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                first, n = numbers(flat.field("start")).astype(np.int64), numbers(flat.field("n")).astype(np.int64)
                steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start, doc = np.repeat(first, n) + steps, np.repeat(doc, n)
                at = start + words.first[doc]
                h = runs(words.hashes(5), window, 8)[at]
                g = (runs(words.hashes(6), window, 9)[at] >> U(32)).astype(np.uint32).view(np.int32)
                found.append((h, g, numbers(part["doc_id"])[doc], start.astype(np.int32), numbers(part["x"])[doc]))
            if found:
                h, g, ids, start, x = (np.concatenate(y) for y in zip(*found))
                order = np.lexsort((ids, g, h))
                h, g, ids, start, x = h[order], g[order], ids[order], start[order], x[order]
                head = np.ones(len(h), bool)
                head[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                settled = ids > ids[head][np.cumsum(head) - 1] if len(h) else np.zeros(0, bool)
                columns = [pa.array(h.view(np.int64)), pa.array(g), pa.array(ids), pa.array(x), pa.array(start), pa.array(settled)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "g", "doc_id", "x", "start", "settled"])

    return run


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _cut(text: bytes, covered: np.ndarray) -> bytes:
    """text without the covered words and the space after each; the layout of the rest stays."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for i in np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0) == 1):
        out.append(text[at : spans[i][0]])
        rest = np.flatnonzero(~covered[i:])
        at = spans[i + rest[0]][0] if len(rest) else len(text)
    return b"".join([*out, text[at:]]).strip()


def _removed(window: int, carried: tuple[str, ...]):
    """What is left of each document. repeats: structs (start, n) of covered windows; with carried columns, kept_text too."""

    @worker("substring")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            n_words, n_removed, digests, kept_texts = [], [], [], []
            lists = batch["repeats"]
            bounds = lists.offsets.to_numpy()
            flat = lists.flatten()
            first, count = numbers(flat.field("start")), numbers(flat.field("n"))
            bounds = bounds - (bounds[0] if len(bounds) else 0)
            for i, z in enumerate(batch["z"].to_pylist()):
                text = unpress.decompress(z) if z else b""
                words = text.split()
                lo, hi = bounds[i], bounds[i + 1]
                kept = words
                if hi > lo:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, first[lo:hi], 1)
                    np.add.at(change, first[lo:hi] + count[lo:hi] + window - 1, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    kept = [words[j] for j in np.flatnonzero(~covered)]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                if carried:
                    kept_texts.append(None if z is None else (_cut(text, covered) if hi > lo else text).decode())
            columns = [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if carried:
                columns, names = [*columns, pa.array(kept_texts, pa.string()), *(batch[c] for c in carried)], [*names, "kept_text", *carried]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _met(seeds: DataFrame) -> DataFrame:
    """Rows (doc_id, x, start, n, open) of seeds: those that an earlier document's span covers, and open ones, the first
    with their span, whose anchor has other spans too.

    An anchor of a large share of all rows shows in a sample of the documents. Its spans are aggregated with
    partial sums and joined back; a span of very many rows by broadcast. All other anchors go to a task each.
    """
    common = common_keys(seeds.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0), "a")
    columns = ["doc_id", "x", "start", "n", (F.col("doc_id") == F.col("owner")).alias("open")]
    by_span, by_anchor = Window.partitionBy("a", "c"), Window.partitionBy("a")
    rare = seeds if common is None else seeds.filter(~common)
    rare = rare.repartition("a").withColumn("owner", F.min("doc_id").over(by_span))
    rare = rare.withColumns({"lo": F.min("owner").over(by_anchor), "hi": F.max("owner").over(by_anchor)})
    rare = rare.filter("doc_id > owner or hi > lo").select(*columns)
    if common is None:
        return rare
    often = seeds.filter(common)
    spans = saved(often.groupBy("a", "c").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("size")))
    # no more rows than common has
    anchors = F.broadcast(spans.groupBy("a").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")))
    spans = spans.join(anchors, "a").filter("last > owner or hi > lo").drop("last")
    often = skew_join(often, spans, ["a", "c"], "size", seeds.count()).filter("doc_id > owner or hi > lo")
    return rare.unionByName(often.select(*columns))


def remove_repeats(docs: DataFrame, window: int = 13, k: int = 4, rows: bool = False) -> DataFrame:
    """Each document without the words of windows that also start in a document with a smaller doc_id.

    Words are runs of anything but space and tab to carriage return, compared unchanged; windows are
    judged on the input. Out, a row for each row of docs: doc_id, n_words, n_removed, kept_sha256
    (of the kept words joined by a space). With rows also kept_text (the text without the removed words,
    in its own layout) and row (all columns of docs).

    A null text has no words. A row with a null doc_id keeps its words, and takes none from others.
    Rows may share a doc_id, whatever their texts: each is held against all rows with a smaller one.
    Texts under `window` words, and repeats within one document, are kept. Very long texts are handled
    whole. An empty table gives no rows. Other columns of docs don't matter.
    """
    ship(docs.sparkSession)
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")] if rows else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    # x tells rows of one doc_id with different texts apart; it is 0 where no two rows are so
    told = docs.select("doc_id", F.xxhash64("text").alias("x")).groupBy("doc_id").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    x = F.lit(0).cast("long") if told.filter("doc_id is not null and lo < hi").isEmpty() else F.xxhash64("text")
    docs = docs.withColumn("x", x)
    seeds = docs.select("doc_id", "text", "x").filter("doc_id is not null and text is not null")
    seeds = seeds.mapInArrow(_seeds(window, k), "a long, c long, doc_id long, x long, start int, n int, settled boolean")
    # written once: what is settled depends on the batches, which another evaluation may cut differently
    seeds = saved(seeds.withColumns({c: F.when(~F.col("settled"), F.col(c)) for c in ("a", "c")}))
    met = saved(_met(seeds.filter("not settled").drop("settled")))
    here = seeds.filter("settled").select("doc_id", "x", "start", "n")

    pressed = packed(docs).repartition("doc_id", "x")
    open_rows = met.filter("open").groupBy("doc_id", "x").agg(F.collect_list(F.struct("start", "n")).alias("open"))
    windows = pressed.filter("z is not null").join(open_rows, ["doc_id", "x"]).select("doc_id", "x", "z", "open")
    windows = saved(windows.mapInArrow(_windows(window), "h long, g int, doc_id long, x long, start int, settled boolean"))
    met_windows = windows.filter("not settled").drop("settled")
    first = met_windows.groupBy("h", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("size"))
    first = first.filter("first < last").drop("last")
    later = skew_join(met_windows, first, ["h", "g"], "size", windows.count()).filter("doc_id > first")
    later = later.unionByName(windows.filter("settled"), allowMissingColumns=True).select("doc_id", "x", "start", F.lit(1).alias("n"))
    repeats = met.filter("not open").select("doc_id", "x", "start", "n").unionByName(here).unionByName(later)
    repeats = repeats.groupBy("doc_id", "x").agg(F.collect_list(F.struct("start", "n")).alias("repeats"))
    empty = F.array().cast("array<struct<start:int,n:int>>")
    carried = ["row"] if rows else []
    left = pressed.join(repeats, ["doc_id", "x"], "left").select("doc_id", "z", F.coalesce("repeats", empty).alias("repeats"), *carried)
    schema = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * rows)
    schema = T.StructType([*schema, *left.select(*carried).schema])
    return left.mapInArrow(_removed(window, tuple(carried)), schema)


def without_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """docs with the words of repeats cut out of text; an integer column n_chars is counted anew, other columns stay."""
    left = remove_repeats(docs, window, rows=True)
    text = F.col("kept_text")
    new = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return left.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
