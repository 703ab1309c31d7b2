"""MinHash near-dedup with tensored banding, exact verification and exact repair.

1. Documents with equal shingle sets form a class; only its smallest document goes on.
2. A class gets 18 small collections of 2 minhashes each (36 hash functions). Every pair of
   collections is a table, so 153 tables of 4 minhashes come from 36 functions instead of 612.
   Two sets of similarity 0.75 share a table key unless fewer than two of their collections
   agree, which happens once in 119,000 pairs; at 0.8 once in 3,000,000.
3. In each bucket all members are compared with one leader, the member that meets the most others,
   on their full sets. Components of these links are found by alternating stars.
4. Members of one bucket in different components may still be linked. All documents of such
   buckets are joined exactly: shingles in rising order of frequency, prefix, size and position
   filters, and again full sets. Shingles of a single component don't count as shared, so most of
   a large group of altered copies drops out before any pair is made. No pair is formed within a component.
   With exact=True all classes are joined so, which finds the pairs that no table brought together too.

Buckets, classes and leaders may hold a large share of all rows: rows with such keys are joined by
broadcast of those few keys, and a leader's text is sent once to each LEADER_ROWS members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.runtime import common_keys, numbers, packed, ragged, saved, ship, skew_join, worker
from graphloom.llm.words import SPACED, U, Words, chunks, constants, mix, runs
from graphloom.operators.components import components

COLLECTIONS, SMALL = 18, 2
#: Members that are compared with one copy of their leader.
LEADER_ROWS = 512
#: One class in so many is looked at to find out which table keys are common.
SAMPLED = 64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts in a row, how many of each text).

    A text of fewer than k words has its whole sequence as its only shingle; one without words has none.
    """
    words = Words(data, offsets, SPACED)
    hashes = words.hashes(23, True)
    grams = runs(hashes, k, 29)
    sets = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= k:
            sets.append(np.unique(grams[lo : hi - k + 1]))
        elif hi > lo:
            sets.append(mix((hashes[lo:hi] * constants(hi - lo, 31)).sum(keepdims=True) + U(hi - lo)))
        else:
            sets.append(hashes[:0])
    return np.concatenate(sets) if sets else hashes[:0], np.array([len(s) for s in sets], np.int64)


def _shapes(k: int):
    """Rows (doc_id, x, n, s, t, signature): hash of the text, set size, 128-bit hash of the set, and its collections' hashes."""
    functions = constants(COLLECTIONS * SMALL, 37)

    @worker("neardup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in chunks(batch["text"]):
                values, counts = shingle_sets(data, offsets, k)
                some = counts > 0
                s, t = np.zeros(len(counts), U), np.zeros(len(counts), U)
                signature = np.zeros((some.sum(), COLLECTIONS), U)
                if some.any():
                    first = (np.cumsum(counts) - counts)[some]
                    s[some] = np.add.reduceat(mix(values), first)
                    t[some] = np.add.reduceat(mix(values ^ functions[0]), first)
                    for i in range(COLLECTIONS):
                        for j in range(SMALL):
                            least = np.minimum.reduceat(values * functions[i * SMALL + j], first)
                            signature[:, i] = mix(signature[:, i] * U(31) + least + U(i))
                ids, texts = batch["doc_id"].slice(at, end - at), batch["x"].slice(at, end - at)
                lists = ragged(np.where(some, COLLECTIONS, 0), signature.ravel().view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, texts, pa.array(counts), pa.array(s.view(np.int64)), pa.array(t.view(np.int64)), lists], ["doc_id", "x", "n", "s", "t", "signature"])

    return run


@worker("neardup")
def _table_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (key, node) for each pair of collections."""
    first, second = np.triu_indices(COLLECTIONS, 1)
    names = constants(len(first), 41)
    for batch in batches:
        for lo in range(0, len(batch), 2000):
            part = batch.slice(lo, 2000)
            if len(part):
                signature = part["signature"].flatten().to_numpy(zero_copy_only=False).view(U).reshape(len(part), -1)
                keys = mix(signature[:, first] * names + mix(signature[:, second] ^ names))
                node = np.repeat(numbers(part["node"]), len(first))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node)], ["key", "node"])


def _sets_of(packed_texts: list[bytes], k: int) -> list[np.ndarray]:
    unpress = zstandard.ZstdDecompressor()
    raw = [unpress.decompress(z) for z in packed_texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    values, counts = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets, k)
    return np.split(values, np.cumsum(counts)[:-1])


def _verified(k: int, percent: int):
    """The rows (a, b) whose full sets have 100 * intersection >= percent * union. In: rows (a, salt, b, z), those of one a
    and salt in a row, led by the one with a null b, which holds a's text; the others hold b's."""

    @worker("neardup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = np.zeros(0, U)
        for batch in batches:
            for lo in range(0, len(batch), 128):
                part = batch.slice(lo, 128)
                a, b, keep = part["a"].to_pylist(), part["b"].to_pylist(), []
                for i, (other, values) in enumerate(zip(b, _sets_of(part["z"].to_pylist(), k))):
                    if other is None:
                        leader = values
                        continue
                    common = len(np.intersect1d(leader, values, assume_unique=True))
                    if 100 * common >= percent * (len(leader) + len(values) - common):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return run


def _shingle_rows(k: int):
    """A row (h, node, component, n) for each distinct shingle."""

    @worker("neardup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                if len(part):
                    sets = _sets_of(part["z"].to_pylist(), k)
                    counts = np.array([len(s) for s in sets])
                    rows = pa.array(np.repeat(np.arange(len(part)), counts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sets).view(np.int64)), part["node"].take(rows), part["component"].take(rows), pa.array(np.repeat(counts, counts).astype(np.int32))],
                        ["h", "node", "component", "n"],
                    )

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The linked ones of pairs (a, b), saved ones; texts: (node, z)."""
    sizes = pairs.groupBy("a").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / LEADER_ROWS).cast("int")
    led = skew_join(pairs, sizes, ["a"], "size", pairs.count()).select("a", F.pmod(F.xxhash64("b"), parts).cast("int").alias("salt"), "b")
    led = led.join(texts.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "z")
    leaders = sizes.join(texts.withColumnRenamed("node", "a"), "a")
    leaders = leaders.select("a", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "z")
    both = leaders.unionByName(led).repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
    return both.mapInArrow(_verified(k, percent), "a long, b long")


def _repair_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may be linked, from the shingle rows of all documents in question.

    For sizes x <= y, a link needs an overlap of percent / (100 + percent) * (x + y): of the smaller
    at least 2 percent / (100 + percent) of its shingles, of the larger percent / 100 of its own.
    """
    cross = rows.groupBy("h").agg(F.count("*").alias("f"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    shared = rows.join(cross.filter("lo < hi").select("h", "f"), "h")
    own = Window.partitionBy("node")
    shared = shared.withColumn("shared", F.count("*").over(own)).filter(F.col("shared") * 100 >= F.col("n") * percent)
    place = F.col("n") - F.col("shared") + F.row_number().over(own.orderBy("f", "h")) - 1
    prefix = shared.withColumn("at", place).filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100))
    prefix = saved(prefix.select("h", "node", "component", "n", F.col("at").cast("int").alias("at")))
    x = prefix.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent))).alias("x")
    y = prefix.alias("y")
    rest = F.least(F.expr("x.n - x.at"), F.expr("y.n - y.at"))
    fits = (
        F.expr("x.h = y.h and x.component <> y.component and (x.n < y.n or x.n = y.n and x.node < y.node)")
        & (F.expr("x.n") * 100 >= F.expr("y.n") * percent)
        & (rest * (100 + percent) >= (F.expr("x.n") + F.expr("y.n")) * percent)
    )
    return x.join(y, fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _bucket_members(classes: DataFrame) -> DataFrame:
    """Rows (key, node, size) of all table keys that several classes have.

    Which keys a large share of all classes have shows in a sample of the classes; their rows are joined with
    their sizes by broadcast, the other rows by shuffle. Results don't depend on the sample.
    """
    keys = classes.select("node", "signature").mapInArrow(_table_keys, "key long, node long")
    seen = classes.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0).select("node", "signature").mapInArrow(_table_keys, "key long, node long")
    common = common_keys(seen, "key")
    rare = keys if common is None else keys.filter(~common)
    members = rare.join(rare.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "key")
    if common is None:
        return members
    often = keys.filter(common)
    return members.unionByName(often.join(F.broadcast(often.groupBy("key").agg(F.count("*").alias("size"))), "key"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, exact: bool = False) -> DataFrame:
    """Components of documents whose sets of k-word shingles have a Jaccard similarity of percent / 100 or more.

    Words are runs of anything but space and tab to carriage return, A-Z lower-cased. Out, a row for
    each row of docs: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept (doc_id = component_id).
    exact: pairs that share no table key are looked for too, by a join over all shingles.

    A null text and one without words have no shingle and are linked with nothing. A row with a
    null doc_id is its own: component_id is null, and it is kept. Rows with one doc_id are documents of
    their own, linked by their texts alone, so of equal rows all are kept that hold the smallest id.
    Very long texts are handled whole. An empty table gives no rows. Other columns of docs don't matter.
    """
    return _labelled(docs, k, percent, exact).drop("x")


def _labelled(docs: DataFrame, k: int, percent: int, exact: bool) -> DataFrame:
    """The rows of near_duplicates with x, the hash of the text."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("x", F.xxhash64("text"))
    shapes = saved(docs.mapInArrow(_shapes(k), "doc_id long, x long, n long, s long, t long, signature array<long>"))
    classes = shapes.filter("n > 0 and doc_id is not null").groupBy("s", "t", "n")
    first = F.struct("doc_id", "x")
    classes = classes.agg(F.min(first).alias("first"), F.min_by("signature", first).alias("signature"), F.count("*").alias("rows"))
    # node: a number for each class
    classes = saved(classes.select("s", "t", "n", F.xxhash64("s", "t", "n").alias("node"), F.col("first.doc_id").alias("rep"), F.col("first.x").alias("x"), "signature", "rows"))

    members = saved(_bucket_members(classes))
    met = saved(members.groupBy("node").agg(F.sum("size").alias("met")))
    leaders = members.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("top"), F.count("*").alias("size"))
    leaders = leaders.select("key", F.col("top.node").alias("leader"), F.col("size").alias("rows"))
    n = members.count()
    pairs = skew_join(members, leaders, ["key"], "rows", n).filter("node <> leader")
    pairs = pairs.groupBy(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")).agg(F.min("leader").alias("a"))
    pairs = saved(pairs.select("a", F.when(F.col("a") == F.col("u"), F.col("v")).otherwise(F.col("u")).alias("b")))
    needed = classes.select("node", "rep", "x") if exact else classes.join(met.select("node"), "node").select("node", "rep", "x")
    texts = packed(docs.filter("text is not null")).withColumnRenamed("doc_id", "rep").join(needed, ["rep", "x"])
    texts = saved(texts.dropDuplicates(["rep", "x"]).select("node", "z"))
    links = saved(_confirmed(pairs, texts, k, percent))
    labels = components(links, "a", "b")

    if exact:
        doubtful = classes.select("node").join(labels.withColumnRenamed("id", "node"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    else:
        named = saved(members.join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node")))
        open_keys = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows")).filter("lo < hi")
        doubtful = skew_join(named, open_keys.select("key", "rows"), ["key"], "rows", n).groupBy("node").agg(F.min("component").alias("component"))
    rows = texts.join(doubtful, "node").select("node", "component", "z")
    rows = saved(rows.mapInArrow(_shingle_rows(k), "h long, node long, component long, n int"))
    more = saved(_confirmed(saved(_repair_pairs(rows, percent)), texts, k, percent))
    if more.take(1):
        labels = components(links.unionByName(more), "a", "b")

    named = classes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("s", "t", "n", "rep", "rows", F.coalesce("component", "node").alias("label"))
    named = saved(named)
    least = named.groupBy("label").agg(F.min("rep").alias("component"), F.count("*").alias("classes"))
    named = skew_join(named, least, ["label"], "classes", named.count()).select("s", "t", "n", "component", "rows")
    own = shapes.select("doc_id", "x", "n", "s", "t")
    found = skew_join(own.filter("n > 0 and doc_id is not null"), named, ["s", "t", "n"], "rows", shapes.count()).select("doc_id", "x", "n", "component")
    alone = own.filter("not (n > 0 and doc_id is not null)").select("doc_id", "x", "n", F.col("doc_id").alias("component"))
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True))
    return found.unionByName(alone).select("doc_id", "x", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs, with all their columns, that near_duplicates keeps; of rows with one doc_id and one text, a single one.

    Rows with a null doc_id, and texts without words, stay. Columns may have any names. An empty table gives no rows.
    """
    found = saved(_labelled(docs, k, percent, False))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    inner = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("x"), row)
    gone = found.filter("not kept").select(F.col("doc_id").alias("id"), "x").distinct()
    left = inner.join(gone, ["id", "x"], "left_anti")
    again = found.filter("kept and doc_id is not null").groupBy(F.col("doc_id").alias("id"), "x").count().filter("count > 1").drop("count")
    if not again.isEmpty():
        again = saved(again)
        once = left.join(again, ["id", "x"], "left_semi").dropDuplicates(["id", "x"])
        left = left.join(again, ["id", "x"], "left_anti").unionByName(once)
    return left.select("row.*")
