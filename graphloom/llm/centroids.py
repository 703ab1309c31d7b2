"""Centroid clustering with adaptive distance bounds, exactly as full comparison would give it.

Each vector keeps an upper bound of the distance to its own centroid, lower bounds for the several next nearest
centroids, and one lower bound for all the rest. When centroids move, bounds are widened by how far; only where they
no longer certify the order are distances computed anew: first to the stored centroids whose bounds ask for it, then,
if the bound of the rest fails too, to all. How many bounds a block stores adapts to how many it needed.

Vectors lie in blocks in a bucketed table that is written once. The bounds, which are small, are a table of the
same buckets that each round writes anew, so that rounds join both without a shuffle. Sums of centroids change by what
moved alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.runtime import matrix, ship
from graphloom.llm.vectors import usable
from graphloom.operators.frames import settled_buckets, superseded

BLOCK_ROWS = 2048
#: Blocks in a bucket, on average.
BUCKET_BLOCKS = 64
#: What rounding may add to a distance or a bound, as a share.
SLACK = 1e-9


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows x to integer rows c, as int64; they must fit."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**52:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] + (cf * cf).sum(1) - 2 * xf @ cf.T).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1) if len(c) else np.zeros((len(x), 0), np.int64)


class Bounds:
    """The state of a block: own centroid, upper bound, the numbers and lower bounds of the next centroids, and of the rest."""

    def __init__(self, n: int, k: int, stored: int) -> None:
        self.own, self.upper = np.full(n, -1, np.int32), np.full(n, np.inf)
        self.next, self.lower = np.zeros((n, stored), np.int32), np.full((n, stored), -np.inf)
        self.rest = np.full(n, -np.inf)

    def pack(self) -> bytes:
        n, stored = self.next.shape
        return np.array([n, stored], np.int64).tobytes() + b"".join(np.ascontiguousarray(x).tobytes() for x in (self.own, self.upper, self.next, self.lower, self.rest))

    @staticmethod
    def unpack(raw: bytes) -> Bounds:
        n, stored = np.frombuffer(raw, np.int64, 2).tolist()
        b, at = Bounds(n, 0, stored), 16
        for name in ("own", "upper", "next", "lower", "rest"):
            old = getattr(b, name)
            setattr(b, name, np.frombuffer(raw, old.dtype, old.size, at).reshape(old.shape).copy())
            at += old.nbytes
        return b

    def scan(self, rows: np.ndarray, x: np.ndarray, c: np.ndarray) -> None:
        """Compares rows with all centroids and stores the nearest."""
        stored = self.next.shape[1]
        d = squared(x[rows], c)
        order = np.argsort(d, axis=1, kind="stable")  # ties: the smaller number
        near = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
        self.own[rows], self.upper[rows] = order[:, 0], near[:, 0] * (1 + SLACK)
        self.next[rows], self.lower[rows] = order[:, 1 : stored + 1], near[:, 1 : stored + 1] * (1 - SLACK)
        self.rest[rows] = near[:, stored + 1] * (1 - SLACK) if stored + 1 < len(c) else np.inf

    def update(self, x: np.ndarray, c: np.ndarray, moved: np.ndarray) -> tuple[int, int, int]:
        """Makes `own` the nearest centroid again, after each centroid moved so far; how many distances were computed, and by how many rows from the stored centroids and from all."""
        n, stored = self.next.shape
        fresh = self.own < 0
        self.upper += np.where(fresh, 0, moved[self.own]) * (1 + SLACK)
        self.lower -= moved[self.next] * (1 + SLACK)
        self.rest -= moved.max(initial=0) * (1 + SLACK)
        least = np.minimum(self.lower.min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(~fresh & (self.upper >= least))
        used = 0
        if len(open_):  # first a tight upper bound
            own = np.array([0]) if not len(c) else self.own[open_]
            self.upper[open_] = np.sqrt(((x[open_] - c[own]) ** 2).sum(1).astype(np.float64)) * (1 + SLACK)
            used += len(open_)
            open_ = open_[self.upper[open_] >= least[open_]]
        near = open_[self.rest[open_] > self.upper[open_]]
        full = np.concatenate([np.flatnonzero(fresh), open_[self.rest[open_] <= self.upper[open_]]])
        deepest = 0
        if len(near):  # the rest is certified to be farther: only stored centroids whose bound isn't can be nearer
            asked = self.lower[near] <= self.upper[near][:, None]
            r, s = np.nonzero(asked)
            d = ((x[near[r]] - c[self.next[near[r], s]]) ** 2).sum(1)
            used += len(r)
            exact = np.full((len(near), stored + 1), np.iinfo(np.int64).max)
            exact[:, 0] = ((x[near] - c[self.own[near]]) ** 2).sum(1)
            exact[r, s + 1] = d
            who = np.concatenate([self.own[near][:, None], self.next[near]], axis=1)
            bound = np.concatenate([self.upper[near][:, None], self.lower[near]], axis=1)
            bound[r, s + 1] = np.sqrt(d.astype(np.float64)) * (1 - SLACK)
            bound[:, 0] = np.sqrt(exact[:, 0].astype(np.float64)) * (1 - SLACK)
            best = np.lexsort((who, exact), axis=1)[:, 0]
            rows = np.arange(len(near))
            self.own[near], self.upper[near] = who[rows, best], np.sqrt(exact[rows, best].astype(np.float64)) * (1 + SLACK)
            others = np.ones(who.shape, bool)
            others[rows, best] = False
            who, bound = who[others].reshape(-1, stored), bound[others].reshape(-1, stored)
            order = np.argsort(bound, axis=1, kind="stable")
            self.next[near], self.lower[near] = np.take_along_axis(who, order, 1), np.take_along_axis(bound, order, 1)
            deepest = int(asked.sum(axis=1).max())
        if len(full):
            self.scan(full, x, c)
            used += len(full) * len(c)
        elif deepest + 1 < stored and not fresh.any():  # fewer bounds would have done
            keep = max(deepest + 1, len(c) // 8, 1)
            if keep < stored:
                self.rest = np.minimum(self.rest, self.lower[:, keep:].min(axis=1))
                self.next, self.lower = self.next[:, :keep], self.lower[:, :keep]
        return used, len(near), len(full)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (ids, v) of at most BLOCK_ROWS vectors each: both as bytes of 64-bit integers, and which ids are null."""
    held, n = [], 0

    def out(rows: pa.Table) -> pa.RecordBatch:
        x, ids = matrix(rows["v"], np.int64), rows["id"].combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.RecordBatch.from_pydict({"ids": [values.tobytes()], "known": [known.tobytes()], "v": [np.ascontiguousarray(x).tobytes()]})

    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        while n >= BLOCK_ROWS:
            rows = pa.Table.from_batches(held)
            yield out(rows.slice(0, BLOCK_ROWS))
            held = rows.slice(BLOCK_ROWS).to_batches()
            n -= BLOCK_ROWS
    if n:
        yield out(pa.Table.from_batches(held))


def _vectors(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(-1, d)


def _step(c: np.ndarray, moved: np.ndarray, stored: int):
    """Rows (block, state, change, cost): the block's new bounds, what its rows add to the sums and counts of centroids, and how many distances were computed."""
    k, d = c.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, changes, costs = [], [], []
            for raw, old in zip(batch["v"], batch["state"] if "state" in batch.schema.names else [None] * len(batch)):
                x = _vectors(raw.as_py(), d)
                bounds = Bounds(len(x), k, min(stored, k - 1)) if old is None else Bounds.unpack(old.as_py())
                before = bounds.own.copy()
                costs.append(bounds.update(x, c, moved)[0])
                change = np.zeros((k, d + 1), np.int64)
                for rows, to, sign in ((before != bounds.own, bounds.own, 1), ((before != bounds.own) & (before >= 0), before, -1)):
                    for j in np.unique(to[rows]):
                        own = rows & (to == j)
                        change[j, :d] += sign * x[own].sum(0)
                        change[j, d] += sign * own.sum()
                states.append(bounds.pack())
                changes.append(change.ravel())
            yield pa.RecordBatch.from_pydict({"block": batch["block"], "state": pa.array(states, pa.binary()), "change": pa.array(changes, pa.list_(pa.int64())), "cost": pa.array(costs, pa.int64())})

    return run


def _spread(c: np.ndarray):
    """Rows (vec_id, cluster, distance) of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, known, raw, state in zip(*(batch[x] for x in ("ids", "known", "v", "state"))):
                x, own = _vectors(raw.as_py(), c.shape[1]), Bounds.unpack(state.as_py()).own
                there = np.frombuffer(known.as_py(), bool)
                distance = ((x - c[own]) ** 2).sum(1)
                yield pa.RecordBatch.from_pydict({"vec_id": pa.array(np.frombuffer(ids.as_py(), np.int64), mask=~there), "cluster": pa.array(own, pa.int32()), "distance": pa.array(distance, pa.int64())})

    return run


def _sums(state: DataFrame, width: int) -> np.ndarray:
    """The sum of all blocks' changes, exactly, as Python integers."""
    rows = state.select(F.posexplode("change").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = np.zeros(width, object)
    for r in rows:
        out[r["i"]] = int(r["x"])
    return out


def cluster_vectors(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimensions: int = 64,
    salt: str = "3:",
    scale: float = 1024.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    stored: int | None = None,
    report: list | None = None,
) -> DataFrame:
    """`rounds` rounds of assigning integer vectors to the nearest of k centroids and moving these to the floors of their means.

    Kept are vectors of exactly `dimensions` components, none null or non-finite; a component becomes floor(scale * x).
    Centroids start as the k kept vectors whose salted ids have the smallest sha256, in that order (a vector
    without an id is never one; of equal ids the smaller vector comes first; fewer vectors give fewer centroids, and none
    give no rows). Ties go to the smaller number; an empty centroid stays where it is. After the last round vectors
    are assigned once more. Squared distances must fit 64 bits.

    Out, for each kept row, repeated and null ids included: vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256 (of the components joined by commas). Other columns of df don't matter. `stored` bounds are kept
    for each vector at first (half of k by default); `report`, if given, gets the number of distances computed in each round.
    """
    spark = df.sparkSession
    ship(spark)
    vector = F.transform(vector_column, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    kept = df.filter(usable(vector_column, False) & (F.size(vector_column) == dimensions)).select(F.col(id_column).cast("long").alias("id"), vector.alias("v"))
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = kept.filter("id is not null").orderBy(key, "id", "v").limit(k).select("v").collect()
    c = np.array([r["v"] for r in first], np.int64).reshape(-1, dimensions)
    out = "vec_id long, cluster int, distance long"
    if not len(c):
        empty = spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    k, stored = len(c), (len(c) + 1) // 2 if stored is None else stored
    blocks = kept.mapInArrow(_blocks, "ids binary, known binary, v binary").withColumn("block", F.monotonically_increasing_id())
    data, buckets = settled_buckets(blocks, "block", BUCKET_BLOCKS)
    state, sums, moved, schema = None, np.zeros(k * (dimensions + 1), object), np.zeros(k), "block long, state binary, change array<long>, cost long"
    for t in range(rounds + 1):
        rows = data.select("block", "v") if state is None else data.select("block", "v").join(state.select("block", "state"), "block")
        old, (state, _) = state, settled_buckets(rows.mapInArrow(_step(c, moved, stored), schema), "block", BUCKET_BLOCKS, buckets)
        if old is not None:
            superseded(old)
        if report is not None:
            report.append(state.agg(F.sum("cost")).first()[0])
        if t == rounds:
            break
        sums += _sums(state, k * (dimensions + 1))
        table, last = sums.reshape(k, dimensions + 1), c
        c = np.array([[int(s) // int(row[-1]) for s in row[:-1]] if row[-1] else old_row for row, old_row in zip(table, last.tolist())], np.int64)
        moved = np.sqrt(((c - last).astype(np.float64) ** 2).sum(1))
    found = data.join(state.select("block", "state"), "block").mapInArrow(_spread(c), out)
    costs = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    of = lambda values, kind: F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster") + 1)
    hashes = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    extra: dict[str, Column] = {
        "cluster_inertia": of([costs.get(i, 0) for i in range(k)], "long"),
        "inertia": F.lit(sum(costs.values())).cast("long"),
        "centroid_sha256": of(hashes, "string"),
    }
    return found.withColumns(extra)
