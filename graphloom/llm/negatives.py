"""Hard negatives of anchors among all rows, by a full sort of each anchor's integer scores.

Anchors meet all rows, in blocks of both. Within a block the scores of an anchor are sorted by (score, id); each
positive's upper limit is found by binary search, and entries of another label are read from there down to its lower
limit. The blocks' entries are merged in the same order. A bounded opening of rows, sorted in the same way first,
shows each positive how good its last entry must be at least, so that blocks hand on little.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.runtime import matrix, numbers, saved, ship
from graphloom.llm.vectors import usable

#: Rows of a block, anchors that a block meets at once, and anchors that are scored at once.
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 4096
AT_ONCE = 128
#: Rows of the opening, at most.
OPENING = 2048
_LEAST = -(1 << 63)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, which must fit 64 bits."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def limits(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest integers s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def first_positives(scores: np.ndarray, own: np.ndarray, take: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the `take` best rows of each anchor where `own` holds and its floor is reached; rows stand in the order of ids."""
    who, rows = [], []
    for a in range(len(scores)):
        at = np.flatnonzero(own[a] & (scores[a] >= floors[a]))
        best = at[np.lexsort((at, -scores[a, at]))[:take]]
        who.append(np.full(len(best), a))
        rows.append(best)
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, rows))


def next_below(scores: np.ndarray, rows: np.ndarray, upper: np.ndarray, lower: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """(positive, row) of the first `take` of an anchor's rows with lower <= score <= upper, for each of its positives.

    rows are those of another label, in the order of ids: one full sort serves all positives.
    """
    order = rows[np.lexsort((rows, -scores[rows]))]
    falling = -scores[order]
    first = np.searchsorted(falling, -upper, "left")
    end = np.minimum(np.maximum(np.searchsorted(falling, -lower, "right"), first), first + take)
    count = end - first
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    return np.repeat(np.arange(len(upper)), count), order[at]


def _floors(opening: np.ndarray, labels: np.ndarray, ids: np.ndarray, take: int):
    """Adds floor: the score of the take-th best row of the anchor's label in the opening, as none of its positives has less."""

    def run(batches):
        for batch in batches:
            q, floors = matrix(batch["v"], np.int64), np.full(len(batch), _LEAST)
            for a in range(len(q) if len(opening) else 0):
                own = (labels == batch["label"][a].as_py()) & (ids != batch["id"][a].as_py())
                if own.sum() >= take:
                    floors[a] = -np.partition(-products(q[a : a + 1], opening[own])[0], take - 1)[take - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors)], [*batch.schema.names, "floor"])

    return run


def _positives(take: int):
    """Rows (anchor, positive_id, positive_score) of the best of a block's rows for each anchor."""

    def run(key, anchors: pa.Table, data: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor", "positive_id", "positive_score")}
        if anchors.num_rows and data.num_rows:
            ids = numbers(data["id"])
            order = np.argsort(ids, kind="stable")
            ids, labels, x = ids[order], numbers(data["label"])[order], matrix(data["v"], np.int64)[order]
            q, own, who, floors = matrix(anchors["v"], np.int64), numbers(anchors["label"]), numbers(anchors["id"]), numbers(anchors["floor"])
            for lo in range(0, len(q), AT_ONCE):
                part = slice(lo, lo + AT_ONCE)
                scores = products(q[part], x)
                a, r = first_positives(scores, (own[part, None] == labels) & (who[part, None] != ids), take, floors[part])
                for name, column in zip(out, (numbers(anchors["anchor"])[part][a], ids[r], scores[a, r])):
                    out[name].append(column)
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    return run


def _wanted(opening: np.ndarray, labels: np.ndarray, take: int, low: int, high: int):
    """Adds to each anchor's positives their limits, the lower one raised to the take-th best entry of the opening."""

    def run(batches):
        for batch in batches:
            q, columns = matrix(batch["v"], np.int64), ([], [])
            for a, scores in enumerate(batch["scores"]):
                lower, upper = limits(np.array(scores.as_py(), np.int64), low, high)
                rows = np.flatnonzero(labels != batch["label"][a].as_py())
                if len(rows):
                    s = products(q[a : a + 1], opening)[0]
                    p, r = next_below(s, rows, upper, lower, take)
                    full = np.bincount(p, minlength=len(upper)) == take
                    worst = np.full(len(upper), np.iinfo(np.int64).max)
                    np.minimum.at(worst, p, s[r])
                    lower = np.where(full, worst, lower)
                columns[0].append(lower)
                columns[1].append(upper)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.list_(pa.int64())) for c in columns)], [*batch.schema.names, "lower", "upper"])

    return run


def _negatives(take: int):
    """Rows (anchor, positive, negative_id, negative_score): the first entries of a block for each positive."""

    def run(key, anchors: pa.Table, data: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor", "positive", "negative_id", "negative_score")}
        if anchors.num_rows and data.num_rows:
            ids = numbers(data["id"])
            order = np.argsort(ids, kind="stable")
            ids, labels, x = ids[order], numbers(data["label"])[order], matrix(data["v"], np.int64)[order]
            q, own, names = matrix(anchors["v"], np.int64), numbers(anchors["label"]), numbers(anchors["anchor"])
            lower, upper = anchors["lower"].to_pylist(), anchors["upper"].to_pylist()
            for lo in range(0, len(q), AT_ONCE):
                scores = products(q[lo : lo + AT_ONCE], x)
                for a in range(lo, min(lo + AT_ONCE, len(q))):
                    s, low, high = scores[a - lo], np.array(lower[a], np.int64), np.array(upper[a], np.int64)
                    rows = np.flatnonzero((labels != own[a]) & (s >= low.min(initial=0)) & (s <= high.max(initial=0)))
                    p, r = next_below(s, rows, high, low, take)
                    for name, column in zip(out, (np.full(len(p), names[a]), p, ids[r], s[r])):
                        out[name].append(column)
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    return run


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    positives: int = 5,
    k: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """For each anchor and each of its positives, the first k rows of another label whose score lies between low % and high % of the positive's.

    A component becomes floor(scale * x), a score is the integer inner product with the anchor; higher scores come first,
    ties go to the smaller id. An anchor's positives are its first `positives` rows of the same label and another id (all, if
    fewer). anchor: a condition on df's rows; label: the label (column `label` by default).

    Out: anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score. Rows with a null id or label, a
    vector that is null, empty, of another length than most, or not finite throughout take no part. Rows that repeat an id with the
    same vector and label count once. An id with several vectors or labels gives as many anchors, none of which is another's positive. A
    positive whose score is negative has no negatives. An empty table gives no rows. Scores must fit 64 bits; other columns don't matter.
    """
    spark = df.sparkSession
    ship(spark)
    label = F.col("label") if label is None else label
    scaled = F.when(usable(vector_column, False), F.transform(vector_column, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long")))
    rows = df.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("v"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = rows.filter("id is not null and label is not null and v is not null")
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = length["d"] if length else 1
    # a vector that very many rows of a label share: only its smallest ids can be among the first
    hashed = rows.filter(F.size("v") == d).withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), "v")})
    once = hashed.groupBy("h", "g", "label", "id").agg(F.first("v").alias("v"), F.max("asks").alias("asks"))
    order = Window.partitionBy("h", "g", "label").orderBy("id")
    few = once.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= max(positives + 1, k)).select("id", "label", "v", "h", "g")
    data = saved(few)
    asked = once.filter("asks").select("id", "label", "v", "h", "g")
    asked = saved(asked.withColumn("anchor", F.xxhash64("h", "g", "label", "id")))
    opening = data.orderBy("h", "g", "id").limit(OPENING).select("id", "label", "v").collect()
    sample = np.array([r["v"] for r in opening], np.int64).reshape(-1, d)
    labels, ids = (np.array([r[c] for r in opening], np.int64) for c in ("label", "id"))
    blocks = max(32, -(-data.count() // BLOCK_ROWS))
    sides = max(1, -(-asked.count() // BLOCK_ANCHORS))
    place = lambda n: F.pmod(F.xxhash64("h", "id", "label"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    filed = data.select("id", "label", "v", place(blocks).alias("block"), every(sides).alias("side")).groupBy("block", "side")

    def met(anchors: DataFrame, run, schema: str) -> DataFrame:
        dealt = anchors.withColumn("side", place(sides)).withColumn("block", every(blocks)).drop("h", "g")
        return dealt.groupBy("block", "side").cogroup(filed).applyInArrow(run, schema)

    base = "id long, label long, v array<long>, h long, g long, anchor long"
    floored = asked.mapInArrow(_floors(sample, labels, ids, positives), base + ", floor long")
    best = met(floored, _positives(positives), "anchor long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    best = best.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= positives)
    # at most `positives` of each anchor, in their order
    lists = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("n", "positive_id", "positive_score"))).alias("p"))
    pairs = asked.join(lists, "anchor").select("id", "label", "v", "h", "g", "anchor", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("scores"))
    pairs = saved(pairs)
    limited = pairs.select("id", "label", "v", "h", "g", "anchor", "scores").mapInArrow(_wanted(sample, labels, k, low, high), base + ", scores array<long>, lower array<long>, upper array<long>")
    found = met(limited.drop("scores"), _negatives(k), "anchor long, positive long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = pairs.select("anchor", F.col("id").alias("anchor_id"), F.posexplode(F.arrays_zip("ids", "scores")).alias("positive", "p"))
    named = named.select("anchor", F.col("positive").cast("long").alias("positive"), "anchor_id", F.col("p.ids").alias("positive_id"), F.col("p.scores").alias("positive_score"))
    return found.join(named, ["anchor", "positive"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
