"""Nearest-neighbour search over vectors: cross-polytope hashing, and exact pivot elimination.

Rows that hold the same vector form a class; the search runs over classes, of each of which
only the k + 1 smallest ids can ever be among k results, so a vector that a third of all rows
share costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.runtime import matrix, numbers, ragged, saved, ship
from graphloom.llm.words import constants

#: Classes in a block, and queries that a block meets at once.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 2048
#: Classes of which a query learns a floor, and pairs that are scored at once.
OPENING = 2048
PAIRS = 1 << 16
#: Tables that are searched before the others, which take the floor that these give.
FIRST_TABLES = 2
#: The share of classes, the longest, that every query meets where norms differ.
HEAVY = 1 / 32


def usable(vector: str, nonzero: bool) -> Column:
    """Not null, not empty, and every component is a finite number; with nonzero, one isn't 0."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = c.isNotNull() & (F.size(c) > 0) & finite
    return held & F.exists(c, lambda x: x != 0) if nonzero else held


def commonest_length(df: DataFrame) -> int:
    """The length that most vectors have (ties: the smaller); 0 for an empty table."""
    row = df.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else 0


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """The k + 1 smallest ids of each class; WindowGroupLimit keeps as many in each task before the shuffle."""
    order = Window.partitionBy("h", "g").orderBy("id")
    return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)


def _keyed(df: DataFrame, id_column: str, vector: Column, nonzero: bool) -> DataFrame:
    rows = df.select(F.col(id_column).cast("long").alias("id"), vector.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable("v", nonzero))
    return rows.withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), "v")})


def _ranked(found: DataFrame, members: DataFrame, queries: DataFrame, k: int, score: str) -> DataFrame:
    """Each query's k best rows, from its class's best classes: (qh, qg, h, g, first, score)."""
    best = Window.partitionBy("qh", "qg").orderBy(F.desc("score"), "first")
    classes = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n", "first")
    rows = classes.join(members.select("h", "g", "id"), ["h", "g"])
    order = Window.partitionBy("qh", "qg").orderBy(F.desc("score"), "id")
    rows = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).select("qh", "qg", "id", "score")
    asked = queries.select(F.col("id").alias("query_id"), F.col("h").alias("qh"), F.col("g").alias("qg"))
    pairs = asked.join(rows, ["qh", "qg"]).filter("query_id <> id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        pairs.withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), F.col("score").cast(score).alias("score"))
    )


# -- cross-polytope hashing ------------------------------------------------------------------


def hadamard(a: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths; three levels of it a step."""
    n, d = a.shape
    h = 1
    while h < d:
        r = np.arange(min(8, d // h))
        step = 1.0 - 2 * (np.bitwise_count(r[:, None] & r) & 1)
        a = a.reshape(-1, len(r)) @ step if h == 1 else np.matmul(step, a.reshape(-1, len(r), h))
        h *= len(r)
    return a.reshape(n, d) / np.sqrt(d)


def rotated(unit: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The table's pseudo-rotation: three times random signs, then Hadamard."""
    d = unit.shape[1]
    signs = np.where(constants(3 * d, seed * 1009 + table + 1) >> np.uint64(40) & np.uint64(1), 1.0, -1.0).reshape(3, d)
    for s in signs:
        unit = hadamard(unit * s)
    return unit


def _padded(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, with zeros up to a power of two."""
    d = vectors.shape[1]
    unit = np.zeros((len(vectors), 1 << max(1, (d - 1).bit_length())))
    unit[:, :d] = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    return unit


def best_cells(first: np.ndarray, second: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The `probes` cells (axis of the first rotation, axis of the second) with the largest sums, for each row.

    The cell of the i-th best first and the j-th best second axis has i * j - 1 cells before it, so only
    cells with i * j <= probes are looked at.
    """
    n, axes = first.shape
    take = min(probes, axes * axes)
    i = np.repeat(np.arange(axes), [min(axes, take // (i + 1)) for i in range(axes)])
    j = np.arange(len(i)) - np.searchsorted(i, i)
    a, b = np.argsort(-first, axis=1, kind="stable"), np.argsort(-second, axis=1, kind="stable")
    sums = np.take_along_axis(first, a, 1)[:, i] + np.take_along_axis(second, b, 1)[:, j]
    best = np.argpartition(-sums, take - 1, axis=1)[:, :take] if take < len(i) else np.tile(np.arange(len(i)), (n, 1))
    return np.take_along_axis(a, i[best], 1), np.take_along_axis(b, j[best], 1)


def _axes(unit: np.ndarray, rotation: int, seed: int) -> np.ndarray:
    """The inner products with the signed axes of a rotation."""
    y = rotated(unit, rotation, seed)
    return np.concatenate([y, -y], axis=1)


def _filed(tables: range, seed: int, heavy: float):
    """Rows (cell, code, h, g, id, v): the nearest signed axis of both rotations of each table, the first as the cell.

    What is longer than `heavy` stands in cell -1 instead, which goes with table 0.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = matrix(batch["v"], np.float64)
            long = np.linalg.norm(vectors, axis=1) > heavy
            light = np.flatnonzero(~long)
            unit = _padded(vectors[light])
            axes = 2 * unit.shape[1]
            groups = [(np.flatnonzero(long), np.full(long.sum(), -1), np.zeros(long.sum(), np.int64))] if 0 in tables else []
            for table in tables:
                cell, code = (_axes(unit, 2 * table + i, seed).argmax(axis=1) for i in range(2))
                groups.append((light, table * axes + cell, code))
            for who, cell, code in groups:
                rows, cell, code = pa.array(who), pa.array(cell.astype(np.int32)), pa.array(code.astype(np.int32))
                yield pa.RecordBatch.from_arrays([cell, code, *(batch[c].take(rows) for c in ("h", "g", "id", "v"))], ["cell", "code", "h", "g", "id", "v"])

    return assign


def _floors(scores: np.ndarray, met: np.ndarray, k: int, slack: np.ndarray) -> np.ndarray:
    """The (k + 1)-th best score of each row among what it meets, less slack for rounding; without as many, -inf."""
    if scores.shape[1] <= k:
        return np.full(len(scores), -np.inf)
    return -np.partition(-np.where(met, scores, -np.inf), k, axis=1)[:, k] - slack


def _probed(tables: int, probes: int, seed: int, heavy: float, k: int, opening: np.ndarray, which: range):
    """Rows (cell, codes, h, g, v, floor): what a query looks at, by the first axis of its best cells of those tables in `which`.

    The floor is the (k + 1)-th best score among those classes of the opening that the query's cells hold, or the given one
    where that is higher: whatever of all cells scores less is not among its k + 1 best finds, so it needn't be handed on.
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = np.linalg.norm(opening, axis=1)
        light = np.flatnonzero(norms <= heavy)
        homes = {}  # of each table: the cells of the opening, and which of them each class is in
        for table in which if len(light) else ():
            first, second = (_axes(_padded(opening[light]), 2 * table + i, seed) for i in range(2))
            homes[table] = np.unique(first.argmax(axis=1) * first.shape[1] + second.argmax(axis=1), return_inverse=True)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                vectors = matrix(part["v"], np.float64)
                unit = _padded(vectors)
                n, axes = len(part), 2 * unit.shape[1]
                met = np.tile(norms > heavy, (n, 1))
                groups = [(np.arange(n), np.full(n, -1), np.ones(n, np.int64), np.zeros(n, np.int64))] if 0 in which else []
                for table in which:
                    a, b = best_cells(*(_axes(unit, 2 * table + i, seed) for i in range(2)), probes)
                    keys = (np.arange(n)[:, None] * axes + a).ravel()
                    order = np.argsort(keys, kind="stable")
                    keys, counts = np.unique(keys, return_counts=True)
                    groups.append((keys // axes, table * axes + keys % axes, counts, b.ravel()[order]))
                    if homes:
                        home, own = homes[table]
                        cells = a * axes + b
                        place = np.minimum(np.searchsorted(home, cells), len(home) - 1)
                        asker, probe = np.nonzero(home[place] == cells)
                        hit = np.zeros((n, len(home)), bool)
                        hit[asker, place[asker, probe]] = True
                        met[:, light] |= hit[:, own]
                slack = 1e-9 * np.linalg.norm(vectors, axis=1) * norms.max(initial=0)
                floor = pa.array(np.maximum(_floors(vectors @ opening.T, met, k, slack), numbers(part["floor"])), pa.float64())
                for who, cell, counts, codes in groups:
                    rows, lists = pa.array(who), ragged(counts, codes.astype(np.int32), pa.int32())
                    columns = [pa.array(cell.astype(np.int32)), lists, *(part[c].take(rows) for c in ("h", "g", "v")), floor.take(rows)]
                    yield pa.RecordBatch.from_arrays(columns, ["cell", "codes", "h", "g", "v", "floor"])

    return assign


def _score_cell(k: int):
    """The k + 1 best classes of a block for each query, among those whose code it probes and that reach its floor."""

    def score(key, queries: pa.Table, data: pa.Table) -> pa.Table:
        out = {c: [] for c in ("qh", "qg", "h", "g", "first", "score")}
        if queries.num_rows and data.num_rows:
            q, x = matrix(queries["v"], np.float64), matrix(data["v"], np.float64)
            ids, h, g, code = (numbers(data[c]) for c in ("id", "h", "g", "code"))
            order = np.argsort(code, kind="stable")
            x, ids, h, g, code = x[order], ids[order], h[order], g[order], code[order]
            heads = np.append(np.flatnonzero(np.diff(code, prepend=-1)), len(code))
            place = np.full(int(code[-1]) + 2, -1)
            place[code[heads[:-1]]] = np.arange(len(heads) - 1)
            qh, qg, floor, lists = numbers(queries["h"]), numbers(queries["g"]), numbers(queries["floor"]), queries["codes"].combine_chunks()
            asker = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
            asked = place[np.minimum(numbers(lists.flatten()), len(place) - 1)]
            asker, asked = asker[asked >= 0], asked[asked >= 0]
            start, many = heads[asked], heads[asked + 1] - heads[asked]
            runs = np.searchsorted(asker, np.arange(len(q) + 1))
            total = np.append(0, np.cumsum(many))[runs]  # pairs of all queries before each
            at = 0
            while at < len(q):  # so many queries at once that their pairs fit
                end = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
                part = slice(runs[at], runs[end])
                who = np.repeat(asker[part], many[part])
                cols = np.arange(len(who)) + np.repeat(start[part] - np.cumsum(many[part]) + many[part], many[part])
                values = np.einsum("id,id->i", q[who], x[cols])
                reach = np.flatnonzero(~(values < floor[who]))
                who, cols, values = who[reach], cols[reach], values[reach]
                order = np.lexsort((ids[cols], -values, who))
                who, cols, values = who[order], cols[order], values[order]
                keep = np.arange(len(who)) - np.searchsorted(who, who) <= k
                who, cols, values = who[keep], cols[keep], values[keep]
                for name, column in zip(out, (qh[who], qg[who], h[cols], g[cols], ids[cols], values)):
                    out[name].append(column)
                at = end
        kinds = [pa.int64()] * 5 + [pa.float64()]
        return pa.table({c: pa.array(np.concatenate(v) if v else [], t) for (c, v), t in zip(out.items(), kinds)})

    return score


def cross_polytope_search(
    df: DataFrame,
    query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    tables: int = 16,
    probes: int = 448,
    seed: int = 11,
) -> DataFrame:
    """The k nearest rows of each query row by inner product, found through cross-polytope hash tables.

    A table turns unit vectors with two fast pseudo-rotations and files each under the nearest signed axis
    of both, so that 64 dimensions give 128 * 128 cells. A query probes the `probes` cells of each table with
    the largest sums of its inner products with the two axes, and the classes found are scored exactly.
    Tables, probes and cells don't depend on the number of rows. Where vectors differ in norm, the
    longest of them, a share of HEAVY, are scored against every query; the others are filed by direction. A
    query that finds fewer than k rows, of more in the table, meets all. What shares a first axis is
    scored together, in blocks of BLOCK_ROWS classes by BLOCK_QUERIES queries. The OPENING classes with the
    smallest hashes are sent out; those that a query's own cells hold give it a floor, below which nothing
    is handed on; what the first FIRST_TABLES tables give raises it for the others. That changes no result, and adds no candidate.

    query: a condition on df's rows. Out: query_id, rank from 1, vec_id, score. Ties go to the
    smaller id. Rows with a null id, or a vector that is null, empty, zero, of another length than
    most, or not finite throughout, take no part; equal vectors are all returned; an empty table
    gives no rows. Other columns of df don't matter.
    """
    spark = df.sparkSession
    ship(spark)
    rows = _keyed(df, id_column, F.col(vector_column), True)
    asked = _keyed(df.filter(query), id_column, F.col(vector_column), True)
    d = commonest_length(rows)
    rows, asked = (x.filter(F.size("v") == d) for x in (rows, asked))
    members = saved(_classes(rows, k))
    data = members.filter("n = 1").drop("n")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    cut = F.percentile_approx(norm, 1 - HEAVY, 10_000)
    n, low, high, cut = data.agg(F.count("*"), F.min(norm), F.max(norm), cut).first()
    heavy = float(cut) if n and high - low > 1e-4 * high else float("inf")
    kind = dict(rows.dtypes)["v"]
    wanted = asked.groupBy("h", "g").agg(F.first("v").alias("v"))
    opening = np.array([r["v"] for r in data.orderBy("h", "g").limit(OPENING).select("v").collect()], np.float64).reshape(-1, max(d, 1))

    def found_by(wanted: DataFrame, tables: int, probes: int, which: range) -> DataFrame:
        filed = data.select("h", "g", "id", "v").mapInArrow(_filed(which, seed, heavy), f"cell int, code int, h long, g long, id long, v {kind}")
        wanted = saved(wanted.select("h", "g", "v", "floor").mapInArrow(_probed(tables, probes, seed, heavy, k, opening, which), f"cell int, codes array<int>, h long, g long, v {kind}, floor double"))
        # tables * axes + 1 rows at most, whatever the size of df
        sizes = filed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
        askers = wanted.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("sides"))
        sizes = F.broadcast(sizes.join(askers, "cell"))
        own = lambda n: F.pmod("h", F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        filed = filed.join(sizes, "cell").withColumn("part", own("parts")).withColumn("side", every("sides")).drop("parts", "sides")
        wanted = wanted.join(sizes, "cell").withColumn("side", own("sides")).withColumn("part", every("parts")).drop("parts", "sides")
        found = wanted.groupBy("cell", "part", "side").cogroup(filed.groupBy("cell", "part", "side"))
        return found.applyInArrow(_score_cell(k), "qh long, qg long, h long, g long, first long, score double")

    # the first tables hold a share of all classes, so what they give raises the floor of the others as the table grows
    wanted = wanted.withColumn("floor", F.lit(float("-inf")))
    found = saved(found_by(wanted, tables, probes, range(min(tables, FIRST_TABLES))))
    if tables > FIRST_TABLES:
        distinct = found.groupBy("qh", "qg", "h", "g").agg(F.max("score").alias("score"))
        place = F.row_number().over(Window.partitionBy("qh", "qg").orderBy(F.desc("score")))
        floors = distinct.withColumn("n", place).filter(F.col("n") == k + 1).select(F.col("qh").alias("h"), F.col("qg").alias("g"), (F.col("score") - F.abs("score") * 1e-9).alias("least"))
        raised = wanted.drop("floor").join(floors, ["h", "g"], "left").select("h", "g", "v", F.coalesce("least", F.lit(float("-inf"))).alias("floor"))
        found = saved(found.unionByName(found_by(raised, tables, probes, range(FIRST_TABLES, tables))))
    enough = found.select("qh", "qg", "h", "g").distinct().groupBy("qh", "qg").count().filter(F.col("count") >= min(k + 1, n))
    short = saved(wanted.join(enough.select(F.col("qh").alias("h"), F.col("qg").alias("g")), ["h", "g"], "left_anti").select("h", "g", "v", "floor"))
    if not short.isEmpty():
        found = found.unionByName(found_by(short, 1, 1 << 62, range(1)))
    # the same class found through several tables has one score
    found = found.groupBy("qh", "qg", "h", "g", "first").agg(F.max("score").alias("score"))
    return _ranked(found, members, asked, k, "double")


# -- exact search by pivot elimination ---------------------------------------------------------


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    xf, p = x.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum(0, (xf * xf).sum(1)[:, None] + (p * p).sum(1) - 2 * xf @ p.T))


class Block:
    """Classes and their pivot table, from which queries are answered in the order of bounds."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, pivots: np.ndarray) -> None:
        self.x, self.ids, self.pivots = x, ids, pivots
        self.table = distances(x, pivots)
        xf = x.astype(np.float64)
        self.squares = (xf * xf).sum(1)
        self.largest = float(np.abs(xf).max(initial=0))

    def best(self, q: np.ndarray, take: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(scores, rows, evaluations) of up to `take` rows with the largest inner products, ties to the smaller id, of those that reach floor."""
        x, exact = self.x, np.float64 if float(np.abs(q).max(initial=0)) * self.largest * len(q) < 2**52 else np.int64
        qf = q.astype(np.float64)
        q2 = float(qf @ qf)
        apart = np.abs(self.table - distances(q[None], self.pivots)).max(1) if len(self.pivots) else np.zeros(len(x))
        near = np.maximum(0, apart - 1e-6 * (np.sqrt(self.squares) + np.sqrt(q2) + 1))  # less the rounding of the distances
        bound = (q2 + self.squares - near * near) / 2 * (1 + 1e-12) + 1
        order = np.flatnonzero(bound >= floor)
        order = order[np.argsort(-bound[order], kind="stable")]
        best, who, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, max(64, 4 * take)
        while at < len(order) and (len(best) < take or bound[order[at]] >= best[take - 1]):
            rows = order[at : at + step]
            scores = (x[rows].astype(exact) @ q.astype(exact)).astype(np.int64)
            best, who = np.concatenate([best, scores]), np.concatenate([who, rows])
            first = np.lexsort((self.ids[who], -best))[:take]
            best, who, at, step = best[first], who[first], at + len(rows), step * 2
        some = best >= floor
        return best[some], who[some], at


def _opened(k: int, opening: np.ndarray, pivots: np.ndarray):
    """Adds floor: what the (k + 1)-th best class of the opening scores, as no worse class can be among the results."""
    least = -(1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(opening, np.arange(len(opening)), pivots)
        for batch in batches:
            floors = []
            for q in matrix(batch["v"], np.int64):
                best = block.best(q, k + 1, least)[0]
                floors.append(int(best[k]) if len(best) > k else least)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.int64())], [*batch.schema.names, "floor"])

    return run


def _eliminate(k: int, pivots: np.ndarray):
    """The k + 1 best classes of a block for each query, of those that reach its floor."""

    def run(key, queries: pa.Table, data: pa.Table) -> pa.Table:
        out = {c: [] for c in ("qh", "qg", "h", "g", "first", "score")}
        if queries.num_rows and data.num_rows:
            ids, h, g = (numbers(data[c]) for c in ("id", "h", "g"))
            block = Block(matrix(data["v"], np.int64), ids, pivots)
            for q, qh, qg, floor in zip(matrix(queries["v"], np.int64), *(numbers(queries[c]).tolist() for c in ("h", "g", "floor"))):
                best, who, _ = block.best(q, k + 1, floor)
                for name, part in zip(out, (np.full(len(who), qh), np.full(len(who), qg), h[who], g[who], ids[who], best)):
                    out[name].append(part)
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    return run


def pivot_topk(
    df: DataFrame,
    query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 1024.0,
    pivots: int = 64,
    opening: int = 2048,
) -> DataFrame:
    """The k rows with the largest integer inner product for each query row, exactly.

    Components become floor(scale * x). Distances to the pivots (`pivots` classes with the
    smallest hashes) bound each class's distance to a query from below, hence its inner product from above; a
    block's classes are evaluated from the largest bound on, until the next bound is below the k-th
    best score. Each query first meets the `opening` classes with the smallest hashes, and what
    doesn't reach the k-th best of these is never evaluated. The query set then meets all rows, in
    blocks of about BLOCK_QUERIES queries by BLOCK_ROWS classes, and the blocks' best are merged.
    Pivots and opening are parameters, so what the driver sends out is bounded.

    query: a condition on df's rows. Out: query_id, rank from 1, vec_id, score. Ties go to the
    smaller id. Rows with a null id, or a vector that is null, empty, of another length than most,
    or not finite throughout, take no part; zero vectors do. An empty table gives no rows. Scores
    must fit 64 bits.
    """
    spark = df.sparkSession
    ship(spark)
    scaled = F.when(usable(vector_column, False), F.transform(vector_column, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double")))
    rows = _keyed(df, id_column, scaled, False)
    asked = _keyed(df.filter(query), id_column, scaled, False)
    d = commonest_length(rows)
    rows, asked = (x.filter(F.size("v") == d).withColumn("v", F.transform("v", lambda y: y.cast("long"))) for x in (rows, asked))
    members = saved(_classes(rows, k))
    data = members.filter("n = 1").drop("n")
    n = data.count()
    first = data.orderBy("h", "g").limit(max(pivots, opening)).select("v").collect()
    chosen = np.array([r["v"] for r in first], np.int64).reshape(-1, max(d, 1))
    blocks = max(64, -(-n // BLOCK_ROWS))
    wanted = asked.groupBy("h", "g").agg(F.first("v").alias("v")).select("h", "g", "v")
    wanted = saved(wanted.mapInArrow(_opened(k, chosen[:opening], chosen[:pivots]), "h long, g long, v array<long>, floor long"))
    sides = max(1, -(-wanted.count() // BLOCK_QUERIES))
    filed = data.withColumn("block", F.pmod("h", F.lit(blocks)).cast("int")).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    wanted = wanted.withColumn("side", F.pmod("h", F.lit(sides)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = wanted.groupBy("block", "side").cogroup(filed.groupBy("block", "side"))
    found = found.applyInArrow(_eliminate(k, chosen[:pivots]), "qh long, qg long, h long, g long, first long, score long")
    return _ranked(found, members, asked, k, "long")
