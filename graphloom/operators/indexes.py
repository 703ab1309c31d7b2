"""Vector indexes in tables: flat, inverted lists of k-means cells, and product quantisation with an exact rerank.

An index is a table (cell, part, id, vector, codes) in the shared folder, partitioned by nothing but written
in the order of cells, and a few small arrays (centroids, codebooks), which don't grow with the rows. Cells are
searched in parts of at most PART_ROWS rows, so a crowded one is many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.operators.frames import settled, ship_package

#: Rows of a cell, and queries, that one task handles together.
PART_ROWS = 8192
PART_QUERIES = 1024
#: Sums of components are taken of whole numbers of this share of 1, so that no order of rows changes a centroid.
GRAIN = 2.0**-24
KINDS = ("flat", "ivf", "pq", "ivfpq")
METRICS = ("l2", "inner_product")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest row of c for each row of x; ties to the first."""
    return ((c * c).sum(1) - 2 * x @ c.T).argmin(axis=1)


def _summed(bounds: list[int], books: list[np.ndarray]):
    """Rows (book, code, pos, n, s): of each batch and each centroid of each book, how many rows are nearest to it, and the sums of their components in whole GRAINs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["v"])
            for j, book in enumerate(books if len(x) else []):
                part = x[:, bounds[j] : bounds[j + 1]]
                near = _nearest(part, book)
                whole = np.rint(part / GRAIN).astype(np.int64)
                codes, which, count = np.unique(near, return_inverse=True, return_counts=True)
                sums = np.zeros((len(codes), part.shape[1]), np.int64)
                np.add.at(sums, which, whole)
                w = part.shape[1]
                yield pa.RecordBatch.from_pydict({"book": pa.array(np.full(sums.size, j), pa.int32()), "code": pa.array(np.repeat(codes, w), pa.int32()), "pos": pa.array(np.tile(np.arange(w), len(codes)), pa.int32()), "n": pa.array(np.repeat(count, w), pa.int64()), "s": pa.array(sums.ravel(), pa.int64())})

    return run


def fit_centroids(sample: DataFrame, starts: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """k-means of the consecutive stretches of the vectors `v` that the books in `starts` are of, all at once, one pass over the sample a round."""
    bounds = np.cumsum([0, *(b.shape[1] for b in starts)]).tolist()
    books = [b.copy() for b in starts]
    for _ in range(rounds):
        rows = sample.select("v").mapInArrow(_summed(bounds, books), "book int, code int, pos int, n long, s long")
        for r in rows.groupBy("book", "code", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
            books[r["book"]][r["code"], r["pos"]] = int(r["s"]) * GRAIN / r["n"]
    return books


def _assigned(centroids: np.ndarray, bounds: list[int], books: list[np.ndarray]):
    """Adds cell, and codes: of each stretch of what the vector differs from its cell's centroid by, the nearest entry of the codebook."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["v"])
            if not len(x):
                continue
            cell = _nearest(x, centroids)
            rest = x - centroids[cell]
            codes = np.zeros((len(x), len(books)), np.int32)
            for j, book in enumerate(books):
                codes[:, j] = _nearest(rest[:, bounds[j] : bounds[j + 1]], book)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), _lists(codes, pa.int32())], [*batch.schema.names, "cell", "codes"])

    return run


def _residuals(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["v"])
            if len(x):
                yield pa.RecordBatch.from_arrays([_lists(x - centroids[_nearest(x, centroids)], pa.float64())], ["v"])

    return run


def _probing(centroids: np.ndarray, probes: int, metric: str):
    """Rows (query_id, v, cell): the cells that a query looks at, the most promising ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch["v"])
            if not len(q):
                continue
            order = (q @ centroids.T if metric == "inner_product" else 2 * q @ centroids.T - (centroids * centroids).sum(1)).argsort(axis=1, kind="stable")[:, ::-1]
            cells = order[:, :probes]
            rows = pa.array(np.repeat(np.arange(len(q)), cells.shape[1]))
            yield pa.RecordBatch.from_arrays([batch["query_id"].take(rows), batch["v"].take(rows), pa.array(cells.ravel().astype(np.int32))], ["query_id", "v", "cell"])

    return run


def exact_scores(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Distance (l2) or inner product of each pair, each summed up by itself, so that equal vectors score equally wherever they stand."""
    out = np.empty((len(q), len(x)))
    for i, row in enumerate(q):
        out[i] = (x * row).sum(axis=1) if metric == "inner_product" else np.sqrt(((x - row) ** 2).sum(axis=1))
    return out


def _table_scores(q: np.ndarray, centroid: np.ndarray, codes: np.ndarray, bounds: list[int], books: list[np.ndarray], metric: str) -> np.ndarray:
    """What the codes say the scores are: of each query a table of every codebook entry's part, looked up and added up."""
    out = np.zeros((len(q), len(codes)))
    for j, book in enumerate(books):
        part = slice(bounds[j], bounds[j + 1])
        if metric == "inner_product":
            table = q[:, part] @ book.T
        else:
            r = q[:, part] - centroid[part]
            table = (r * r).sum(1)[:, None] + (book * book).sum(1) - 2 * r @ book.T
        out += table[:, codes[:, j]]
    return out + (q @ centroid)[:, None] if metric == "inner_product" else np.sqrt(np.maximum(out, 0))


def _searched(metric: str, take: int, centroids: np.ndarray, bounds: list[int], books: list[np.ndarray]):
    """Rows (query_id, id, score) of the `take` best of a part of a cell for each query; by codes where there are books."""

    def run(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and rows.num_rows:
            q, ids, asked = _matrix(queries["v"]), rows["id"].to_numpy(), queries["query_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            data = (_matrix(rows["codes"]).astype(np.int64) if books else _matrix(rows["v"]))[order]
            for lo in range(0, len(q), 64):
                part = q[lo : lo + 64]
                scores = _table_scores(part, centroids[int(rows["cell"][0].as_py())], data, bounds, books, metric) if books else exact_scores(part, data, metric)
                key_ = -scores if metric == "inner_product" else scores
                best = np.argsort(key_, axis=1, kind="stable")[:, :take]  # ties to the smaller id
                out[0].append(np.repeat(asked[lo : lo + 64], best.shape[1]))
                out[1].append(ids[best].ravel())
                out[2].append(np.take_along_axis(scores, best, 1).ravel())
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(np.concatenate(v) if v else [], t) for c, v, t in zip(("query_id", "id", "score"), out, kinds)})

    return run


def _rescored(metric: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, x = _matrix(batch["q"]), _matrix(batch["v"])
            if len(q):
                scores = (x * q).sum(axis=1) if metric == "inner_product" else np.sqrt(((x - q) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([batch["query_id"], batch["id"], pa.array(scores)], ["query_id", "id", "score"])

    return run


@dataclass
class VectorIndex:
    """A searchable index; rows: (id long, v array, cell int, part int, codes array<int>)."""

    kind: str
    metric: str
    centroids: np.ndarray
    bounds: list[int]
    books: list[np.ndarray]
    rows: DataFrame

    def _filed(self, vectors: DataFrame) -> DataFrame:
        d = self.centroids.shape[1]
        kind = dict(vectors.dtypes)["v"]
        usable = vectors.filter(F.col("id").isNotNull() & (F.size("v") == d) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        return usable.mapInArrow(_assigned(self.centroids, self.bounds, self.books), f"id long, v {kind}, cell int, codes array<int>")

    def add(self, vectors: DataFrame, key: str, vector: str) -> VectorIndex:
        """With more rows, which are filed under the cells that are there; rows of ids that the index has take their place."""
        ship_package(vectors.sparkSession)
        more = settled(self._filed(vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))))
        old = self.rows.select("id", "v", "cell", "codes").join(more.select("id"), "id", "left_anti")
        return VectorIndex(self.kind, self.metric, self.centroids, self.bounds, self.books, settled(old.unionByName(more)))

    def remove(self, ids: DataFrame, key: str) -> VectorIndex:
        left = self.rows.join(ids.select(F.col(key).cast("long").alias("id")), "id", "left_anti")
        return VectorIndex(self.kind, self.metric, self.centroids, self.bounds, self.books, settled(left))

    def cells(self) -> DataFrame:
        """(cell, n, parts): how many rows each cell has, and in how many parts they are searched."""
        return self.rows.groupBy("cell").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int"))

    def _met(self, asked: DataFrame, take: int) -> DataFrame:
        # a row for each cell, whose number is a parameter of the index
        parts = self.cells().select("cell", "parts")
        sides = asked.groupBy("cell").agg(F.ceil(F.count("*") / PART_QUERIES).cast("int").alias("sides"))
        sizes = F.broadcast(settled(parts.join(sides, "cell")))
        own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        needed = ["id", "cell", "codes"] if self.books else ["id", "cell", "v"]
        rows = self.rows.select(*needed).join(sizes, "cell").withColumn("part", own("id", "parts")).withColumn("side", every("sides")).select(*needed, "part", "side")
        wanted = asked.join(sizes, "cell").withColumn("side", own("query_id", "sides")).withColumn("part", every("parts")).select("query_id", "v", "cell", "part", "side")
        search = _searched(self.metric, take, self.centroids, self.bounds, self.books)
        return wanted.groupBy("cell", "part", "side").cogroup(rows.groupBy("cell", "part", "side")).applyInArrow(search, "query_id long, id long, score double")

    def search(self, queries: DataFrame, k: int, key: str, vector: str, probes: int | None = None, rerank: int = 10) -> DataFrame:
        """(query_id, rank, id, score) of the k nearest rows found for each query, itself among them if it is in the index; ties to the smaller id.

        probes: how many cells a query looks at (all by default). With codes, the rerank * k rows that these say are nearest are
        scored by their vectors. score is the distance, or the inner product. Queries without an id, or whose vector isn't like those of
        the index, get no rows; ids of queries must differ.
        """
        ship_package(queries.sparkSession)
        d = self.centroids.shape[1]
        asked = queries.select(F.col(key).cast("long").alias("query_id"), F.col(vector).alias("v"))
        asked = asked.filter(F.col("query_id").isNotNull() & (F.size("v") == d) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        kind = dict(asked.dtypes)["v"]
        n = min(probes or len(self.centroids), len(self.centroids))
        probed = settled(asked.mapInArrow(_probing(self.centroids, n, self.metric), f"query_id long, v {kind}, cell int"))
        take = k * rerank if self.books else k
        found = self._met(probed, take)
        better = F.desc("score") if self.metric == "inner_product" else F.asc("score")
        w = Window.partitionBy("query_id").orderBy(better, "id")
        found = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= take)
        if self.books:
            found = found.select("query_id", "id").join(self.rows.select("id", "v"), "id").join(asked.withColumnRenamed("v", "q"), "query_id")
            found = found.select("query_id", "id", "q", "v").mapInArrow(_rescored(self.metric), "query_id long, id long, score double")
            found = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        return found.select("query_id", "rank", "id", "score")

    def scanned_share(self, queries: DataFrame, key: str, vector: str, probes: int) -> float:
        """The mean share of all rows in the cells that the queries look at."""
        ship_package(queries.sparkSession)
        asked = queries.select(F.col(key).cast("long").alias("query_id"), F.col(vector).alias("v"))
        probed = asked.mapInArrow(_probing(self.centroids, probes, self.metric), f"query_id long, v {dict(asked.dtypes)['v']}, cell int")
        row = probed.join(F.broadcast(self.cells()), "cell").agg(F.sum("n").alias("met"), F.countDistinct("query_id").alias("q")).first()
        return row["met"] / (row["q"] * self.rows.count()) if row["q"] else 0.0

    def save(self, path: str) -> None:
        """Rows below path/rows, and path/index with the small arrays as one line of JSON."""
        spark = self.rows.sparkSession
        small = {"kind": self.kind, "metric": self.metric, "bounds": self.bounds, "centroids": self.centroids.tolist(), "books": [b.tolist() for b in self.books]}
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame([(json.dumps(small),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/index")

    @staticmethod
    def load(spark: SparkSession, path: str) -> VectorIndex:
        small = json.loads(spark.read.text(f"{path}/index").first()["value"])
        books = [np.array(b, np.float64) for b in small["books"]]
        return VectorIndex(small["kind"], small["metric"], np.array(small["centroids"], np.float64), small["bounds"], books, spark.read.parquet(f"{path}/rows"))


def build_index(
    vectors: DataFrame,
    key: str,
    vector: str,
    kind: str = "ivf",
    metric: str = "l2",
    cells: int = 100,
    parts: int = 8,
    bits: int = 8,
    sample: int = 50_000,
    rounds: int = 8,
) -> VectorIndex:
    """An index of all rows: flat, ivf (cells of k-means), pq (codes of `parts` stretches, 2^bits entries each), or ivfpq (codes of what differs from the cell's centroid).

    Centroids and codebooks are fitted in `rounds` passes over at most `sample` rows, those with the smallest
    hashes of their vectors; every row is filed. Rows without an id, and with a vector that is null, empty, of another length than most
    or not finite, aren't; ids should differ. An empty table gives an empty index. Graph indexes aren't offered: a search would follow
    links between rows one by one, a shuffle for each.
    """
    if kind not in KINDS or metric not in METRICS:
        raise ValueError(f"kind is one of {KINDS} and metric one of {METRICS}, not {kind!r} and {metric!r}")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    row = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = row["d"] if row else 1
    rows = rows.filter((F.size("v") == d) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    hashed = rows.select("v", F.xxhash64("v").alias("h"))
    n = rows.count()
    if n > 8 * sample:  # enough rows for the sample have hashes below this, unless most rows share few vectors
        hashed = hashed.filter(F.col("h") < -(1 << 63) + ((1 << 64) * 4 * sample) // n)
    distinct = hashed.groupBy("h").agg(F.first("v").alias("v"))
    learned = settled(distinct.orderBy("h").limit(sample))
    starts = lambda df, n: np.array([r["v"] for r in df.orderBy("h").limit(n).collect()], np.float64).reshape(-1, d)
    centroids = np.zeros((1, d))
    if kind in ("ivf", "ivfpq"):
        first = starts(learned, cells)
        centroids = fit_centroids(learned, [first], rounds)[0] if len(first) else centroids
    bounds, books = np.linspace(0, d, min(parts, d) + 1).astype(int).tolist() if kind in ("pq", "ivfpq") else [0, d], []
    if kind in ("pq", "ivfpq"):
        rest = settled(learned.select("v").mapInArrow(_residuals(centroids), "v array<double>").withColumn("h", F.xxhash64("v")))
        first = starts(rest, 1 << bits)
        books = [first[:, a:b] for a, b in zip(bounds[:-1], bounds[1:])] if len(first) else [np.zeros((1, b - a)) for a, b in zip(bounds[:-1], bounds[1:])]
        books = fit_centroids(rest, books, rounds)
    index = VectorIndex(kind, metric, centroids, bounds, books, rows)
    index.rows = settled(index._filed(rows))
    return index
