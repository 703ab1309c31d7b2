"""Exact vector search, filters, fusion, pooling, and hybrid ranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions import similarity as S
from graphloom.operators.frames import FEW_ROWS, settled, ship_package


def top_k(vectors: DataFrame, query: list[float], k: int, key: str = "vec_id", vector: str = "embedding", keep: Column | None = None, measure: str = "cosine") -> DataFrame:
    """(key, score, rank) of the k rows most like one query vector: a filter, a projection, and a top-k that keeps k rows a task."""
    q = F.array(*(F.lit(float(x)) for x in query))
    score = {"cosine": S.cosine, "dot": S.dot, "euclidean": S.euclidean_similarity}[measure](F.col(vector), q)
    rows = (vectors.filter(keep) if keep is not None else vectors).select(key, F.round(score, 6).alias("score"))
    rows = rows.orderBy(F.desc("score"), key).limit(k)
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))


#: Rows and queries of a block of top_k_each, and queries that are scored at once.
BLOCK_ROWS, BLOCK_QUERIES, AT_ONCE = 8192, 4096, 256


def _summed(products: np.ndarray) -> np.ndarray:
    """Sums of rows from left to right, as the JVM adds them."""
    return np.cumsum(products, axis=1)[:, -1] if products.shape[1] else np.zeros(len(products))


def _block_top(k: int, key: str):
    """Of a block of rows with whole vectors of one length the k best for each query, and those that rounding may put among them; of equal scores those with the k smallest keys."""

    def values(column: pa.ChunkedArray) -> np.ndarray:
        column = column.combine_chunks()
        return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(rows) and len(asked):
            rows = rows.take(pc.sort_indices(rows, [(key, "ascending")], null_placement="at_start"))
            x, q = values(rows["vector"]), values(asked["query"])
            n, m = np.sqrt(_summed(x * x)), np.sqrt(_summed(q * q))
            for lo in range(0, len(q), AT_ONCE):
                part = q[lo : lo + AT_ONCE]
                with np.errstate(all="ignore"):
                    near = (x @ part.T).T / (m[lo : lo + AT_ONCE, None] * n)
                near[m[lo : lo + AT_ONCE, None] * n == 0] = 0.0
                for i, score in enumerate(near, lo):
                    least = np.partition(score, len(score) - k)[len(score) - k] if len(score) > k else -np.inf
                    some = np.flatnonzero(score >= least - 2e-6)
                    length = n[some] * m[i]
                    exact = np.where(length == 0, 0.0, _summed(x[some] * q[i]) / np.where(length == 0, 1.0, length))
                    order = np.argsort(-exact, kind="stable")  # ties by key, as rows are sorted
                    head = np.flatnonzero(np.diff(exact[order], prepend=np.inf) != 0)
                    nth = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
                    kept = order[nth < k]
                    out.append((np.full(len(kept), i), some[kept], exact[kept]))
        who, which, scores = (np.concatenate(a) for a in zip(*out))
        return pa.table([asked["query_id"].take(pa.array(who)), rows[key].take(pa.array(which)), pa.array(scores)], ["query_id", key, "score"])

    return run


def top_k_each(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k most like rows for each of queries(query_id, query).

    Blocks of rows meet blocks of queries of the same length as matrices, and each block hands on about k rows a query. Vectors
    that are null or hold a null or a value that isn't finite, and pairs of unequal length, are scored one by one, as there are few.
    """
    ship_package(vectors.sparkSession)
    dtype = dict(vectors.dtypes)
    whole = lambda c: F.coalesce(F.size(c) > 0, F.lit(False)) & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")) | (F.abs(x) > 1e150))
    rows = vectors.select(key, F.col(vector).alias("vector"), F.coalesce(whole(F.col(vector)), F.lit(False)).alias("_ok"), F.size(vector).alias("_d"))
    asked = queries.select("query_id", "query", F.coalesce(whole(F.col("query")), F.lit(False)).alias("_ok"), F.size("query").alias("_d"))
    n_rows, n_asked = (df.groupBy("_ok", "_d").count().collect() for df in (rows, asked))
    r, q = (max(1, -(-sum(c["count"] for c in n) // block)) for n, block in ((n_rows, BLOCK_ROWS), (n_asked, BLOCK_QUERIES)))
    dealt = lambda df, own, n, other, m, *by: df.filter("_ok").drop("_ok").withColumn(own, F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).repartition(max(1, min(r * q, 10_000)), "_d", "_r", "_q")
    left, right = dealt(rows, "_r", r, "_q", q, key, "vector"), dealt(asked, "_q", q, "_r", r, "query_id", "query")
    kinds = f"query_id {dict(queries.dtypes)['query_id']}, {key} {dtype[key]}, score double"
    found = left.groupBy("_d", "_r", "_q").cogroup(right.groupBy("_d", "_r", "_q")).applyInArrow(_block_top(k, key), kinds)
    kinds = [{(c["_ok"], c["_d"]) for c in n} for n in (n_rows, n_asked)]
    if len(kinds[0] | kinds[1]) > 1 or not all(ok for ok, _ in kinds[0] | kinds[1]):
        a, b = rows.withColumnsRenamed({"_ok": "_aok", "_d": "_ad"}), asked.withColumnsRenamed({"_ok": "_bok", "_d": "_bd"})
        rest = a.join(b, ~(F.col("_aok") & F.col("_bok") & (F.col("_ad") == F.col("_bd"))))
        found = found.unionByName(rest.select("query_id", key, S.cosine(F.col("vector"), F.col("query")).alias("score")))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return found.withColumn("score", F.round("score", 6)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ranked_lists(lists: DataFrame) -> DataFrame:
    """lists(list_id, id, score) with rank, from 1 by falling score, ties by smaller id; a null score comes last.

    Over FEW_ROWS rows are range-sorted and written with their partition; a rank is the place in its partition and the count
    of the list's rows in the partitions before, so that a list as large as the table isn't one task.
    """
    order = [F.desc_nulls_last("score"), F.asc("id")]
    if lists.count() <= FEW_ROWS:
        return lists.withColumn("rank", F.row_number().over(Window.partitionBy("list_id").orderBy(*order)))
    dealt = settled(lists.repartitionByRange(F.col("list_id"), *order).withColumn("_p", F.spark_partition_id()))
    before = Window.partitionBy("list_id").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("list_id", "_p").agg(F.count("*").alias("_n"))
    counts = counts.select("list_id", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("list_id", "_p").orderBy(*order)))
    placed = placed.join(counts.withColumnsRenamed({"list_id": "_l", "_p": "_q"}), F.col("list_id").eqNullSafe(F.col("_l")) & (F.col("_p") == F.col("_q")))
    return placed.select(*(F.col(f"`{c}`") for c in lists.columns), (F.col("_at") + F.col("_before")).alias("rank"))


def reciprocal_rank_fusion(lists: DataFrame, k: int = 60) -> DataFrame:
    """(id, score) from ranked lists(list_id, id, score): the sum of 1 / (k + rank) over lists."""
    return ranked_lists(lists).groupBy("id").agg(F.sum(1 / (k + F.col("rank"))).alias("score"))


def weighted_fusion(lists: DataFrame, weights: dict[object, float]) -> DataFrame:
    """(id, score): the sum of score times its list's weight."""
    w = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    return lists.groupBy("id").agg(F.sum(F.col("score") * F.coalesce(w[F.col("list_id")], F.lit(0.0))).alias("score"))


def rank_and_merge(results: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Hybrid ranking of results(source in vector | graph | memory, id, score, related).

    Scores are spread over 0..1 within a source, weighted (vector 1 - alpha, graph alpha plus 0.01 a related
    row up to 0.2, memory 0.3); an id that several sources found gets the largest times 1.2.
    """
    ends = results.groupBy("source").agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"))  # three rows
    results = results.join(F.broadcast(ends), "source")
    lo, hi = F.col("_lo"), F.col("_hi")
    unit = F.when(hi == lo, 1.0).otherwise((F.col("score") - lo) / (hi - lo))
    weighted = F.when(F.col("source") == "vector", unit * (1 - alpha)).when(F.col("source") == "graph", unit * alpha + F.least(F.lit(0.2), F.coalesce("related", F.lit(0)) * 0.01)).otherwise(unit * 0.3)
    g = results.withColumn("w", weighted).groupBy("id").agg(F.max("w").alias("w"), F.countDistinct("source").alias("n_sources"))
    return g.select("id", (F.col("w") * F.when(F.col("n_sources") > 1, 1.2).otherwise(1.0)).alias("score"), "n_sources")


def keyword_search(docs: DataFrame, words: list[str], key: str, text: str, k: int) -> DataFrame:
    """(key, matched, score, rank): the share of the words that stand in the text, best first."""
    t = F.lower(F.col(text))
    matched = sum((t.contains(w.lower()).cast("int") for w in words), F.lit(0))
    rows = docs.select(key, matched.alias("matched")).filter("matched > 0").withColumn("score", F.col("matched") / len(words))
    rows = rows.orderBy(F.desc("score"), key).limit(k)
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))


# -- pooling ---------------------------------------------------------------------------------------


def _by_place(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(key), F.posexplode(vector).alias("pos", "x"))


def _back(rows: DataFrame, key: str) -> DataFrame:
    """One vector for each key from rows (key, pos, x); a vector's length bounds the list."""
    return rows.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("vector"))


def pool(df: DataFrame, key: str, vector: str, how: str = "mean") -> DataFrame:
    """Element-wise mean or max of each key's vectors: sums for each element combine in every task."""
    f = {"mean": F.avg, "max": F.max}[how]
    return _back(_by_place(df, key, vector).groupBy(key, "pos").agg(f(F.col("x").cast("double")).alias("x")), key)


def pool_first(df: DataFrame, key: str, vector: str, order: str) -> DataFrame:
    return df.groupBy(key).agg(F.min_by(vector, order).alias("vector"))


def pool_hierarchical(df: DataFrame, key: str, vector: str, order: str, chunk: int = 10) -> DataFrame:
    """Mean of the means of chunks of consecutive rows."""
    n = F.floor((F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1) / chunk)
    rows = df.withColumn("_c", n).select(key, "_c", F.posexplode(vector).alias("pos", "x"))
    inner = rows.groupBy(key, "_c", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return _back(inner.groupBy(key, "pos").agg(F.avg("x").alias("x")), key)


def pool_attention(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Weights are the softmax of each vector's product with the key's mean."""
    mean = pool(df, key, vector).withColumnRenamed("vector", "_q")
    rows = df.join(mean, key).withColumn("_s", S.dot(F.col(vector), F.col("_q")))
    top = rows.groupBy(key).agg(F.max("_s").alias("_m"))
    rows = rows.join(top, key).withColumn("_e", F.exp(F.col("_s") - F.col("_m")))
    total = rows.groupBy(key).agg(F.sum("_e").alias("_t"))
    rows = rows.join(total, key).select(key, (F.col("_e") / F.col("_t")).alias("_w"), F.posexplode(vector).alias("pos", "x"))
    return _back(rows.groupBy(key, "pos").agg(F.sum(F.col("x").cast("double") * F.col("_w")).alias("x")), key)


def upsert(store: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return store.join(rows.select(key), key, "left_anti").unionByName(rows)


def delete(store: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return store.join(keys.select(key), key, "left_anti")


def namespaces(store: DataFrame) -> DataFrame:
    return store.groupBy("namespace").agg(F.count("*").alias("n"))
