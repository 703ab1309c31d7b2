"""A property graph in tables: nodes(node, labels, properties) and edges(src, dst, type, properties), with changes as new tables."""

from __future__ import annotations

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find_nodes(nodes: DataFrame, label: str | None = None, properties: dict[str, str] = {}, limit: int | None = 100) -> DataFrame:
    out = nodes.filter(F.array_contains("labels", label)) if label else nodes
    for k, v in properties.items():
        out = out.filter(F.col("properties")[k] == v)
    return out.orderBy("node").limit(limit) if limit is not None else out


def find_edges(edges: DataFrame, node: object | None = None, direction: str = "both", kind: str | None = None) -> DataFrame:
    out = edges.filter(F.col("type") == kind) if kind else edges
    if node is not None:
        at = {"out": F.col("src") == node, "in": F.col("dst") == node, "both": (F.col("src") == node) | (F.col("dst") == node)}[direction]
        out = out.filter(at)
    return out


def add_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """New nodes replace those with the same id."""
    return nodes.join(new.select("node"), "node", "left_anti").unionByName(new)


def merge_properties(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """changes(node, properties) over the nodes' own properties."""
    c = changes.select("node", F.col("properties").alias("_p"))
    both = F.map_zip_with("properties", "_p", lambda k, old, new: F.coalesce(new, old))
    return nodes.join(c, "node", "left").withColumn("properties", F.when(F.col("_p").isNull(), F.col("properties")).otherwise(both)).drop("_p")


def delete_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without the gone nodes and the edges at them."""
    left = edges.join(gone.select(F.col("node").alias("src")), "src", "left_anti").join(gone.select(F.col("node").alias("dst")), "dst", "left_anti")
    return nodes.join(gone.select("node"), "node", "left_anti"), left.select(*edges.columns)


def delete_edges(edges: DataFrame, gone: DataFrame) -> DataFrame:
    return edges.join(gone.select("src", "dst", "type"), ["src", "dst", "type"], "left_anti")


def with_missing_ends(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes, and a bare one for each end of an edge that isn't among them."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(nodes.select("node"), "node", "left_anti")
    bare = ends.select("node", F.array(F.lit("entity")).alias("labels"), F.create_map().cast("map<string,string>").alias("properties"))
    return nodes.select("node", "labels", "properties").unionByName(bare)


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(what, name, n): nodes for each label and edges for each type."""
    labels = nodes.select(F.explode("labels").alias("name")).groupBy("name").agg(F.count("*").alias("n")).select(F.lit("label").alias("what"), "name", "n")
    return labels.unionByName(edges.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).select(F.lit("type").alias("what"), "name", "n"))


def random_projection_search(vectors: DataFrame, query: list[float], k: int, key: str = "vec_id", vector: str = "embedding", width: float = 2.0, tables: int = 4) -> DataFrame:
    """(key, distance) of the k nearest by Euclidean distance among those that share a bucket: approximate."""
    from pyspark.ml.linalg import Vectors

    rows = vectors.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=width, numHashTables=tables, seed=7).fit(rows)
    return model.approxNearestNeighbors(rows, Vectors.dense(query), k).select(key, F.col("distCol").alias("distance"))
