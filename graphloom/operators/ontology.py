"""Ontologies from data: classes, properties, hierarchy, evaluation, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import camel_case, pascal_case, singular


def infer_classes(entities: DataFrame, least: int = 2, share: float = 0.5) -> DataFrame:
    """(class, n, properties) of entities(type, properties map): types with `least` instances, and the keys that `share` of them have."""
    n = entities.groupBy("type").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    keys = entities.select("type", F.explode(F.map_keys("properties")).alias("key")).groupBy("type", "key").agg(F.count("*").alias("k"))
    common = keys.join(n, "type").filter(F.col("k") >= F.col("n") * share).groupBy("type").agg(F.sort_array(F.collect_list("key")).alias("properties"))
    return n.join(common, "type", "left").select(singular(pascal_case(F.col("type"))).alias("class"), "n", F.coalesce("properties", F.array().cast("array<string>")).alias("properties"))


def object_properties(relationships: DataFrame, least: int = 2) -> DataFrame:
    """(property, n, domain, range) of relationships(type, src_type, dst_type)."""
    g = relationships.groupBy("type").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("src_type")).alias("domain"), F.sort_array(F.collect_set("dst_type")).alias("range"))
    return g.filter(F.col("n") >= least).select(camel_case(F.col("type")).alias("property"), "n", "domain", "range")


#: XSD types from narrow to wide.
XSD = ["boolean", "integer", "double", "date", "dateTime", "string"]


def data_properties(entities: DataFrame) -> DataFrame:
    """(type, property, n, xsd): the widest kind that a key's values need."""
    kv = entities.select("type", F.explode("properties").alias("property", "value"))
    v = F.col("value")
    rank = (
        F.when(v.rlike("^(true|false)$"), 0).when(v.rlike(r"^[+-]?\d+$"), 1).when(v.try_cast("double").isNotNull(), 2)
        .when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), 3).when(v.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), 4).otherwise(5)
    )
    g = kv.filter("value is not null").groupBy("type", "property").agg(F.count("*").alias("n"), F.max(rank).alias("r"))
    return g.select("type", "property", "n", F.element_at(F.array(*(F.lit(x) for x in XSD)), F.col("r") + 1).alias("xsd"))


def class_hierarchy(classes: DataFrame) -> DataFrame:
    """(class, parent): the longest other class whose words begin the class's words, else Thing. classes(name with spaces)."""
    words = classes.select("name", F.split("name", " ").alias("w"))
    prefixes = words.filter(F.size("w") > 1).select("name", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"), "w")
    prefixes = prefixes.select("name", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("parent"))
    hit = prefixes.join(classes.select(F.col("name").alias("parent")).distinct(), "parent").groupBy("name").agg(F.max_by("parent", "k").alias("parent"))
    return classes.select("name").distinct().join(hit, "name", "left").select(F.col("name").alias("class"), F.coalesce("parent", F.lit("Thing")).alias("parent"))


def evaluate(classes: DataFrame) -> DataFrame:
    """One row of classes(class, n, properties): classes, share with properties, very small and very large ones."""
    return classes.agg(F.count("*").alias("n_classes"), F.avg((F.size("properties") > 0).cast("double")).alias("completeness"), F.count_if(F.col("n") < 2).alias("too_small"), F.count_if(F.col("n") > 1000).alias("too_large"))


def without_redundancy(rows: DataFrame, name: str, order: str) -> DataFrame:
    """The first row of each name."""
    return rows.groupBy(name).agg(*(F.min_by(c, order).alias(c) for c in rows.columns if c != name))


def compare(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change): added or removed."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("change", F.lit("added")).unionByName(a.join(b, key, "left_anti").withColumn("change", F.lit("removed")))
