"""Names: aliases, variants, naming rules, matching against a registry, duplicate relationships, cluster upkeep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions import similarity as S
from graphloom.functions.text import camel_case, pascal_case, singular, strip_honorific


def resolve_aliases(rows: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """rows with canonical: the name that aliases(alias, canonical) has for it, letter case ignored, else itself."""
    a = aliases.groupBy(F.lower("alias").alias("_k")).agg(F.min("canonical").alias("_c"))
    return rows.join(a, F.lower(F.col(name)) == F.col("_k"), "left").withColumn("canonical", F.coalesce("_c", name)).drop("_k", "_c")


def normalized_name(name: Column, kind: Column) -> Column:
    """Spaces collapsed, a title stripped, words of a person capitalised."""
    c = strip_honorific(F.trim(F.regexp_replace(name, r"\s+", " ")))
    return F.when(kind == "Person", F.initcap(c)).otherwise(c)


def name_variants(name: Column) -> Column:
    """The name, without title, last name first, with initials."""
    plain = strip_honorific(name)
    words = F.split(plain, " ")
    last = F.element_at(words, -1)
    rest = F.slice(words, 1, F.size(words) - 1)
    several = F.size(words) > 1
    turned = F.when(several, F.concat(last, F.lit(", "), F.array_join(rest, " ")))
    initials = F.when(several, F.concat(F.array_join(F.transform(rest, lambda w: F.concat(F.substring(w, 1, 1), F.lit("."))), " "), F.lit(" "), last))
    return F.array_distinct(F.array_compact(F.array(name, plain, turned, initials)))


def valid_class_name(name: Column) -> Column:
    return name.rlike("^[A-Z][A-Za-z0-9]*$")


def valid_property_name(name: Column) -> Column:
    return name.rlike("^[a-z][A-Za-z0-9]*$")


def suggested_class_name(name: Column) -> Column:
    return pascal_case(singular(name))


def suggested_property_name(name: Column) -> Column:
    return camel_case(name)


def matches(mentions: DataFrame, registry: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(mention, entity, score): the best entity(entity, synonyms) of each mention: equal 1, a synonym 0.95, one within the other 0.9 times the
    ratio of lengths and 0.1 more, found through shared words."""
    m = mentions.select("mention").distinct()
    names = registry.select("entity", F.col("entity").alias("name"), F.lit(1.0).alias("w")).unionByName(registry.select("entity", F.explode("synonyms").alias("name"), F.lit(0.95).alias("w")))
    words = lambda c: F.explode(S.word_set(F.lower(c)))
    pairs = m.select("mention", words(F.col("mention")).alias("x")).join(names.select("entity", "name", "w", words(F.col("name")).alias("x")), "x").select("mention", "entity", "name", "w").distinct()
    a, b = F.lower("mention"), F.lower("name")
    ratio = F.least(F.length("mention"), F.length("name")) / F.greatest(F.length("mention"), F.length("name"))
    score = F.when(a == b, F.col("w")).when(a.contains(b) | b.contains(a), (0.9 * ratio + 0.1) * F.col("w")).otherwise(S.word_jaccard(F.col("mention"), F.col("name")) * F.col("w"))
    best = Window.partitionBy("mention").orderBy(F.desc("score"), "entity")
    return pairs.withColumn("score", score).withColumn("r", F.row_number().over(best)).filter((F.col("r") == 1) & (F.col("score") >= threshold)).select("mention", "entity", "score")


def relationship_duplicates(rels: DataFrame) -> DataFrame:
    """(src, dst, type, n): relationships that stand more than once."""
    return rels.groupBy("src", "dst", "type").agg(F.count("*").alias("n")).filter("n > 1")


def similar_predicates(rels: DataFrame, score: Callable[[Column, Column], Column] = S.jaro_winkler, threshold: float = 0.9) -> DataFrame:
    """(a, b, score) of predicates that are nearly alike; predicates are a vocabulary, so distinct ones are compared."""
    p = rels.select("type").distinct()
    x, y = p.select(F.col("type").alias("a"), F.substring("type", 1, 1).alias("f")), p.select(F.col("type").alias("b"), F.substring("type", 1, 1).alias("f"))
    return x.join(y, "f").filter("a < b").withColumn("score", score(F.col("a"), F.col("b"))).filter(F.col("score") >= threshold).select("a", "b", "score")


def cluster_quality(pairs: DataFrame, groups: DataFrame, smallest: int = 2, largest: int = 100) -> DataFrame:
    """(component, size, quality): mean score of the cluster's scored pairs, times 0.8 if its size is out of bounds."""
    size = groups.groupBy("component").agg(F.count("*").alias("size"))
    a, b = groups.select(F.col("id").alias("a"), "component"), groups.select(F.col("id").alias("b"), F.col("component").alias("other"))
    inner = pairs.join(a, "a").join(b, "b").filter("component = other").groupBy("component").agg(F.avg("score").alias("mean"))
    q = F.col("mean") * F.when(F.col("size").between(smallest, largest), 1.0).otherwise(0.8)
    return size.join(inner, "component").select("component", "size", q.alias("quality"))


def assign_to_clusters(pairs: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(new_ord, component): the cluster with the best mean score of (new_ord, old_ord, score), null below the threshold."""
    g = pairs.join(groups.select(F.col("id").alias("old_ord"), "component"), "old_ord").groupBy("new_ord", "component").agg(F.avg("score").alias("mean"))
    best = g.groupBy("new_ord").agg(F.max_by(F.struct("component", "mean"), F.struct("mean", -F.col("component"))).alias("b"))
    return best.select("new_ord", F.when(F.col("b.mean") >= threshold, F.col("b.component")).alias("component"))


def merged_properties(records: DataFrame, strategy: str = "keep_first") -> DataFrame:
    """(component, properties map) of records(component, ord, properties map): for each key the first or last record's value, or all joined by |."""
    kv = records.select("component", "ord", F.explode("properties").alias("k", "v")).filter("v is not null")
    pick = {"keep_first": F.min_by("v", "ord"), "keep_last": F.max_by("v", "ord"), "merge_all": F.array_join(F.sort_array(F.collect_set("v")), "|")}[strategy]
    each = kv.groupBy("component", "k").agg(pick.alias("v"))
    return each.groupBy("component").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("properties"))


def merged_relations(records: DataFrame) -> DataFrame:
    """(component, type, target) of records(component, relations array of (type, target)), each once."""
    return records.select("component", F.inline("relations")).distinct()
