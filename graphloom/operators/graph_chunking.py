"""Chunks by what sentences are about: communities and hubs of a graph of sentences and entities, and classes of an ontology.

The graphs of all documents are one table, keyed by document, so each step is one join or aggregation for all of them.
Sentences and entities are linked with each other, not entities among themselves, so a sentence with many entities costs
as many rows and not their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.chunking import sentences
from graphloom.operators.frames import settled, superseded

#: What counts as an entity unless a caller says otherwise: a capital and two small letters or more.
ENTITY = r"[A-Z][a-z]{2,}"


def sentence_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, sentence) of all sentences; null and empty texts have none."""
    return docs.select(F.col(key).alias("key"), F.posexplode(sentences(F.col(text))).alias("at", "sentence"))


def sentence_entities(parts: DataFrame, pattern: str = ENTITY) -> DataFrame:
    """(key, at, entity): the distinct entities of each sentence, in lower case."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("sentence", F.lit(f"({pattern})"), F.lit(1)), lambda e: F.lower(e)))
    return parts.select("key", "at", F.explode(found).alias("entity"))


def _commonest(rows: DataFrame, of: str) -> DataFrame:
    """(key, of, label): the commonest label of each, the smallest on ties."""
    votes = rows.groupBy("key", of, "label").agg(F.count("*").alias("n"))
    return votes.groupBy("key", of).agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("label"))


def sentence_communities(links: DataFrame, rounds: int = 3) -> DataFrame:
    """(key, at, label): communities of the sentences in links(key, at, entity), by rounds of label propagation.

    Labels begin as the sentences' numbers. In a round each entity takes the commonest label of its sentences, then each sentence that
    of its entities; ties go to the smallest.
    """
    links = settled(links)
    labels = links.select("key", "at", F.col("at").alias("label")).distinct()
    for _ in range(rounds):
        by_entity = _commonest(links.join(labels, ["key", "at"]), "entity")
        last, labels = labels, settled(_commonest(links.join(by_entity, ["key", "entity"]), "at"))
        superseded(last)
    return labels


def sentence_hubs(links: DataFrame, hubs: int = 5) -> DataFrame:
    """(key, at, label): to which of a document's `hubs` most central entities a sentence belongs, 1 for the first.

    Central is what stands in most sentences, of equals the alphabetically first; a sentence belongs to the most central hub in it.
    """
    degree = links.groupBy("key", "entity").agg(F.count("*").alias("n"))
    ranked = degree.withColumn("label", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("n"), "entity")))
    best = ranked.filter(F.col("label") <= hubs).select("key", "entity", "label")
    return links.join(best, ["key", "entity"]).groupBy("key", "at").agg(F.min("label").alias("label"))


def _carried(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """parts with label; a sentence without one has that of the last sentence before it that has one, and -1 without any."""
    w = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return parts.join(labels, ["key", "at"], "left").withColumn("label", F.coalesce(F.last("label", ignorenulls=True).over(w), F.lit(-1)))


def _joined(rows: DataFrame, key: str, group: str) -> DataFrame:
    """(key, chunk_index, n_parts, text): the sentences of each group of a document in their order; chunks stand in the order of their first sentences."""
    g = rows.groupBy("key", group).agg(F.min("at").alias("first"), F.count("*").cast("int").alias("n_parts"), F.sort_array(F.collect_list(F.struct("at", "sentence"))).alias("l"))
    text = F.array_join(F.transform("l", lambda x: x["sentence"]), " ").alias("text")
    place = (F.row_number().over(Window.partitionBy("key").orderBy("first")) - 1).alias("chunk_index")
    return g.select(F.col("key").alias(key), place, "n_parts", text)


def by_graph(docs: DataFrame, key: str, text: str, strategy: str = "community", pattern: str = ENTITY, rounds: int = 3, hubs: int = 5) -> DataFrame:
    """(key, chunk_index, n_parts, text): each document's sentences grouped by community, or by the hub that they belong to.

    Entities link sentences; a sentence without any goes with the one before it. Every sentence is in one chunk, in which sentences keep
    their order though others may have stood between them. Documents must differ in their keys; null and empty texts give no rows.
    """
    if strategy not in ("community", "centrality"):
        raise ValueError(f"strategy is community or centrality, not {strategy!r}")
    parts = sentence_table(docs, key, text)
    links = sentence_entities(parts, pattern)
    labels = sentence_communities(links, rounds) if strategy == "community" else sentence_hubs(links, hubs)
    return _joined(_carried(parts, labels), key, "label")


def ancestors(hierarchy: DataFrame) -> DataFrame:
    """(class, above, distance): each class of hierarchy(child, parent) with itself at 0 and all classes above it at their least distance."""
    links = hierarchy.select("child", "parent").filter("child is not null and parent is not null and child <> parent").distinct()
    links = settled(links)
    own = links.select(F.explode(F.array("child", "parent")).alias("class")).distinct()
    front = settled(own.select("class", F.col("class").alias("above"), F.lit(0).alias("distance")))
    found = front
    while True:
        step = front.join(links, front.above == links.child).groupBy("class", F.col("parent").alias("above")).agg((F.min("distance") + 1).alias("distance"))
        front = settled(step.join(found.select("class", "above"), ["class", "above"], "left_anti"))  # a cycle ends here
        if front.isEmpty():
            return found
        found = found.unionByName(front)


def common_classes(mentions: DataFrame, above: DataFrame) -> DataFrame:
    """(key, at, label): the nearest class that all of a sentence's mentions(key, at, class) fall under; nearest is the least sum of distances, of equals the alphabetically first.

    No row where they have no class in common.
    """
    named = mentions.select("key", "at", "class").distinct()
    needed = named.groupBy("key", "at").agg(F.count("*").alias("needed"))
    met = named.join(F.broadcast(above), "class").groupBy("key", "at", "above").agg(F.count("*").alias("n"), F.sum("distance").alias("far"))
    shared = met.join(needed, ["key", "at"]).filter("n = needed")
    return shared.groupBy("key", "at").agg(F.min_by("above", F.struct("far", "above")).alias("label"))


def by_ontology(docs: DataFrame, key: str, text: str, terms: dict[str, str], hierarchy: list[tuple[str, str]]) -> DataFrame:
    """(key, chunk_index, concept, n_parts, text): stretches of sentences whose mentions have the same nearest common class.

    terms: which class a word (in lower case) stands for; hierarchy: (class, the class above it). A new chunk begins where the concept
    changes; a sentence without a concept goes on with the one before, and sentences before the first have none. Both are small, as their
    closure is broadcast: terms are a dictionary in the caller's hands, not a table. Null and empty texts give no rows.
    """
    spark = docs.sparkSession
    parts = sentence_table(docs, key, text)
    known = sorted(set(terms.values()) | {c for pair in hierarchy for c in pair})
    links = [*hierarchy, *((c, "") for c in known)]  # so that classes outside the hierarchy are known too
    above = ancestors(spark.createDataFrame(links, "child string, parent string")).filter("above <> ''")
    words: Column = F.array_distinct(F.filter(F.split(F.lower("sentence"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    named = spark.createDataFrame(sorted(terms.items()), "word string, class string")
    mentions = parts.select("key", "at", F.explode(words).alias("word")).join(F.broadcast(named), "word")
    w = Window.partitionBy("key").orderBy("at")
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.join(common_classes(mentions, above), ["key", "at"], "left")
    rows = rows.withColumn("concept", F.last("label", ignorenulls=True).over(before))
    cut = ~F.col("concept").eqNullSafe(F.lag("concept").over(w))
    rows = rows.withColumn("group", F.sum(F.when(F.row_number().over(w) == 1, 0).otherwise(cut.cast("int"))).over(before))
    g = rows.groupBy("key", "group").agg(F.first("concept").alias("concept"), F.count("*").cast("int").alias("n_parts"), F.sort_array(F.collect_list(F.struct("at", "sentence"))).alias("l"))
    return g.select(F.col("key").alias(key), F.col("group").cast("int").alias("chunk_index"), "concept", "n_parts", F.array_join(F.transform("l", lambda x: x["sentence"]), " ").alias("text"))
