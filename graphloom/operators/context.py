"""Context of agents: query intent, graph retrieval, linking, provenance chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators import dedup, graph, search
from graphloom.operators.triples import closure

#: Question words by kind, and words without meaning for a search.
QUESTIONS = {"who": "person", "where": "location", "when": "time", "why": "reason", "how": "method", "what": "definition", "which": "choice"}
STOP = ["the", "a", "an", "is", "are", "was", "were", "of", "in", "on", "to", "and", "or", "for", "with", "by", "who", "where", "when", "why", "how", "what", "which"]
#: Verbs that name a relation.
VERBS = ["founded", "located", "works", "owns", "acquired", "knows", "supplies", "ordered"]


def intent(queries: DataFrame, text: str) -> DataFrame:
    """queries with kind, relations (verbs that stand in it) and keywords."""
    low = F.lower(F.regexp_replace(text, r"[?!.,;]", " "))
    words = F.filter(F.split(low, r"\s+"), lambda w: w != "")
    kind = reduce(lambda c, kv: F.when(F.array_contains(words, kv[0]), kv[1]).otherwise(c), reversed(QUESTIONS.items()), F.lit("statement"))
    return queries.withColumns({"kind": kind, "relations": F.array_intersect(F.array(*(F.lit(v) for v in VERBS)), words), "keywords": F.array_except(words, F.array(*(F.lit(s) for s in STOP)))})


def expanded(words: list[str], synonyms: dict[str, list[str]]) -> list[str]:
    return list(dict.fromkeys(x for w in words for x in [w, *synonyms.get(w, [])]))


def keyword_nodes(nodes: DataFrame, text: str, words: list[str]) -> DataFrame:
    """nodes whose text holds any of the words, with the share that it holds."""
    score = sum((F.lower(F.col(text)).contains(w.lower()).cast("int") for w in words), F.lit(0)) / len(words)
    return nodes.withColumn("score", score).filter("score > 0")


def retrieve_from_graph(nodes: DataFrame, edges: DataFrame, text: str, words: list[str], hops: int = 1, most_edges: int = 10) -> DataFrame:
    """(node, score, neighbors): nodes that hold the words, with up to most_edges related nodes each, the smallest first.

    The limit on related nodes is a report's: how many there are is counted whole in n_related.
    """
    hit = keyword_nodes(nodes, text, words).select("node", "score")
    near = graph.bfs(edges, hit.select("node"), hops).filter("distance > 0").select(F.col("source").alias("node"), F.col("node").alias("other"))
    counted = near.groupBy("node").agg(F.count("*").alias("n_related"))
    w = Window.partitionBy("node").orderBy("other")
    few = near.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most_edges).groupBy("node").agg(F.sort_array(F.collect_list("other")).alias("neighbors"))
    return hit.join(counted, "node", "left").join(few, "node", "left").withColumn("n_related", F.coalesce("n_related", F.lit(0)))


def retrieve(vector_hits: DataFrame, graph_hits: DataFrame, memory_hits: DataFrame, least: float = 0.0, k: int = 5, alpha: float = 0.5) -> DataFrame:
    """The k best of three sources' (id, score[, related]), ranked and merged; each source gives its 2 k best."""
    parts = []
    for name, df in (("vector", vector_hits), ("graph", graph_hits), ("memory", memory_hits)):
        related = F.col("related") if "related" in df.columns else F.lit(0)
        parts.append(df.orderBy(F.desc("score"), "id").limit(2 * k).select(F.lit(name).alias("source"), "id", "score", related.alias("related")))
    merged = search.rank_and_merge(reduce(DataFrame.unionByName, parts), alpha)
    return merged.filter(F.col("score") >= least).orderBy(F.desc("score"), "id").limit(k)


def conversation_graph(items: DataFrame, mentions: DataFrame) -> DataFrame:
    """Edges conversation -> entity of items(conv_id, turn) and mentions(conv_id, turn, mention): weight is the number of turns."""
    e = items.select("conv_id", "turn").join(mentions, ["conv_id", "turn"])
    g = e.groupBy("conv_id", F.lower("mention").alias("entity")).agg(F.countDistinct("turn").alias("weight"))
    return g.select(F.concat(F.lit("conversation:"), F.col("conv_id").cast("string")).alias("src"), F.lit("mentions").alias("type"), F.concat(F.lit("entity:"), "entity").alias("dst"), "weight")


def entity_links(entities: DataFrame, key: str, text: str, threshold: float = 0.3) -> DataFrame:
    """similar_to edges of entities whose words overlap enough."""
    return dedup.word_overlap_pairs(entities, key, text, threshold).select(F.col("a").alias("src"), F.lit("similar_to").alias("type"), F.col("b").alias("dst"), F.col("similarity").alias("weight"))


def most_linked(links: DataFrame, k: int) -> DataFrame:
    ends = links.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    return ends.orderBy(F.desc("n_links"), "node").limit(k)


def short_term_score(text: Column, words: list[str]) -> Column:
    """The share of the words that stand in the text, 0.1 more if any does, at most 1."""
    share = sum((F.lower(text).contains(w.lower()).cast("int") for w in words), F.lit(0)) / len(words)
    return F.when(share > 0, F.least(F.lit(1.0), share + 0.1)).otherwise(0.0)


def chunk_lineage(chunks: DataFrame) -> DataFrame:
    """(chunk, ancestor) of chunks(chunk, parent): all chunks that a chunk stems from."""
    t = chunks.filter("parent is not null").select(F.col("chunk").cast("string").alias("s"), F.lit("parent").alias("p"), F.col("parent").cast("string").alias("o"))
    return closure(t, "parent").select(F.col("s").alias("chunk"), F.col("o").alias("ancestor"))


def query_cost(sql: str) -> float:
    """A rough cost of SPARQL or SQL text: COUNT doubles it, joins and dots add a tenth, DISTINCT half."""
    up = sql.upper()
    return (2.0 if "COUNT" in up else 1.0) * (1 + 0.1 * (up.count("JOIN") + sql.count("."))) * (1.5 if "DISTINCT" in up else 1.0)
