"""Queries of context retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import context as X
from graphloom.queries.registry import query, table


@query("""SELECT item_id, CASE WHEN list_contains(w, 'who') THEN 'person' WHEN list_contains(w, 'where') THEN 'location' WHEN list_contains(w, 'when') THEN 'time' WHEN list_contains(w, 'why') THEN 'reason' WHEN list_contains(w, 'how') THEN 'method' WHEN list_contains(w, 'what') THEN 'definition' WHEN list_contains(w, 'which') THEN 'choice' ELSE 'statement' END AS kind FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(regexp_replace(text, '[?!.,;]', ' ', 'g')), '\\s+'), lambda x: x <> '') AS w FROM benchmark) e""")
def query_intent(spark, d):
    return X.intent(table(spark, d, "benchmark"), "text").select("item_id", "kind")


@query("""SELECT n_nationkey AS node, (contains(lower(n_name), '1')::INT + contains(lower(n_name), '2')::INT) / 2 AS score, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_related FROM nation WHERE contains(lower(n_name), '1') OR contains(lower(n_name), '2')""")
def graph_retrieval(spark, d):
    nodes = table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("node"), "n_name")
    edges = table(spark, d, "supplier").select(F.col("s_nationkey").cast("int").alias("src"), (F.col("s_suppkey") + 1000).cast("int").alias("dst"))
    return X.retrieve_from_graph(nodes, edges, "n_name", ["1", "2"]).select("node", "score", F.col("n_related").cast("long").alias("n_related"))


@query("""WITH m AS (SELECT conv_id, turn, lower(unnest(regexp_extract_all(text, '[A-Z][a-z]{3,}'))) AS e FROM conversations) SELECT 'conversation:' || conv_id AS src, 'mentions' AS type, 'entity:' || e AS dst, count(DISTINCT turn) AS weight FROM m GROUP BY conv_id, e""")
def conversation_graph(spark, d):
    c = table(spark, d, "conversations")
    m = c.select("conv_id", "turn", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{3,}"), F.lit(0))).alias("mention"))
    return X.conversation_graph(c.select("conv_id", "turn").distinct(), m)


@query("""SELECT conv_id, turn, round(CASE WHEN s > 0 THEN least(1.0, s / 2 + 0.1) ELSE 0 END, 6) AS score FROM (SELECT conv_id, turn, contains(lower(text), 'the')::INT + contains(lower(text), 'and')::INT AS s FROM conversations) e""")
def short_term_search(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.round(X.short_term_score(F.col("text"), ["the", "and"]), 6).alias("score"))


@query("""WITH RECURSIVE c AS (SELECT 'o' || o_orderkey AS chunk, 'c' || o_custkey AS parent FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer), r(chunk, ancestor) AS (SELECT chunk, parent FROM c UNION SELECT r.chunk, c.parent FROM r JOIN c ON r.ancestor = c.chunk) SELECT chunk, ancestor FROM r""")
def chunk_lineage(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    chunks = o.select(F.concat(F.lit("o"), "o_orderkey").alias("chunk"), F.concat(F.lit("c"), "o_custkey").alias("parent"))
    return X.chunk_lineage(chunks.unionByName(c.select(F.concat(F.lit("c"), "c_custkey").alias("chunk"), F.concat(F.lit("n"), "c_nationkey").alias("parent"))))


@query("""WITH n AS (SELECT min(p_partkey) AS k, list_distinct(string_split(lower(p_name), ' ')) AS s FROM part GROUP BY p_name), j AS (SELECT a.k AS a, b.k AS b FROM n a JOIN n b ON a.k < b.k AND len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) >= 0.3), e AS (SELECT unnest([a, b]) AS node FROM j) SELECT node, count(*) AS n_links FROM e GROUP BY node ORDER BY n_links DESC, node LIMIT 10""")
def most_linked(spark, d):
    n = table(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("k"))
    return X.most_linked(X.entity_links(n, "k", "name", 0.3), 10)


@query()
def hybrid_retrieval(spark, d):
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("score"))
    g = v.filter("id % 2 = 0").withColumn("related", F.lit(3))
    return X.retrieve(v, g, v.filter("id % 3 = 0"), 0.0, 5)
