"""Queries of vector search, fusion, pooling, ontologies and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import similarity as S
from graphloom.operators import ontology as O
from graphloom.operators import search as V
from graphloom.plans.pipeline import build_knowledge_graph
from graphloom.queries.graphs import _TRIPLES, _edges, _triples
from graphloom.queries.registry import query, table
from graphloom.sinks import writers as W

_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"
_COS = f"{_DOT.format('e.embedding', 'q.embedding')} / (sqrt({_DOT.format('e.embedding', 'e.embedding')}) * sqrt({_DOT.format('q.embedding', 'q.embedding')}))"


def _first(spark, d):
    return table(spark, d, "embeddings").orderBy("vec_id").select("embedding").first()[0]


_TOP = """WITH q AS (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1), s AS (SELECT vec_id, round({0}, 6) AS score FROM embeddings e, q WHERE {1}), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM s) SELECT vec_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""


@query(_TOP.format(_COS, "true"))
def vector_topk(spark, d):
    return V.top_k(table(spark, d, "embeddings"), _first(spark, d), 10)


@query(_TOP.format(_COS, "label = 3"))
def vector_topk_filtered(spark, d):
    return V.top_k(table(spark, d, "embeddings"), _first(spark, d), 10, keep=F.col("label") == 3)


@query(_TOP.format(f"greatest(0, least(1, 1 - sqrt(list_sum(list_transform(list_zip(e.embedding, q.embedding), lambda p: power(CAST(p[1] AS DOUBLE) - p[2], 2)))) / (sqrt({_DOT.format('e.embedding', 'e.embedding')}) + sqrt({_DOT.format('q.embedding', 'q.embedding')}))))", "true"))
def vector_euclid_sim(spark, d):
    return V.top_k(table(spark, d, "embeddings"), _first(spark, d), 10, measure="euclidean")


@query(f"""WITH s AS (SELECT q.vec_id AS query_id, e.vec_id, round({_COS}, 6) AS score FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def vector_topk_each(spark, d):
    e = table(spark, d, "embeddings")
    return V.top_k_each(e, e.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), 3)


@query(f"""SELECT vec_id, round({_DOT.format('embedding', 'embedding')} / ({_DOT.format('embedding', 'embedding')}), 5) AS norm FROM embeddings""")
def vector_l2_normalize(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", S.l2_normalized(F.col("embedding")).alias("v"))
    return v.select("vec_id", F.round(S.norm(F.col("v")), 5).alias("norm"))


_POOLED = "SELECT label, CAST(pos AS INTEGER) AS pos, round(x, 5) AS x FROM ({0}) p"


def _exploded(df):
    return df.select("label", F.posexplode("vector").alias("pos", "x")).withColumn("x", F.round(F.col("x").cast("double"), 5))


_PLACES = "(SELECT label, vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) e"


@query(_POOLED.format(f"SELECT label, pos, avg(x) AS x FROM {_PLACES} GROUP BY ALL"))
def pool_mean(spark, d):
    return _exploded(V.pool(table(spark, d, "embeddings"), "label", "embedding"))


@query(_POOLED.format(f"SELECT label, pos, max(x) AS x FROM {_PLACES} GROUP BY ALL"))
def pool_max(spark, d):
    return _exploded(V.pool(table(spark, d, "embeddings"), "label", "embedding", "max"))


@query(_POOLED.format(f"SELECT label, pos, arg_min(x, vec_id) AS x FROM {_PLACES} GROUP BY ALL"))
def pool_cls(spark, d):
    return _exploded(V.pool_first(table(spark, d, "embeddings"), "label", "embedding", "vec_id"))


@query(_POOLED.format(f"SELECT label, pos, avg(x) AS x FROM (SELECT label, pos, c, avg(x) AS x FROM (SELECT *, (dense_rank() OVER (PARTITION BY label ORDER BY vec_id) - 1) // 10 AS c FROM {_PLACES}) f GROUP BY ALL) g GROUP BY ALL"))
def pool_hierarchical(spark, d):
    return _exploded(V.pool_hierarchical(table(spark, d, "embeddings"), "label", "embedding", "vec_id"))


@query(f"""WITH p AS (SELECT * FROM {_PLACES}), m AS (SELECT label, pos, avg(x) AS q FROM p GROUP BY ALL), s AS (SELECT label, vec_id, exp(sum(x * q)) AS w FROM p JOIN m USING (label, pos) GROUP BY ALL), t AS (SELECT label, sum(w) AS t FROM s GROUP BY label) SELECT label, CAST(pos AS INTEGER) AS pos, round(sum(x * w / t), 5) AS x FROM p JOIN s USING (label, vec_id) JOIN t USING (label) GROUP BY label, pos""")
def pool_attention(spark, d):
    return _exploded(V.pool_attention(table(spark, d, "embeddings"), "label", "embedding"))


_LISTS = "l AS (SELECT 1 AS list_id, vec_id AS id, round(CAST(embedding[1] AS DOUBLE), 6) AS score FROM embeddings UNION ALL SELECT 2, vec_id, round(CAST(embedding[2] AS DOUBLE), 6) FROM embeddings)"


def _lists(spark, d):
    e = table(spark, d, "embeddings")
    one = lambda i: e.select(F.lit(i).alias("list_id"), F.col("vec_id").alias("id"), F.round(F.col("embedding")[i - 1].cast("double"), 6).alias("score"))
    return one(1).unionByName(one(2))


@query(f"""WITH {_LISTS}, r AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY score DESC, id) AS rank FROM l) SELECT id, round(sum(1 / (60 + rank)), 9) AS score FROM r GROUP BY id""")
def rrf_fusion(spark, d):
    return V.reciprocal_rank_fusion(_lists(spark, d)).withColumn("score", F.round("score", 9))


@query(f"""WITH {_LISTS} SELECT id, round(sum(score * CASE list_id WHEN 1 THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END), 6) AS score FROM l GROUP BY id""")
def weighted_fusion(spark, d):
    return V.weighted_fusion(_lists(spark, d), {1: 0.7, 2: 0.3}).withColumn("score", F.round("score", 6))


@query(f"""WITH {_LISTS}, s AS (SELECT CASE list_id WHEN 1 THEN 'vector' ELSE 'graph' END AS source, id, score FROM l WHERE list_id = 1 OR id % 2 = 0), u AS (SELECT *, (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) AS x FROM s WINDOW w AS (PARTITION BY source)), g AS (SELECT id, max(CASE source WHEN 'vector' THEN x * 0.5 ELSE x * 0.5 + 0.03 END) AS w, count(DISTINCT source) AS n_sources FROM u GROUP BY id) SELECT id, round(w * CASE WHEN n_sources > 1 THEN 1.2 ELSE 1.0 END, 6) AS score, n_sources FROM g""")
def hybrid_rank_merge(spark, d):
    rows = _lists(spark, d).filter("list_id = 1 or id % 2 = 0").select(F.when(F.col("list_id") == 1, "vector").otherwise("graph").alias("source"), "id", "score", F.lit(3).alias("related"))
    return V.rank_and_merge(rows).withColumn("score", F.round("score", 6))


@query("""WITH s AS (SELECT doc_id, contains(lower(text), 'license')::INT + contains(lower(text), 'public')::INT + contains(lower(text), 'the')::INT AS matched FROM documents), r AS (SELECT doc_id, matched, round(matched / 3, 6) AS score, row_number() OVER (ORDER BY matched DESC, doc_id) AS rank FROM s WHERE matched > 0) SELECT doc_id, matched, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20""")
def keyword_search(spark, d):
    return V.keyword_search(table(spark, d, "documents"), ["license", "public", "the"], "doc_id", "text", 20).withColumn("score", F.round("score", 6))


# -- ontology ------------------------------------------------------------------------------------------


def _typed(spark, d):
    c = table(spark, d, "customer")
    extra = F.when(F.col("c_custkey") % 4 == 0, F.create_map(F.lit("vip"), F.lit("true"))).otherwise(F.create_map().cast("map<string,string>"))
    return c.select(F.lower("c_mktsegment").alias("type"), F.map_concat(F.create_map(F.lit("balance"), F.col("c_acctbal").cast("string"), F.lit("key"), F.col("c_custkey").cast("string")), extra).alias("properties"))


@query("""SELECT upper(lower(c_mktsegment)[1]) || lower(c_mktsegment)[2:] AS class, count(*) AS n, 'balance,key' AS properties FROM customer GROUP BY c_mktsegment HAVING count(*) >= 2""")
def ontology_classes(spark, d):
    return O.infer_classes(_typed(spark, d)).withColumn("properties", F.array_join("properties", ","))


@query("""SELECT lower(c_mktsegment) AS type, 'key' AS property, count(*) AS n, 'integer' AS xsd FROM customer GROUP BY 1 UNION ALL SELECT lower(c_mktsegment), 'vip', count(*), 'boolean' FROM customer WHERE c_custkey % 4 = 0 GROUP BY 1 UNION ALL SELECT lower(c_mktsegment), 'balance', count(*), 'double' FROM customer GROUP BY 1""")
def ontology_data_props(spark, d):
    return O.data_properties(_typed(spark, d))


@query("""SELECT 'locatedIn' AS property, count(*) AS n, 'nation' AS domain, 'region' AS range FROM nation""")
def ontology_object_props(spark, d):
    r = table(spark, d, "nation").select(F.lit("located in").alias("type"), F.lit("nation").alias("src_type"), F.lit("region").alias("dst_type"))
    return O.object_properties(r).withColumns({c: F.array_join(c, ",") for c in ("domain", "range")})


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] FROM part) SELECT name AS class, CASE WHEN contains(name, ' ') THEN string_split(name, ' ')[1] ELSE 'Thing' END AS parent FROM n""")
def ontology_hierarchy(spark, d):
    p = table(spark, d, "part")
    names = p.select(F.col("p_name").alias("name")).union(p.select(F.split("p_name", " ")[0])).distinct()
    return O.class_hierarchy(names)


@query("""SELECT p_brand, CASE WHEN p_size IS NULL THEN 'removed' ELSE 'added' END AS change FROM (SELECT DISTINCT p_brand, 1 AS p_size FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey <= 10)) e""")
def ontology_compare(spark, d):
    p = table(spark, d, "part")
    return O.compare(p.filter("p_partkey <= 10"), p, "p_brand")


# -- exports -------------------------------------------------------------------------------------------


@query(f"""WITH {_TRIPLES} SELECT '<' || s || '> <' || p || '> ' || CASE WHEN regexp_matches(o, '^[a-z][a-z0-9+.-]*:\\S+$') THEN '<' || o || '>' ELSE '"' || o || '"' END || ' .' AS value FROM t""")
def export_ntriples(spark, d):
    return W.ntriples(_triples(spark, d))


@query(f"""WITH {_TRIPLES}, x AS (SELECT s, '<' || p || '> ' || CASE WHEN regexp_matches(o, '^[a-z][a-z0-9+.-]*:\\S+$') THEN '<' || o || '>' ELSE '"' || o || '"' END AS po FROM t) SELECT '<' || s || '> ' || string_agg(po, ' ;' || chr(10) || '    ' ORDER BY po) || ' .' AS value FROM x GROUP BY s""")
def export_turtle(spark, d):
    return W.turtle(_triples(spark, d))


@query()
def export_jsonld(spark, d):
    return W.jsonld(_triples(spark, d))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS text, 'nation' AS type, '' AS confidence, '' AS start, '' AS "end", '' AS metadata FROM nation""")
def export_csv_entities(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("text"), F.lit("nation").alias("type"))
    return W.csv_rows(n, W.ENTITY_COLUMNS)


@query("""SELECT 'MERGE (n:Nation {id: "' || n_nationkey || '"}) SET n.n_name = "' || n_name || '";' AS value FROM nation""")
def export_cypher(spark, d):
    return W.cypher_nodes(table(spark, d, "nation"), "Nation", "n_nationkey", ["n_name"])


@query()
def export_graphml(spark, d):
    return W.graphml(table(spark, d, "nation").select(F.col("n_nationkey").alias("node")), _edges(spark, d).distinct())


@query("""SELECT '"' || n_nationkey || '" -> "' || n_regionkey || '";' AS value FROM nation""")
def export_dot(spark, d):
    return W.dot(table(spark, d, "nation").select(F.col("n_nationkey").alias("src"), F.col("n_regionkey").alias("dst")))


@query()
def knowledge_graph(spark, d):
    g = build_knowledge_graph(table(spark, d, "documents").select("doc_id", "text"))
    return g.entities.groupBy("type").agg(F.count("*").alias("n"))
