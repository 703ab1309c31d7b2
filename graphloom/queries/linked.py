"""Queries of parsing, linking and the graph store."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import similarity as S
from graphloom.operators import chunking as K
from graphloom.operators import dedup as DD
from graphloom.operators import linking as L
from graphloom.operators import store as G
from graphloom.operators.indexes import build_index
from graphloom.queries.registry import query, table
from graphloom.sources import parsers as P


@query("""SELECT event_id, k AS path, props ->> k AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) e""")
def json_paths(spark, d):
    return P.json_paths(table(spark, d, "events"), "event_id", "props")


@query("""SELECT event_id, 'object' AS kind FROM events""")
def json_schema_kind(spark, d):
    return table(spark, d, "events").select("event_id", P.json_schema(F.col("props")).alias("kind"))


@query("""SELECT n_nationkey, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation""")
def xml_round_trip(spark, d):
    x = table(spark, d, "nation").select("n_nationkey", F.to_xml(F.struct("n_name", "n_regionkey")).alias("x"))
    return x.select("n_nationkey", P.xml_values(F.col("x"), "/ROW/n_name/text()")[0].alias("name"), P.xml_values(F.col("x"), "/ROW/n_regionkey/text()")[0].alias("region"))


@query("""SELECT n_nationkey, CAST(0 AS INTEGER) AS table_no, CAST(i AS INTEGER) AS row_no, CASE i WHEN 0 THEN 'name|region' ELSE n_name || '|' || n_regionkey END AS cells FROM nation, (SELECT unnest([0, 1]) AS i) r""")
def html_tables(spark, d):
    row = lambda *c: F.concat(F.lit("<tr>"), *(x for y in c for x in (F.lit("<td><b>"), y, F.lit("</b> </td>"))), F.lit("</tr>"))
    n = table(spark, d, "nation").select("n_nationkey", F.concat(F.lit("<p>x</p><table class='t'>"), row(F.lit("name"), F.lit("region")), row(F.col("n_name"), F.col("n_regionkey").cast("string")), F.lit("</table>")).alias("html"))
    return P.html_tables(n, "n_nationkey", "html").withColumn("cells", F.array_join("cells", "|"))


@query("""SELECT c_custkey, coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'industry' END, c_mktsegment) AS canonical FROM customer""")
def alias_resolution(spark, d):
    aliases = spark.createDataFrame([("building", "construction"), ("Machinery", "industry")], "alias string, canonical string")
    return L.resolve_aliases(table(spark, d, "customer"), "c_mktsegment", aliases).select("c_custkey", "canonical")


@query("""SELECT c_custkey, 'Dr. Ann ' || c_mktsegment || ';Ann ' || c_mktsegment || ';' || c_mktsegment || ', Ann;A. ' || c_mktsegment AS variants FROM customer""")
def name_variants(spark, d):
    name = F.concat(F.lit("Dr. Ann "), "c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", F.array_join(L.name_variants(name), ";").alias("variants"))


@query("""SELECT DISTINCT p_type, regexp_matches(p_type, '^[A-Z][A-Za-z0-9]*$') AS class_ok, regexp_matches(p_type, '^[a-z][A-Za-z0-9]*$') AS property_ok FROM part""")
def naming_validation(spark, d):
    return table(spark, d, "part").select("p_type", L.valid_class_name(F.col("p_type")).alias("class_ok"), L.valid_property_name(F.col("p_type")).alias("property_ok")).distinct()


@query("""SELECT l_partkey AS src, l_suppkey AS dst, l_returnflag AS type, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def relationship_duplicates(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_returnflag").alias("type"))
    return L.relationship_duplicates(r)


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part), w AS (SELECT name, unnest(list_distinct(string_split(lower(name), ' '))) AS x FROM n), p AS (SELECT DISTINCT a.name AS mention, b.name AS entity FROM w a JOIN w b USING (x) WHERE b.name[1] < 'm'), s AS (SELECT mention, entity, CASE WHEN mention = entity THEN 1.0 WHEN contains(mention, entity) OR contains(entity, mention) THEN 0.9 * least(length(mention), length(entity)) / greatest(length(mention), length(entity)) + 0.1 ELSE len(list_intersect(string_split(lower(mention), ' '), string_split(lower(entity), ' '))) / len(list_distinct(list_concat(string_split(lower(mention), ' '), string_split(lower(entity), ' ')))) END AS score FROM p) SELECT mention, entity, round(CAST(score AS DOUBLE), 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY round(score, 9) DESC, entity) AS r FROM s) e WHERE r = 1 AND score >= 0.3""")
def entity_matches(spark, d):
    n = table(spark, d, "part").select(F.col("p_name").alias("mention")).distinct()
    registry = n.filter("substring(mention, 1, 1) < 'm'").select(F.col("mention").alias("entity"), F.array().cast("array<string>").alias("synonyms"))
    return L.matches(n, registry, 0.3).withColumn("score", F.round("score", 6))


@query()
def similar_predicates(spark, d):
    return L.similar_predicates(table(spark, d, "part").select(F.col("p_type").alias("type")), threshold=0.6)


@query()
def cluster_quality(spark, d):
    names = table(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("ord"))
    pairs = DD.candidate_pairs(names, 0.6, S.levenshtein)
    return L.cluster_quality(pairs, DD.duplicate_groups(pairs))


@query("""SELECT p_name AS component, arg_min(p_brand, p_partkey) AS brand, arg_min(p_size, p_partkey) FILTER (p_partkey % 3 <> 0) AS size FROM part GROUP BY p_name""".replace("arg_min(p_size, p_partkey) FILTER (p_partkey % 3 <> 0)", "CAST(arg_min(p_size, p_partkey) FILTER (p_partkey % 3 <> 0) AS VARCHAR)"))
def merge_property_maps(spark, d):
    p = table(spark, d, "part").select(F.col("p_name").alias("component"), F.col("p_partkey").alias("ord"), F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size").cast("string"))).alias("properties"))
    return L.merged_properties(p).select("component", F.col("properties")["brand"].alias("brand"), F.col("properties")["size"].alias("size"))


def _graph(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("node"), F.array(F.lit("nation")).alias("labels"), F.create_map(F.lit("name"), "n_name").alias("properties"))
    e = table(spark, d, "supplier").select(F.col("s_nationkey").alias("src"), (F.col("s_suppkey") + 1000).cast("int").alias("dst"), F.lit("has").alias("type"))
    return n, e


@query("""SELECT n_nationkey AS node, 'nation' AS label FROM nation UNION ALL SELECT CAST(s_suppkey + 1000 AS INTEGER), 'entity' FROM supplier""")
def graph_missing_ends(spark, d):
    n, e = _graph(spark, d)
    return G.with_missing_ends(n, e).select("node", F.col("labels")[0].alias("label"))


@query("""SELECT 'label' AS what, 'nation' AS name, count(*) AS n FROM nation WHERE n_nationkey > 2 UNION ALL SELECT 'type', 'has', count(*) FROM supplier WHERE s_nationkey > 2""")
def graph_delete_and_stats(spark, d):
    n, e = _graph(spark, d)
    return G.stats(*G.delete_nodes(n, e, n.filter("node <= 2")))


@query("""SELECT n_nationkey AS node, CASE WHEN n_nationkey < 3 THEN 'new' ELSE n_name END AS name FROM nation WHERE n_nationkey < 10""")
def graph_update(spark, d):
    n, _ = _graph(spark, d)
    changed = G.merge_properties(n, n.filter("node < 3").select("node", F.create_map(F.lit("name"), F.lit("new")).alias("properties")))
    return G.find_nodes(changed, "nation", limit=None).filter("node < 10").select("node", F.col("properties")["name"].alias("name"))


def _indexed(spark, d, kind, metric, probes=None, rerank=10):
    e = table(spark, d, "embeddings")
    found = build_index(e, "vec_id", "embedding", kind, metric).search(e.filter("vec_id % 50 = 0"), 10, "vec_id", "embedding", probes, rerank)
    return found.withColumn("score", F.round("score", 6))


_NEAREST = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, {} AS score FROM v q, v c WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score{}, id) AS INTEGER) AS rank FROM s) SELECT query_id, rank, id, round(score, 6) AS score FROM r WHERE rank <= 10"""


@query(_NEAREST.format("sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))", ""))
def vector_index_flat(spark, d):
    return _indexed(spark, d, "flat", "l2")


@query(_NEAREST.format("list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))", " DESC"))
def vector_index_all_cells(spark, d):
    """Inverted lists of which a query looks at all, so nothing is missed."""
    return _indexed(spark, d, "ivf", "inner_product")


@query()
def vector_index_ivf(spark, d):
    return _indexed(spark, d, "ivf", "l2", 50)


@query()
def vector_index_ivfpq(spark, d):
    return _indexed(spark, d, "ivfpq", "l2", 60, 40)


@query()
def vector_lsh(spark, d):
    e = table(spark, d, "embeddings")
    return G.random_projection_search(e, list(e.orderBy("vec_id").first()["embedding"]), 10)


@query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents), c AS (SELECT doc_id, w, unnest(generate_series(0, greatest(CAST(ceil((len(w) - 50) / 462) AS BIGINT) - 1, 0))) AS i FROM w WHERE len(w) > 0) SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(len(w[i * 462 + 1 : i * 462 + 512]) AS INTEGER) AS n_words FROM c""")
def chunk_tokens(spark, d):
    return K.by_words(table(spark, d, "documents"), "doc_id", "text", 512, 50).select("doc_id", "chunk_index", "n_words")
