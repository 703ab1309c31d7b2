"""Queries of quality, conflicts and entity dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import similarity as S
from graphloom.operators import conflicts as C
from graphloom.operators import dedup as DD
from graphloom.operators import quality as Q
from graphloom.queries.registry import query, table

# -- quality -----------------------------------------------------------------------------------------


@query("""SELECT 'c_custkey' AS column_name, 'bigint' AS kind, count(*) AS n_rows, count(*) - count(c_custkey) AS nulls, count(DISTINCT c_custkey) AS n_distinct FROM customer
UNION ALL SELECT 'c_mktsegment', 'string', count(*), count(*) - count(c_mktsegment), count(DISTINCT c_mktsegment) FROM customer""")
def profile_nulls(spark, d):
    return Q.profile(table(spark, d, "customer").select("c_custkey", "c_mktsegment"))


_SPARSE = "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal, CASE WHEN c_custkey % 5 = 0 THEN 'N/A' ELSE c_mktsegment END AS seg FROM customer"


def _sparse(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("bal"), F.when(F.col("c_custkey") % 5 == 0, "N/A").otherwise(F.col("c_mktsegment")).alias("seg"))


@query(f"""WITH s AS ({_SPARSE}) SELECT 'bal' AS column_name, count(*) FILTER (bal IS NULL) AS missing, round(count(*) FILTER (bal IS NULL) * 100.0 / count(*), 6) AS percent FROM s
UNION ALL SELECT 'seg', count(*) FILTER (seg IS NULL OR seg IN ('', 'N/A', 'null', 'NULL')), round(count(*) FILTER (seg IS NULL OR seg IN ('', 'N/A', 'null', 'NULL')) * 100.0 / count(*), 6) FROM s""")
def missing_report(spark, d):
    return Q.missing_report(_sparse(spark, d), ["bal", "seg"]).withColumn("percent", F.round("percent", 6))


@query(f"""SELECT * FROM ({_SPARSE}) s WHERE bal IS NOT NULL AND seg <> 'N/A'""")
def missing_removed(spark, d):
    return Q.drop_missing(_sparse(spark, d), ["bal", "seg"])


@query(f"""SELECT c_custkey, coalesce(bal, -1.0) AS bal, CASE WHEN seg = 'N/A' THEN 'unknown' ELSE seg END AS seg FROM ({_SPARSE}) s""")
def missing_filled(spark, d):
    return Q.fill_missing(_sparse(spark, d), {"bal": -1.0, "seg": "unknown"})


@query(f"""WITH s AS ({_SPARSE}) SELECT c_custkey, round(coalesce(bal, (SELECT avg(bal) FROM s)), 4) AS bal FROM s""")
def impute_mean(spark, d):
    return Q.impute(_sparse(spark, d).select("c_custkey", "bal"), ["bal"], "mean").select("c_custkey", F.round("bal", 4).alias("bal"))


@query(f"""WITH s AS ({_SPARSE}), m AS (SELECT bal FROM (SELECT bal, row_number() OVER (ORDER BY bal) AS r, count(*) OVER () AS n FROM s WHERE bal IS NOT NULL) e WHERE r = n // 2 + 1) SELECT c_custkey, coalesce(bal, (SELECT bal FROM m)) AS bal FROM s""")
def impute_upper_median(spark, d):
    return Q.impute(_sparse(spark, d).select("c_custkey", "bal"), ["bal"], "median")


@query(f"""SELECT c_custkey, coalesce(bal, 0.0) AS bal FROM ({_SPARSE}) s""")
def impute_zero(spark, d):
    return Q.impute(_sparse(spark, d).select("c_custkey", "bal"), ["bal"], "zero")


@query(f"""WITH s AS ({_SPARSE}) SELECT c_custkey, 'bal' AS field, 'required' AS problem FROM s WHERE bal IS NULL UNION ALL SELECT c_custkey, 'seg', 'required' FROM s WHERE seg = 'N/A' UNION ALL SELECT c_custkey, 'range', 'constraint' FROM s WHERE bal < 0""")
def validate_required(spark, d):
    return Q.validation_errors(_sparse(spark, d), "c_custkey", ["bal", "seg"], {"bal": "double"}, {"range": Q.number_in("bal", 0)})


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 1 AND 10 AND l_returnflag IN ('A', 'N') AND length(l_linestatus) = 1""")
def numeric_constraints(spark, d):
    ok = Q.number_in("l_quantity", 1, 10) & Q.text_fits("l_returnflag", allowed=["A", "N"]) & Q.text_fits("l_linestatus", 1, 1)
    return table(spark, d, "lineitem").filter(ok).select("l_orderkey", "l_linenumber")


@query("""SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1""")
def duplicate_id_check(spark, d):
    return Q.duplicate_keys(table(spark, d, "part"), "p_name")


@query("""SELECT page_id, regexp_matches(url, '^https?://[^\\s/$.?#].[^\\s]*$') AS is_url, regexp_matches(url, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$') AS is_email FROM pages""")
def format_checks(spark, d):
    return table(spark, d, "pages").select("page_id", Q.is_url(F.col("url")).alias("is_url"), Q.is_email(F.col("url")).alias("is_email"))


@query("""SELECT text, min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1""")
def exact_dedup_groups(spark, d):
    return table(spark, d, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).filter("n > 1")


@query("""SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)""")
def exact_dedup_docs(spark, d):
    return Q.keep_first(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h")), ["h"], "doc_id").select("doc_id")


@query("""SELECT p_name, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand, arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY p_name""")
def merge_records(spark, d):
    return Q.merge_records(table(spark, d, "part").select("p_name", "p_partkey", "p_brand", "p_size"), ["p_name"], "p_partkey")


@query("""SELECT vec_id FROM embeddings WHERE label >= 3 AND label <> 5 AND vec_id < 400""")
def filter_and(spark, d):
    return table(spark, d, "embeddings").filter(Q.metadata_filter([("label", "gte", 3), ("label", "ne", 5), ("vec_id", "lt", 400)])).select("vec_id")


@query("""SELECT vec_id FROM embeddings WHERE label = 1 OR vec_id IN (2, 4, 6)""")
def filter_or(spark, d):
    return table(spark, d, "embeddings").filter(Q.metadata_filter([("label", "eq", 1), ("vec_id", "in", [2, 4, 6])], any_of=True)).select("vec_id")


@query(f"""SELECT c_custkey FROM ({_SPARSE}) s WHERE bal IS NOT NULL AND bal <> 0""")
def filter_ne_missing_false(spark, d):
    return _sparse(spark, d).filter(Q.metadata_filter([("bal", "ne", 0.0)])).select("c_custkey")


@query("""SELECT doc_id FROM documents WHERE contains(text, 'License')""")
def filter_contains(spark, d):
    return table(spark, d, "documents").filter(Q.metadata_filter([("text", "contains", "License")])).select("doc_id")


@query("""SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')""")
def filter_in(spark, d):
    return table(spark, d, "documents").filter(Q.metadata_filter([("lang", "in", ["de", "fr"])])).select("doc_id", "lang")


@query("""SELECT source AS value, count(*) AS n FROM documents GROUP BY source""")
def field_values(spark, d):
    return Q.field_values(table(spark, d, "documents"), "source")


# -- conflicts ---------------------------------------------------------------------------------------

#: Each order tells something about its customer's nation: its customer's segment and its own date and status.
_OBS = """obs AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS entity_id, u.property AS property, u.value AS value, o_orderpriority AS source,
         0.5 + (o_orderkey % 5) / 10.0 AS confidence, CAST(o_orderdate AS TIMESTAMP) AS ts, o_orderkey AS ord
  FROM orders JOIN customer ON o_custkey = c_custkey,
  LATERAL (SELECT unnest([{'property': 'segment', 'value': c_mktsegment}, {'property': 'type', 'value': CASE o_orderstatus WHEN 'F' THEN 'Person' WHEN 'O' THEN 'Company' ELSE 'Organization' END}, {'property': 'start_date', 'value': strftime(o_orderdate, '%Y-%m-%d')}], recursive := true)) u)"""


def _obs(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey"))
    kind = F.when(F.col("o_orderstatus") == "F", "Person").when(F.col("o_orderstatus") == "O", "Company").otherwise("Organization")
    o = o.withColumns({"segment": F.col("c_mktsegment"), "type": kind, "start_date": F.date_format("o_orderdate", "yyyy-MM-dd")})
    return C.observations(o, "c_nationkey", ["segment", "type", "start_date"], F.col("o_orderpriority"), 0.5 + (F.col("o_orderkey") % 5) / 10.0, F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey"))


_VALUE = """SELECT entity_id, property, count(*) AS n_records, count(DISTINCT value) AS n_values, count(DISTINCT source) AS n_sources,
  round(least(1.0, avg(confidence) * (1 + count(DISTINCT value) / count(*))), 6) AS confidence,
  CASE WHEN property = 'type' THEN 'critical' WHEN count(*) = count(TRY_CAST(value AS DOUBLE)) AND max(TRY_CAST(value AS DOUBLE)) - min(TRY_CAST(value AS DOUBLE)) > 1000 THEN 'high' ELSE 'medium' END AS severity
  FROM {0} GROUP BY entity_id, property HAVING count(*) >= 2 AND count(DISTINCT value) > 1"""


def _rounded(df):
    return df.withColumn("confidence", F.round("confidence", 6)).drop("action")


@query(f"WITH {_OBS} {_VALUE.format('obs')}")
def value_conflicts(spark, d):
    return _rounded(C.value_conflicts(_obs(spark, d)))


@query(f"WITH {_OBS}, t AS (SELECT * FROM obs WHERE property = 'type') {_VALUE.format('t')}")
def type_conflicts(spark, d):
    return _rounded(C.type_conflicts(_obs(spark, d)))


@query(f"WITH {_OBS}, t AS (SELECT * REPLACE (regexp_extract(value, '\\b(19\\d\\d|20\\d\\d)\\b', 1) AS value) FROM obs WHERE property = 'start_date') {_VALUE.format('t')}")
def temporal_conflicts(spark, d):
    return _rounded(C.temporal_conflicts(_obs(spark, d)))


@query(f"""WITH {_OBS}, t AS (SELECT DISTINCT entity_id, value FROM obs WHERE property = 'type')
SELECT a.entity_id, a.value AS first, b.value AS second, 'critical' AS severity FROM t a JOIN t b USING (entity_id) WHERE (a.value, b.value) IN (('Person', 'Organization'), ('Person', 'Company'), ('Organization', 'Person'), ('Company', 'Person'))""")
def logical_conflicts(spark, d):
    return C.logical_conflicts(_obs(spark, d))


@query("""SELECT l_orderkey || '_' || l_partkey AS rel_key, count(*) AS n_records, 'type' AS field, 0.8 AS confidence, 'medium' AS severity FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(DISTINCT l_returnflag) > 1
UNION ALL SELECT l_orderkey || '_' || l_partkey, count(*), 'confidence', 0.8, 'medium' FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(DISTINCT l_discount) > 1""".replace("0.8", "CAST(0.8 AS DOUBLE)"))
def relationship_conflicts(spark, d):
    rels = table(spark, d, "lineitem").select(F.concat_ws("_", "l_orderkey", "l_partkey").alias("rel_id"), F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("type"), F.col("l_discount").alias("confidence"))
    return C.relationship_conflicts(rels)


@query(f"""WITH {_OBS}, v AS ({_VALUE.format('obs')}), y AS (SELECT * REPLACE (regexp_extract(value, '\\b(19\\d\\d|20\\d\\d)\\b', 1) AS value) FROM obs WHERE property = 'start_date'), w AS ({_VALUE.format('y')}), t AS (SELECT DISTINCT entity_id, value FROM obs WHERE property = 'type')
SELECT 'value' AS kind, entity_id, property, severity FROM v UNION ALL SELECT 'type', entity_id, property, severity FROM v WHERE property = 'type' UNION ALL SELECT 'temporal', entity_id, property, severity FROM w
UNION ALL SELECT DISTINCT 'logical', a.entity_id, 'type', 'critical' FROM t a JOIN t b USING (entity_id) WHERE (a.value, b.value) IN (('Person', 'Organization'), ('Person', 'Company'), ('Organization', 'Person'), ('Company', 'Person'))""")
def entity_conflicts_all(spark, d):
    return C.all_conflicts(_obs(spark, d))


@query(f"""WITH {_OBS}, v AS ({_VALUE.format('obs')}) SELECT 'value' AS kind, severity, count(*) AS n FROM v GROUP BY severity UNION ALL SELECT 'value', NULL, count(*) FROM v UNION ALL SELECT NULL, severity, count(*) FROM v GROUP BY severity UNION ALL SELECT NULL, NULL, count(*) FROM v""")
def conflict_severity(spark, d):
    return C.conflict_report(C.value_conflicts(_obs(spark, d)).withColumn("kind", F.lit("value")))


_BEST = "SELECT entity_id, property, value, {1} AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, property ORDER BY {0}) AS r FROM {2}) e WHERE r = 1"


@query(f"""WITH {_OBS}, v AS (SELECT entity_id, property, value, count(*) AS n, min(ord) AS ord FROM obs GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY entity_id, property) AS total FROM v) {_BEST.format('n DESC, ord', 'round(n / total, 6)', 't')}""")
def resolve_voting(spark, d):
    return C.resolve_voting(_obs(spark, d)).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {_OBS}, v AS (SELECT entity_id, property, value, sum(confidence * CASE WHEN source LIKE '1%' THEN 0.9 ELSE 0.5 END) AS s, min(ord) AS ord FROM obs GROUP BY ALL), t AS (SELECT *, sum(s) OVER (PARTITION BY entity_id, property) AS total FROM v) {_BEST.format('round(s, 9) DESC, ord', 'round(s / total, 5)', 't')}""")
def resolve_credibility(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("source")).distinct().filter("source like '1%'").withColumn("weight", F.lit(0.9))
    return C.resolve_credibility(_obs(spark, d), o).withColumn("confidence", F.round("confidence", 5))


@query(f"WITH {_OBS} {_BEST.format('ts DESC, ord', 'CAST(0.8 AS DOUBLE)', 'obs')}")
def resolve_most_recent(spark, d):
    return C.resolve_most_recent(_obs(spark, d))


@query(f"WITH {_OBS} {_BEST.format('ord', 'CAST(0.7 AS DOUBLE)', 'obs')}")
def resolve_first_seen(spark, d):
    return C.resolve_first_seen(_obs(spark, d))


@query(f"WITH {_OBS} {_BEST.format('confidence DESC, ord', 'round(CAST(confidence AS DOUBLE), 6)', 'obs')}")
def resolve_highest_confidence(spark, d):
    return C.resolve_highest_confidence(_obs(spark, d)).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {_OBS} SELECT entity_id, property, value, 'first_seen' AS strategy FROM ({_BEST.format('ord', '0', "(SELECT * FROM obs WHERE property = 'segment')")}) a UNION ALL SELECT entity_id, property, value, 'most_recent' FROM ({_BEST.format('ts DESC, ord', '0', "(SELECT * FROM obs WHERE property <> 'segment')")}) b""")
def resolve_by_rules(spark, d):
    return C.resolve(_obs(spark, d), "most_recent", {"segment": "first_seen"}).drop("confidence")


@query(f"""WITH {_OBS}, v AS ({_VALUE.format('obs')}) SELECT source, count(DISTINCT (entity_id, property)) AS n FROM obs JOIN v USING (entity_id, property) GROUP BY source ORDER BY n DESC, source LIMIT 10""".replace("SELECT source, count", "SELECT obs.source AS source, count"))
def conflict_by_source(spark, d):
    return C.conflicts_by_source(_obs(spark, d))


@query(f"""WITH {_OBS}, v AS ({_VALUE.format('obs')}) SELECT 'property' AS pattern, property AS name, count(DISTINCT entity_id) AS n FROM v GROUP BY property HAVING count(DISTINCT entity_id) > 3 UNION ALL SELECT 'source', obs.source, count(DISTINCT (entity_id, property)) FROM obs JOIN v USING (entity_id, property) GROUP BY obs.source HAVING count(DISTINCT (entity_id, property)) > 5""")
def conflict_patterns(spark, d):
    return C.conflict_patterns(_obs(spark, d))


@query("""WITH n AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY ALL), l AS (SELECT *, lag(n) OVER (ORDER BY period) AS previous FROM n)
SELECT *, CASE WHEN previous IS NULL THEN 'first' WHEN n > previous * 1.1 THEN 'increasing' WHEN n < previous * 0.9 THEN 'decreasing' ELSE 'stable' END AS trend FROM l""")
def conflict_trends(spark, d):
    return C.trends(table(spark, d, "orders"), "o_orderdate")


@query(f"""WITH {_OBS}, s AS (SELECT DISTINCT entity_id, property, value, source FROM obs) SELECT a.entity_id, a.property, CAST(count(*) / 2 AS BIGINT) AS n_pairs FROM s a JOIN s b ON a.entity_id = b.entity_id AND a.property = b.property AND a.value <> b.value GROUP BY ALL""")
def source_disagreements(spark, d):
    return C.source_disagreements(_obs(spark, d))


@query(f"""WITH {_OBS} SELECT entity_id, property, count(DISTINCT source) AS n_sources, min(ts) AS first_seen, max(ts) AS last_updated, arg_max(value, (ts, ord)) AS latest FROM obs GROUP BY ALL""")
def provenance_summary(spark, d):
    return C.provenance(_obs(spark, d)).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_updated")})


# -- dedup -------------------------------------------------------------------------------------------

_PARTS = "e AS (SELECT p_partkey AS ord, p_name AS name FROM part WHERE p_name IS NOT NULL)"
_SCORE = "CASE WHEN lower(a.name) = lower(b.name) THEN 1.0 ELSE 1 - levenshtein(lower(a.name), lower(b.name)) / greatest(length(a.name), length(b.name)) END"
_DUP = f"d AS (SELECT a.ord AS a, b.ord AS b, round({_SCORE}, 6) AS score FROM e a JOIN e b ON a.ord < b.ord AND a.name[1] = b.name[1] AND {_SCORE} >= 0.8)"


def _part_names(spark, d):
    """All parts as (ord, name)."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"))


def _lev(a, b):
    return F.when(F.lower(a) == F.lower(b), 1.0).otherwise(S.levenshtein(a, b))


@query(f"""WITH {_PARTS}, n AS (SELECT DISTINCT name FROM e), s AS (SELECT a.name AS m, b.name AS n, round({_SCORE}, 6) AS score FROM n a JOIN n b ON a.name < b.name AND a.name[1] = b.name[1] AND {_SCORE} >= 0.5) SELECT * FROM s""")
def dup_names_blocked(spark, d):
    names = _part_names(spark, d).groupBy("name").agg(F.min("ord").alias("ord"))
    pairs = DD.candidate_pairs(names, 0.5, _lev)
    a, b = names.select(F.col("ord").alias("a"), F.col("name").alias("x")), names.select(F.col("ord").alias("b"), F.col("name").alias("y"))
    return pairs.join(a, "a").join(b, "b").select(F.least("x", "y").alias("m"), F.greatest("x", "y").alias("n"), F.round("score", 6).alias("score"))


_CUST = "e AS (SELECT c_custkey AS ord, c_name AS name, c_mktsegment AS seg, c_acctbal AS bal FROM customer)"


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT p_name AS name FROM part), l AS (SELECT a.name AS a, b.name AS b FROM e a JOIN e b ON a.name <> b.name AND a.name[1] = b.name[1] AND {_SCORE} >= 0.6), r(a, c) AS (SELECT a, a FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.c = l.a) SELECT a AS name, min(c) AS component FROM r GROUP BY a""")
def dup_groups(spark, d):
    from graphloom.operators import graph

    names = _part_names(spark, d).groupBy("name").agg(F.min("ord").alias("ord"))
    pairs = DD.candidate_pairs(names, 0.6, _lev)
    a, b = names.select(F.col("ord").alias("a"), F.col("name").alias("src")), names.select(F.col("ord").alias("b"), F.col("name").alias("dst"))
    return graph.connected_components(pairs.join(a, "a").join(b, "b").select("src", "dst")).select(F.col("node").alias("name"), "component")


_GROUPED = "g AS (SELECT p_name AS component, p_partkey AS ord, p_brand AS brand, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS size, p_retailprice / 10000 AS confidence FROM part)"


def _grouped(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_name").alias("component"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("size"), (F.col("p_retailprice") / 10000).alias("confidence"))


@query(f"""WITH {_GROUPED} SELECT component, min(ord) AS base_ord, count(*) AS n_merged, arg_min(brand, ord) AS brand, arg_min(size, ord) FILTER (size IS NOT NULL) AS size FROM g GROUP BY component""")
def merge_keep_first(spark, d):
    return DD.merge_groups(_grouped(spark, d), "keep_first", ["brand", "size"])


@query(f"""WITH {_GROUPED} SELECT component, max(ord) AS base_ord, count(*) AS n_merged, arg_max(brand, ord) AS brand, arg_max(size, ord) FILTER (size IS NOT NULL) AS size FROM g GROUP BY component""")
def merge_keep_last(spark, d):
    return DD.merge_groups(_grouped(spark, d), "keep_last", ["brand", "size"])


@query(f"""WITH {_GROUPED}, r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY (size IS NOT NULL)::INT DESC, ord) AS r FROM g) SELECT component, arg_min(ord, r) AS base_ord, count(*) AS n_merged, arg_min(brand, r) AS brand, arg_min(size, r) FILTER (size IS NOT NULL) AS size FROM r GROUP BY component""")
def merge_most_complete(spark, d):
    return DD.merge_groups(_grouped(spark, d), "keep_most_complete", ["brand", "size"])


@query(f"""WITH {_GROUPED}, r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY confidence DESC, ord) AS r FROM g) SELECT component, arg_min(ord, r) AS base_ord, count(*) AS n_merged, arg_min(brand, r) AS brand, arg_min(size, r) FILTER (size IS NOT NULL) AS size FROM r GROUP BY component""")
def merge_highest_confidence(spark, d):
    return DD.merge_groups(_grouped(spark, d), "keep_highest_confidence", ["brand", "size"])


@query(f"""WITH {_GROUPED} SELECT component, min(ord) AS base_ord, count(*) AS n_merged, array_to_string(list_sort(list_distinct(list(brand))), ',') AS brand FROM g GROUP BY component""")
def merge_all(spark, d):
    return DD.merge_groups(_grouped(spark, d), "merge_all", ["brand"]).withColumn("brand", F.array_join("brand", ","))


@query(f"""WITH {_GROUPED} SELECT component, arg_max(ord, ((size IS NOT NULL)::INT, -ord)) AS ord FROM g GROUP BY component""")
def representatives(spark, d):
    return DD.representative(_grouped(spark, d), F.when(F.col("size").isNotNull(), 1).otherwise(0))


@query("""SELECT s_suppkey AS k, s_name AS name FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'x' || s_name FROM supplier WHERE s_suppkey % 2 = 1""")
def seed_first(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return DD.seed_first(s.filter("k % 2 = 0"), s.withColumn("name", F.concat(F.lit("x"), "name")), ["k"])


@query("""SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'x' || s_name END AS name FROM supplier""")
def seed_merge(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return DD.seed_merge(s.filter("k % 2 = 0"), s.withColumn("name", F.concat(F.lit("x"), "name")), ["k"])


@query()
def leader_clusters(spark, d):
    n = _part_names(spark, d).groupBy("name").agg(F.min("ord").alias("ord")).withColumn("f", F.substring("name", 1, 1))
    return DD.leader_clusters(n, "f", "name", "ord", 0.3)


@query()
def agglomerative(spark, d):
    n = _part_names(spark, d).groupBy("name").agg(F.min("ord").alias("ord"))
    return DD.agglomerative(n, None, "name", "ord", 0.3, 0.2)


@query("""WITH n AS (SELECT min(p_partkey) AS k, list_distinct(string_split(lower(p_name), ' ')) AS s FROM part GROUP BY p_name), j AS (SELECT a.k AS a, b.k AS b, len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) AS x FROM n a JOIN n b ON a.k < b.k) SELECT a, b, round(x, 6) AS similarity FROM j WHERE x >= 0.3""")
def word_overlap_links(spark, d):
    n = _part_names(spark, d).groupBy("name").agg(F.min("ord").alias("k"))
    return DD.word_overlap_pairs(n, "k", "name", 0.3).withColumn("similarity", F.round("similarity", 6))
