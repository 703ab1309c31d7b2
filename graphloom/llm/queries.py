"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path)
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Canonical URLs that the URL filter lists.
URL_LIST = [
    "ads-track.example.com/",
    "casino-win.example.com/",
    "cheap-pills.example.com/",
    "free-bets.example.com/",
    "casino-win.example.net/",
    "cheap-pills.example.net/",
    "free-bets.example.org/",
    "ads-track.example.org/",
]


#: How many further hosts the list holds, made by a rule, so that the filter has work.
MORE_HOSTS = 60_000


def listed_urls(spark: SparkSession) -> DataFrame:
    """The listed canonical URLs: URL_LIST, and MORE_HOSTS made by a rule."""
    named = spark.range(1).select(F.explode(F.array(*map(F.lit, URL_LIST))).alias("key"))
    made = F.concat(F.lit("bulk"), F.col("id"), F.lit(".example."), F.element_at(F.array(*map(F.lit, ("com", "net", "org"))), (F.col("id") % 3 + 1).cast("int")), F.lit("/"))
    return named.unionByName(spark.range(MORE_HOSTS).select(made.alias("key")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.vectors import cross_polytope_search

    return cross_polytope_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op2_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.langid import identify_languages

    return identify_languages(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), 5, 75)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), 4096)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), 13)


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.vectors import pivot_topk

    return pivot_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op8_gbt_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.html import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_piece_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces under dropout, and the digest of what they decode to."""
    from graphloom.llm.pieces import decode_pieces, encode_pieces

    decoded = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), 0.1, 7))
    return decoded.select("doc_id", "n_pieces", "ids_crc32", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("decoded_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.urls import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, listed_urls(spark))


def op11_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_adaptive_bounds_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.centroids import cluster_vectors

    return cluster_vectors(table(spark, sf_dir, "embeddings"), 8, 10, 64, "3:", 1024.0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 5, 10, 30, 90, 256.0, label=label)


SQL_OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0) e),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT id, b FROM reach JOIN links ON r = a),
least AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least ON id = doc_id LEFT JOIN n USING (doc_id)
"""

SQL_OP6 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM w WHERE len(w) >= 13) e),
first AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i
  FROM win JOIN first USING (s) WHERE doc_id > first),
kept AS (
  SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM w) e
  ANTI JOIN gone USING (doc_id, i)),
texts AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN texts USING (doc_id)
"""

SQL_OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

_LISTED = ", ".join(f"('{u}')" for u in URL_LIST)
SQL_OP10 = f"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
fit AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) d
  JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
listed(key) AS (
  SELECT * FROM (VALUES {_LISTED}) v UNION ALL
  SELECT 'bulk' || i || '.example.' || ['com', 'net', 'org'][i % 3 + 1] || '/' FROM range({MORE_HOSTS}) r(i)),
keys AS (
  SELECT host, path, string_split(host, '.') AS l,
         regexp_replace(regexp_replace(path, '(/index)?\\.(html?|php|aspx?)$', ''), '/+$', '') AS page
  FROM (SELECT DISTINCT host, path FROM u WHERE host <> '') d),
forms AS (
  SELECT host, path, page, array_to_string(l[i:], '.') AS suffix
  FROM (SELECT *, unnest(generate_series(1, greatest(len(l) - 1, 1))) AS i FROM keys) e),
hits AS (
  SELECT host, path, min(key) AS listed_as
  FROM forms JOIN listed ON key = suffix || '/' OR key = suffix || page GROUP BY ALL)
SELECT page_id, u.host, u.path, rule,
       coalesce(fit.verdict, CASE WHEN listed_as IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN fit.verdict IS NULL THEN listed_as END AS listed_as
FROM u LEFT JOIN fit ON fit.host = u.host AND fit.path = u.path
LEFT JOIN hits ON hits.host = u.host AND hits.path = u.path
"""


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    """Each round as a pair of common table expressions: a{t} assigns all vectors, c{t} has the centroids before it."""
    parts = ["""v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), vec_id, v) - 1 AS INTEGER) AS c, v AS z FROM v
  WHERE vec_id IS NOT NULL QUALIFY c < {k})"""]  # fmt: skip
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (
  SELECT n, min(struct_pack(d := d, c := c)) AS s FROM (
    SELECT n, c, CAST(list_sum(list_transform(list_zip(v, z), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{t}) p GROUP BY n)""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT c{t}.c, coalesce(m.z, c{t}.z) AS z FROM c{t} LEFT JOIN (
    SELECT c, list(CAST((x - ((x % m) + m) % m) // m AS BIGINT) ORDER BY i) AS z FROM (
      SELECT s.c AS c, i, sum(v[i]) AS x, count(*) AS m FROM a{t} JOIN v USING (n), generate_series(1, 64) g(i) GROUP BY ALL) u GROUP BY c) m ON m.c = c{t}.c)""")
    return f"""WITH {", ".join(parts)},
f AS (SELECT vec_id, s.c AS cluster, s.d AS distance FROM a{rounds} JOIN v USING (n))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(z, ',')) AS centroid_sha256
FROM f JOIN c{rounds} ON c = cluster"""


SQL_OP12 = _clustering_sql()

SQL_OP13 = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT q.vec_id AS anchor_id, q.label AS own, c.vec_id AS vec_id, c.label AS label,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_cross_polytope_ann": op1_cross_polytope_ann,
        "op2_crf_language_id": op2_crf_language_id,
        "op3_minhash_near_dedup": op3_minhash_near_dedup,
        "op4_license_scan": op4_license_scan,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_pivot_topk": op7_pivot_topk,
        "op8_gbt_html_extraction": op8_gbt_html_extraction,
        "op9_piece_merge_dropout": op9_piece_merge_dropout,
        "op10_url_filter": op10_url_filter,
        "op11_cnn_toxicity": op11_cnn_toxicity,
        "op12_adaptive_bounds_clustering": op12_adaptive_bounds_clustering,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_minhash_near_dedup": SQL_OP3, "op6_substring_dedup": SQL_OP6, "op7_pivot_topk": SQL_OP7, "op10_url_filter": SQL_OP10, "op12_adaptive_bounds_clustering": SQL_OP12, "op13_hard_negatives": SQL_OP13}
