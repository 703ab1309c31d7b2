"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import dates as D
from graphloom.functions import numbers as N
from graphloom.functions import similarity as S
from graphloom.functions import text as T
from graphloom.queries.registry import query, table


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(9), ' '), '\\r\\n?', chr(10), 'g'), ' +', ' ', 'g'), '\\n[ \\n]*\\n', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS clean FROM documents""")
def ws_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", F.trim(T.normalize_whitespace(F.col("text"))).alias("clean"))


@query("""SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS clean FROM documents""")
def text_compact(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query("""SELECT doc_id, replace(replace(translate(text, '‘’“”–', '''''""-'), '—', '--'), '…', '...') AS clean FROM documents""")
def punct_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", T.punctuation(F.col("text")).alias("clean"))


@query("""SELECT page_id, replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', chr(1), 'g'), '&[a-zA-Z]+;|&#[0-9]+;', '', 'g'), chr(1), '&') AS clean FROM pages""")
def html_strip(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_html(F.col("html")).alias("clean"))


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS clean FROM pages""")
def html_visible_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.visible_text(F.col("html")).alias("clean"))


@query("""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages""")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", T.html_title(F.col("html")).alias("title"))


@query("""SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a[^>]*\\shref=["'']([^"'']*)["'']', 1)) AS link FROM pages) e GROUP BY ALL""")
def html_links(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.explode(T.html_links(F.col("html"))).alias("link"))
    return rows.groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query("""SELECT page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || link AS target FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a[^>]*\\shref=["'']([^"'']*)["'']', 1)) AS link FROM pages) e WHERE link LIKE '/%' AND link NOT LIKE '//%'""")
def html_absolute_links(spark, d):
    rows = table(spark, d, "pages").select("page_id", "url", F.explode(T.html_links(F.col("html"))).alias("link")).filter("link like '/%' and link not like '//%'")
    return rows.select("page_id", T.absolute_url(F.col("url"), F.col("link")).alias("target"))


@query("""SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g') AS clean FROM documents""")
def special_char_strip(spark, d):
    return table(spark, d, "documents").select("doc_id", T.special_characters(F.col("text")).alias("clean"))


@query("""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<iframe[^>]*>.*?</iframe>', '', 'g'), '(?i)javascript:', '', 'g') AS clean FROM pages""")
def sanitize_scripts(spark, d):
    return table(spark, d, "pages").select("page_id", T.sanitize(F.col("html")).alias("clean"))


@query("""SELECT doc_id, lower(text) AS low, upper(lang) AS up FROM documents""")
def case_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", T.change_case(F.col("text"), "lower").alias("low"), T.change_case(F.col("lang"), "upper").alias("up"))


@query("""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS clean FROM documents""")
def trim_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", T.trim_lines(F.col("text")).alias("clean"))


@query("""SELECT page_id, regexp_replace(url, '[<>:"/\\\\|?*\\x00-\\x1f]', '_', 'g')[1:255] AS name FROM pages""")
def slug_filename(spark, d):
    return table(spark, d, "pages").select("page_id", T.safe_filename(F.col("url")).alias("name"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: upper(w[1]) || lower(w[2:])), '') AS name FROM part""")
def pascal_case(spark, d):
    return table(spark, d, "part").select("p_partkey", T.pascal_case(F.col("p_name")).alias("name"))


@query("""SELECT p_partkey, lower(n[1]) || n[2:] AS name FROM (SELECT p_partkey, array_to_string(list_transform(string_split(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: upper(w[1]) || lower(w[2:])), '') AS n FROM part) e""")
def camel_case(spark, d):
    return table(spark, d, "part").select("p_partkey", T.camel_case(F.col("p_name")).alias("name"))


@query("""SELECT DISTINCT p_type, CASE WHEN p_type LIKE '%ies' THEN regexp_replace(p_type, 'ies$', 'y') WHEN regexp_matches(p_type, '[^s]s$') THEN regexp_replace(p_type, 's$', '') ELSE p_type END AS one FROM part""")
def singular_names(spark, d):
    return table(spark, d, "part").select("p_type", T.singular(F.col("p_type")).alias("one")).distinct()


@query("""SELECT c_custkey, trim(regexp_replace('Dr. ' || c_name, '(?i)^(Mr|Mrs|Ms|Dr|Prof|Sir|Madam)\\.?\\s+', '')) AS name, 'Organization' AS kind FROM customer""")
def name_normalize(spark, d):
    c = table(spark, d, "customer").withColumn("titled", F.concat(F.lit("Dr. "), "c_name"))
    return c.select("c_custkey", T.strip_honorific(F.col("titled")).alias("name"), T.entity_kind(F.col("c_name")).alias("kind"))


@query("""SELECT doc_id, sha256(text) AS digest FROM documents""")
def sha256_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.sha256(F.col("text")).alias("digest"))


@query()
def unicode_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.unicode_form(F.col("text"), "NFC"), 256).alias("nfc"), F.sha2(T.strip_diacritics(F.col("text")), 256).alias("plain"))


@query()
def stop_word_language(spark, d):
    return table(spark, d, "documents").select("doc_id", T.language(F.col("text")).alias("language"))


# -- numbers and dates -----------------------------------------------------------------------------


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) AS value, 'kilogram' AS unit, CAST(p_size * 1000.0 AS DOUBLE) AS grams FROM part""")
def quantity_parse(spark, d):
    q = table(spark, d, "part").select("p_partkey", N.quantity(F.concat(F.col("p_size").cast("string"), F.lit(" kg"))).alias("q"))
    return q.select("p_partkey", "q.value", "q.unit", N.convert_units(F.col("q.value"), F.col("q.unit"), F.lit("g")).alias("grams"))


@query("""SELECT p_partkey, round(CAST(p_size AS DOUBLE) * 1000, 6) AS meters, round(p_size / 0.0254, 6) AS inches, CAST(NULL AS DOUBLE) AS wrong FROM part""")
def unit_convert(spark, d):
    s = F.col("p_size").cast("double")
    return table(spark, d, "part").select("p_partkey", F.round(N.convert_units(s, F.lit("km"), F.lit("meter")), 6).alias("meters"), F.round(N.convert_units(s, F.lit("meters"), F.lit("inch")), 6).alias("inches"), N.convert_units(s, F.lit("kg"), F.lit("meter")).alias("wrong"))


@query("""SELECT s_suppkey, round(s_acctbal * CASE s_nationkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.25 WHEN 2 THEN 0.5 END / 1.25, 6) AS pounds FROM supplier""")
def currency_convert(spark, d):
    code = F.element_at(F.array(F.lit("USD"), F.lit("gbp"), F.lit("CHF"), F.lit("XXX")), (F.col("s_nationkey") % 4 + 1).cast("int"))
    return table(spark, d, "supplier").select("s_suppkey", F.round(N.convert_money(F.col("s_acctbal"), code, "GBP", {"USD": 1.0, "GBP": 1.25, "CHF": 0.5}), 6).alias("pounds"))


@query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, 'EUR' AS currency FROM orders""")
def currency_parse(spark, d):
    m = table(spark, d, "orders").select("o_orderkey", N.money(F.concat(F.lit("€"), F.format_number("o_totalprice", 2))).alias("m"))
    return m.select("o_orderkey", "m.amount", "m.currency")


@query("""SELECT p_partkey, CAST(p_size * 1000 AS DOUBLE) AS kilo, p_size / 100.0 AS percent, CAST(p_size AS DOUBLE) AS plain, CAST(p_size * 100 AS DOUBLE) AS sci FROM part""")
def suffix_number(spark, d):
    s = F.col("p_size").cast("string")
    return table(spark, d, "part").select("p_partkey", *(N.parse_number(F.concat(s, F.lit(x))).alias(n) for x, n in (("k", "kilo"), ("%", "percent"), ("", "plain"), ("e2", "sci"))))


@query("""SELECT p_partkey, round(round(p_retailprice * power(10, 2 - floor(log10(abs(p_retailprice))))) / power(10, 2 - floor(log10(abs(p_retailprice)))), 6) AS price FROM part""")
def significant_digits(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(N.significant_digits(F.col("p_retailprice"), 3), 6).alias("price"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def date_to_iso(spark, d):
    o = table(spark, d, "orders").withColumn("t", F.date_format("o_orderdate", "yyyy/MM/dd"))
    return o.select("o_orderkey", D.normalize_date(F.col("t")).alias("iso"), D.normalize_date(F.col("t"), "date").alias("day"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) - 3 AS ago, CAST(o_orderdate AS DATE) + 14 AS later, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS months, CAST(o_orderdate AS DATE) - 1 AS yesterday FROM orders""")
def relative_date(spark, d):
    day = F.to_date("o_orderdate")
    exprs = (("3 days", "ago"), ("2 weeks from now", "later"), ("2 months later", "months"), ("yesterday", "yesterday"))
    return table(spark, d, "orders").select("o_orderkey", *(D.relative_date(F.lit(e), day).alias(n) for e, n in exprs))


@query("""SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h FROM events""")
def date_parts(spark, d):
    return table(spark, d, "events").select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.dayofmonth("ts").alias("d"), F.hour("ts").alias("h"))


@query("""SELECT event_id, strftime(timezone('America/New_York', timezone('UTC', CAST(ts AS TIMESTAMP))), '%Y-%m-%d %H:%M:%S') AS local FROM events""")
def tz_convert(spark, d):
    return table(spark, d, "events").select("event_id", F.date_format(D.in_zone(F.col("ts"), "America/New_York"), "yyyy-MM-dd HH:mm:ss").alias("local"))


@query("""SELECT c_custkey, '2023-01-01' AS s, '2023-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS e FROM customer""")
def date_range_parse(spark, d):
    t = F.concat(F.lit("from 2023-01-01 to 2023-01-"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"))
    r = table(spark, d, "customer").select("c_custkey", D.date_range(t).alias("r"))
    return r.select("c_custkey", F.col("r.start").alias("s"), F.col("r.end").alias("e"))


# -- json --------------------------------------------------------------------------------------------


@query("""SELECT event_id, props ->> '$.k' AS k, CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events""")
def json_extract_path(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))


@query("""SELECT event_id, k AS key, props ->> k AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) e""")
def json_flatten(spark, d):
    return table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


# -- similarity ----------------------------------------------------------------------------------------

_NAMES = "WITH n AS (SELECT DISTINCT p_name AS name FROM part), p AS (SELECT a.name AS a, b.name AS b FROM n a JOIN n b ON a.name < b.name AND a.name[1] = b.name[1])"


def _pairs(spark, d):
    """Distinct names that begin alike."""
    n = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct().withColumn("f", F.substring("name", 1, 1))
    return n.alias("x").join(n.alias("y"), F.expr("x.f = y.f and x.name < y.name")).select(F.col("x.name").alias("a"), F.col("y.name").alias("b"))


@query(f"""{_NAMES} SELECT a, b, round(1 - levenshtein(lower(a), lower(b)) / greatest(length(a), length(b)), 6) AS score FROM p""")
def sim_levenshtein(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.levenshtein(F.col("a"), F.col("b")), 6).alias("score"))


_GRAMS = "list_distinct(list_transform(generate_series(1, length({0}) - 1), lambda i: lower({0})[i : i + 1]))"
_JACCARD = "round(len(list_intersect({0}, {1})) / len(list_distinct(list_concat({0}, {1}))), 6)"


@query(f"""{_NAMES} SELECT a, b, {_JACCARD.format(_GRAMS.format('a'), _GRAMS.format('b'))} AS score FROM p""")
def sim_bigram_jaccard(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.bigram_jaccard(F.col("a"), F.col("b")), 6).alias("score"))


@query(f"""{_NAMES} SELECT a, b, {_JACCARD.format("list_distinct(string_split(lower(a), ' '))", "list_distinct(string_split(lower(b), ' '))")} AS score FROM p""")
def sim_word_jaccard(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.word_jaccard(F.col("a"), F.col("b")), 6).alias("score"))


@query(f"""{_NAMES} SELECT a, b, {_JACCARD.format("list_distinct(string_split(lower(a), ''))", "list_distinct(string_split(lower(b), ''))")} AS score FROM p""")
def sim_charset(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.character_jaccard(F.col("a"), F.col("b")), 6).alias("score"))


@query(f"""{_NAMES}, t AS (SELECT a, b, string_split(lower(a), ' ') AS x, string_split(lower(b), ' ') AS y FROM p)
SELECT a, b, round(list_sum(list_transform(list_distinct(x), lambda w: len(list_filter(x, lambda u: u = w)) * len(list_filter(y, lambda u: u = w)))) / (sqrt(list_sum(list_transform(list_distinct(x), lambda w: power(len(list_filter(x, lambda u: u = w)), 2)))) * sqrt(list_sum(list_transform(list_distinct(y), lambda w: power(len(list_filter(y, lambda u: u = w)), 2))))), 6) AS score FROM t""")
def sim_tf_cosine(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.term_cosine(F.col("a"), F.col("b")), 6).alias("score"))


@query()
def sim_jaro_winkler(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.jaro_winkler(F.col("a"), F.col("b")), 6).alias("score"))


@query()
def sim_sequence_ratio(spark, d):
    return _pairs(spark, d).select("a", "b", F.round(S.sequence_ratio(F.col("a"), F.col("b")), 6).alias("score"))


_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"


@query(f"""SELECT a.vec_id AS a, b.vec_id AS b, round(({_DOT.format('a.embedding', 'b.embedding')} / (sqrt({_DOT.format('a.embedding', 'a.embedding')}) * sqrt({_DOT.format('b.embedding', 'b.embedding')})) + 1) / 2, 5) AS score FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def sim_embedding(spark, d):
    e = table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"), F.col("vec_id").alias("b"))
    return e.join(b, "vec_id").select(F.col("vec_id").alias("a"), "b", F.round(S.embedding_similarity(F.col("embedding"), F.col("other")), 5).alias("score"))


@query(f"""{_NAMES}, s AS (SELECT a, b, 1 - levenshtein(lower(a), lower(b)) / greatest(length(a), length(b)) AS st, len(list_intersect(string_split(a, ' '), string_split(b, ' '))) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' ')))) AS re FROM p)
SELECT a, b, round((st * 0.6 + 0.2 + re * 0.2) / 1.0, 6) AS score FROM s""")
def sim_multifactor(spark, d):
    a, b = F.col("a"), F.col("b")
    empty = F.create_map().cast("map<string,string>")
    score = S.multifactor(S.levenshtein(a, b), S.property_similarity(empty, empty), S.relation_similarity(F.split(a, " "), F.split(b, " ")))
    return _pairs(spark, d).select("a", "b", F.round(score, 6).alias("score"))


@query(f"""SELECT c1.c_custkey AS a, c2.c_custkey AS b, round((CASE WHEN c1.c_mktsegment = c2.c_mktsegment THEN 1 ELSE 1 - levenshtein(lower(c1.c_mktsegment), lower(c2.c_mktsegment)) / greatest(length(c1.c_mktsegment), length(c2.c_mktsegment)) END + 0.5) / 2, 6) AS score FROM customer c1 JOIN customer c2 ON c2.c_custkey = c1.c_custkey + 1""")
def sim_property(spark, d):
    c = table(spark, d, "customer")
    x = c.select("c_custkey", F.create_map(F.lit("segment"), "c_mktsegment").alias("m"))
    y = c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("extra"), F.lit("x")).alias("o"))
    return x.join(y, "c_custkey").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 1).alias("b"), F.round(S.property_similarity(F.col("m"), F.col("o")), 6).alias("score"))
