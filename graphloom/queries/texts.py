"""Queries of chunking and extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import chunking as K
from graphloom.operators import extract as X
from graphloom.operators import graph_chunking as GC
from graphloom.operators import memory as M
from graphloom.operators import relations as RL
from graphloom.queries.registry import query, table


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@query("""SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(i * 800 AS INTEGER) AS start, CAST(least(i * 800 + 1000, length(text)) AS INTEGER) AS "end", text[i * 800 + 1 : i * 800 + 1000] AS text FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(CAST(ceil((length(text) - 200) / 800) AS BIGINT) - 1, 0))) AS i FROM documents WHERE length(text) > 0) e""")
def chunk_chars(spark, d):
    return K.by_characters(_docs(spark, d), "doc_id", "text")


@query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents), c AS (SELECT doc_id, w, unnest(generate_series(0, greatest(CAST(ceil((len(w) - 40) / 160) AS BIGINT) - 1, 0))) AS i FROM w WHERE len(w) > 0) SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, CAST(len(w[i * 160 + 1 : i * 160 + 200]) AS INTEGER) AS n_words, array_to_string(w[i * 160 + 1 : i * 160 + 200], ' ') AS text FROM c""")
def chunk_words(spark, d):
    return K.by_words(_docs(spark, d), "doc_id", "text")


@query("""SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, text[i * 500 + 1 : i * 500 + 500] AS text FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(CAST(ceil(length(text) / 500) AS BIGINT) - 1, 0))) AS i FROM documents WHERE length(text) > 0) e""")
def chunk_sliding(spark, d):
    return K.sliding(_docs(spark, d), "doc_id", "text", 500, 500).select("doc_id", "chunk_index", "text")


_SENT = "s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents)"


@query(f"""WITH {_SENT}, c AS (SELECT doc_id, s, unnest(generate_series(0, CAST(ceil(len(s) / 5) AS BIGINT) - 1)) AS i FROM s WHERE len(s) > 0) SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, array_to_string(s[i * 5 + 1 : i * 5 + 5], ' ') AS text FROM c""")
def chunk_sentences(spark, d):
    return K.sentence_groups(_docs(spark, d), "doc_id", "text", 5)


@query()
def chunk_sentences_packed(spark, d):
    return K.by_sentences(_docs(spark, d), "doc_id", "text", 1000)


@query()
def chunk_paragraphs(spark, d):
    return K.by_paragraphs(_docs(spark, d), "doc_id", "text")


@query()
def chunk_recursive(spark, d):
    return K.recursive(_docs(spark, d), "doc_id", "text")


@query()
def chunk_hierarchical(spark, d):
    return K.hierarchical(_docs(spark, d), "doc_id", "text")


@query()
def chunk_entity_aware(spark, d):
    return K.entity_aware(_docs(spark, d), "doc_id", "text", r"[A-Z][a-z]{4,}")


@query()
def chunk_semantic(spark, d):
    return K.semantic(_docs(spark, d), "doc_id", "text", 0.05)


_PARTS = f"{_SENT}, p AS MATERIALIZED (SELECT doc_id, unnest(s) AS x, generate_subscripts(s, 1) - 1 AS pos FROM s)"
_LINKS = f"{_PARTS}, l AS MATERIALIZED (SELECT DISTINCT doc_id, pos, lower(unnest(regexp_extract_all(x, '[A-Z][a-z]{{2,}}'))) AS entity FROM p)"
_COMMONEST = "(SELECT doc_id, {0}, arg_max(label, (n, -label)) AS label FROM (SELECT doc_id, {0}, label, count(*) AS n FROM l JOIN {1} GROUP BY ALL) v GROUP BY doc_id, {0})"
_PROPAGATED = "b0 AS (SELECT DISTINCT doc_id, pos, pos AS label FROM l)" + "".join(
    f", e{t} AS MATERIALIZED {_COMMONEST.format('entity', f'b{t} USING (doc_id, pos)')}, b{t + 1} AS MATERIALIZED {_COMMONEST.format('pos', f'e{t} USING (doc_id, entity)')}" for t in range(3)
)
_CARRIED = "last_value({} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_GROUPED = f"""c AS (SELECT doc_id, pos, x, coalesce({_CARRIED.format('label')}, -1) AS label FROM p LEFT JOIN b3 USING (doc_id, pos)),
g AS (SELECT doc_id, label, min(pos) AS first, count(*) AS n, string_agg(x, ' ' ORDER BY pos) AS text FROM c GROUP BY doc_id, label)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first) - 1 AS INTEGER) AS chunk_index, CAST(n AS INTEGER) AS n_parts, text FROM g"""


@query(f"WITH {_LINKS}, {_PROPAGATED}, {_GROUPED}")
def chunk_by_community(spark, d):
    return GC.by_graph(_docs(spark, d), "doc_id", "text", "community", rounds=3)


@query(f"""WITH {_LINKS}, d AS (SELECT doc_id, entity, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, entity) AS label FROM l GROUP BY doc_id, entity),
b3 AS (SELECT doc_id, pos, min(label) AS label FROM l JOIN d USING (doc_id, entity) WHERE label <= 5 GROUP BY ALL), {_GROUPED}""")
def chunk_by_centrality(spark, d):
    return GC.by_graph(_docs(spark, d), "doc_id", "text", "centrality", hubs=5)


#: Words of notices, the classes that they stand for, and what is above these.
NOTICE_TERMS = {"apache": "Permissive", "cc": "Content", "general": "Copyleft", "gnu": "Copyleft", "license": "Licence", "licensed": "Licence", "public": "Copyleft", "reserved": "Claim", "rights": "Claim"}
NOTICE_CLASSES = [("Permissive", "Licence"), ("Copyleft", "Licence"), ("Content", "Licence"), ("Licence", "Legal"), ("Claim", "Legal")]


@query(f"""WITH RECURSIVE {_PARTS}, h(c, a) AS (VALUES {", ".join(map(str, NOTICE_CLASSES))}), t(w, c) AS (VALUES {", ".join(map(str, NOTICE_TERMS.items()))}),
up(c, a, n) AS (SELECT DISTINCT c, c, 0 FROM (SELECT c FROM h UNION SELECT a FROM h UNION SELECT c FROM t) k UNION SELECT up.c, h.a, n + 1 FROM up JOIN h ON h.c = up.a),
m AS (SELECT DISTINCT doc_id, pos, t.c FROM (SELECT doc_id, pos, unnest(regexp_split_to_array(lower(x), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM p) e JOIN t USING (w)),
need AS (SELECT doc_id, pos, count(*) AS need FROM m GROUP BY ALL), met AS (SELECT doc_id, pos, a, count(*) AS n, sum(n) AS far FROM m JOIN up USING (c) GROUP BY ALL),
b AS (SELECT doc_id, pos, arg_min(a, (far, a)) AS label FROM met JOIN need USING (doc_id, pos) WHERE n = need GROUP BY ALL),
c AS (SELECT doc_id, pos, x, {_CARRIED.format('label')} AS concept FROM p LEFT JOIN b USING (doc_id, pos)),
k AS (SELECT *, pos > 0 AND concept IS DISTINCT FROM lag(concept) OVER (PARTITION BY doc_id ORDER BY pos) AS cut FROM c),
g AS (SELECT *, sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM k)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, any_value(concept) AS concept, CAST(count(*) AS INTEGER) AS n_parts, string_agg(x, ' ' ORDER BY pos) AS text FROM g GROUP BY doc_id, i""")
def chunk_by_ontology(spark, d):
    return GC.by_ontology(_docs(spark, d), "doc_id", "text", NOTICE_TERMS, NOTICE_CLASSES)


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), e AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM l), k AS (SELECT *, CASE WHEN regexp_matches(trim(line), '^#{1,6}\\s') THEN 'heading' WHEN regexp_matches(trim(line), '^([-*+]|\\d+\\.)\\s') THEN 'list' WHEN starts_with(trim(line), '```') THEN 'code' WHEN trim(line) = '' THEN 'blank' ELSE 'paragraph' END AS kind FROM e), s AS (SELECT *, sum((kind = 'heading')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS section FROM k) SELECT doc_id, CAST(section AS BIGINT) AS section, kind, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS text FROM s WHERE kind <> 'blank' GROUP BY doc_id, section, kind""")
def chunk_structural(spark, d):
    return K.structural(_docs(spark, d), "doc_id", "text")


@query("""SELECT n_nationkey, CAST((row_number() OVER (ORDER BY n_name) - 1) // 7 AS BIGINT) AS chunk_index, 'n_name: ' || n_name || ' | n_regionkey: ' || n_regionkey AS text FROM nation""")
def table_row_chunks(spark, d):
    n = K.table_rows(table(spark, d, "nation"), ["n_name"], 7)
    return n.select("n_nationkey", "chunk_index", K.table_text(n, ["n_name", "n_regionkey"]).alias("text"))


_LABELS = [("EMAIL", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"), ("MONEY", "\\$[0-9][0-9,]*(?:\\.[0-9]+)?"), ("PERCENT", "[0-9]+(?:\\.[0-9]+)?%"), ("DATE", "[0-9]{4}-[0-9]{2}-[0-9]{2}")]
_MENTIONS = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS label, unnest(regexp_extract_all(text, '({p})', 1)) AS mention FROM documents" for n, p in _LABELS)


@query(f"""SELECT doc_id, label, mention, count(*) AS n FROM ({_MENTIONS}) m GROUP BY ALL""")
def mentions_regex(spark, d):
    return X.mentions(_docs(spark, d), "doc_id", "text", [n for n, _ in _LABELS])


@query()
def mention_spans(spark, d):
    return X.mention_spans(_docs(spark, d), "doc_id", "text")


@query(f"""WITH m AS ({_MENTIONS}), v AS (SELECT doc_id, label, lower(mention) AS mention, CASE label WHEN 'DATE' THEN 0.7 WHEN 'EMAIL' THEN 0.75 ELSE 0.4 END AS c FROM m) SELECT doc_id, label, mention, round(CAST(avg(c) AS DOUBLE), 6) AS confidence FROM v GROUP BY ALL HAVING avg(c) >= 0.5""")
def mentions_vote(spark, d):
    m = X.mentions(_docs(spark, d), "doc_id", "text", [n for n, _ in _LABELS])
    m = m.withColumn("confidence", F.when(F.col("label") == "DATE", 0.7).when(F.col("label") == "EMAIL", 0.75).otherwise(0.4))
    return X.vote(m).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {_SENT}, f AS (SELECT doc_id, regexp_extract(unnest(s), '^([A-Z][a-z]{{2,}})', 1) AS mention FROM s) SELECT doc_id, mention, count(*) AS n FROM f WHERE mention <> '' GROUP BY ALL""")
def mentions_capitalised(spark, d):
    return X.capitalised(_docs(spark, d), "doc_id", "text")




@query("""WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), s AS (SELECT doc_id, unnest(w) AS mention, generate_subscripts(w, 1) AS i FROM w), p AS (SELECT doc_id, mention, i, sum(length(mention) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(mention) - 1 AS a FROM s), u AS (SELECT doc_id, mention, a, a + length(mention) AS e FROM p WHERE regexp_matches(mention, '^(License|GNU|Apache|Public|rights|reserved|CC)'))
SELECT x.doc_id, x.mention AS a, CAST(x.a AS INTEGER) AS a_start, y.mention AS b, CAST(y.a AS INTEGER) AS b_start FROM u x JOIN u y ON x.doc_id = y.doc_id AND x.a < y.a AND abs(x.e - y.a) < 100""")
def cooccurrence(spark, d):
    from pyspark.sql import Window

    w = _docs(spark, d).select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "mention"))
    size = F.length("mention") + 1
    at = F.sum(size).over(Window.partitionBy("doc_id").orderBy("i")) - size
    spans = w.withColumn("start_char", at.cast("int")).withColumn("end_char", F.col("start_char") + F.length("mention"))
    spans = spans.filter(F.col("mention").rlike("^(License|GNU|Apache|Public|rights|reserved|CC)"))
    return X.cooccurrences(spans, "doc_id").select("doc_id", "a", "a_start", "b", "b_start")


#: Phrases that relate two names, by relation.
RELATION_PHRASES = {"belongs_to": ["of the"], "joined_with": ["and"], "located_in": ["in the", "at the"]}
_WEIGHTS = [(r, w, round(n, 15)) for r, ws in {"belongs_to": ["of", "the"], "joined_with": ["and"]}.items() for w in ws for n in [len(ws) ** -0.5]] + [("located_in", "in", 6**-0.5), ("located_in", "at", 6**-0.5), ("located_in", "the", 2 / 6**0.5)]


@query(f"""WITH w AS (SELECT doc_id, text, string_split(text, ' ') AS w FROM documents), s AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
p AS (SELECT doc_id, regexp_extract(x, '^([A-Z][a-z]{{2,}})[.,;:!?]*$', 1) AS mention, sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(x) - 1 AS a FROM s),
u AS (SELECT doc_id, mention, a, a + length(mention) AS e FROM p WHERE mention <> ''),
c AS (SELECT x.doc_id, x.mention AS a, x.a AS a_start, y.mention AS b, y.a AS b_start, list_filter(regexp_split_to_array(lower(text[CAST(x.e + 1 AS BIGINT) : CAST(y.a AS BIGINT)]), '[^\\p{{L}}\\p{{N}}]+'), lambda z: z <> '') AS ws FROM u x JOIN u y ON x.doc_id = y.doc_id AND x.a < y.a AND abs(x.e - y.a) < 100 JOIN w ON w.doc_id = x.doc_id),
t(relation, word, weight) AS (VALUES {", ".join(map(str, _WEIGHTS))}),
h(relation, phrase) AS (VALUES {", ".join(str((r, p)) for r, ps in RELATION_PHRASES.items() for p in ps)}),
n AS (SELECT *, row_number() OVER () AS id, ' ' || array_to_string(ws, ' ') || ' ' AS padded FROM c),
k AS (SELECT id, z, count(*) AS n FROM (SELECT id, unnest(ws) AS z FROM n) e GROUP BY ALL), l AS (SELECT id, sqrt(sum(n * n)) AS norm FROM k GROUP BY id),
v AS (SELECT id, relation, sum(k.n * weight) / any_value(norm) AS score FROM k JOIN t ON z = word JOIN l USING (id) GROUP BY ALL
      UNION ALL SELECT id, relation, 1.0 FROM n JOIN h ON contains(padded, ' ' || phrase || ' ')),
b AS (SELECT id, relation, max(round(score, 9)) AS score FROM v GROUP BY ALL HAVING max(score) >= 0.4),
f AS (SELECT id, score, relation FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, relation) = 1)
SELECT doc_id, a, CAST(a_start AS INTEGER) AS a_start, b, CAST(b_start AS INTEGER) AS b_start, relation, round(CAST(score AS DOUBLE), 6) AS confidence FROM f JOIN n USING (id)""")
def relations_similarity(spark, d):
    docs = _docs(spark, d)
    found = RL.relations_by_similarity(docs, RL.capitalised_spans(docs, "doc_id", "text"), "doc_id", "text", RELATION_PHRASES)
    return found.withColumn("confidence", F.round("confidence", 6))


_EVENTS = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, len(regexp_extract_all(lower(text), '{p}')) AS n FROM documents" for k, p in (("legal", "\\b(?:license|licensed|rights)\\b"), ("launch", "\\b(?:the|and)\\b")))


@query(f"""SELECT doc_id, kind, CAST(n AS INTEGER) AS n FROM ({_EVENTS}) e WHERE n > 0""")
def events_regex(spark, d):
    return X.events(_docs(spark, d), "doc_id", "text", {"legal": r"\b(?:license|licensed|rights)\b", "launch": r"\b(?:the|and)\b"})


@query(f"""WITH {_SENT}, e AS (SELECT doc_id, unnest(s) AS x FROM s), t AS (SELECT doc_id, regexp_extract(x, '^(\\S.*?) (is|are|was|were) (.+?)[.!?]?$', ['s', 'p', 'o']) AS t FROM e WHERE x NOT LIKE '%' || chr(10) || '%') SELECT doc_id, t.s AS s, t.p AS p, t.o AS o FROM t WHERE t.s <> ''""")
def copula_triples(spark, d):
    return X.copula_triples(_docs(spark, d), "doc_id", "text").filter("not contains(concat(s, p, o), '\n')")


@query()
def role_counts(spark, d):
    return X.roles(_docs(spark, d), "doc_id", "text")


@query()
def relations_pattern(spark, d):
    return X.relations(_docs(spark, d), "doc_id", "text")


@query()
def hashed_embeddings(spark, d):
    return table(spark, d, "benchmark").select("item_id", X.feature_hash_embedding(F.col("text"), 16).alias("embedding"))


# -- memory ------------------------------------------------------------------------------------------


@query("""WITH r AS (SELECT conv_id, turn, row_number() OVER w AS n, sum(length(text) // 4) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING) AS t FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn DESC)) SELECT conv_id, turn, CAST(t AS BIGINT) AS running_tokens FROM r WHERE n <= 5 AND t <= 200""")
def memory_token_window(spark, d):
    return M.token_window(table(spark, d, "conversations"), "conv_id", "turn", "text", 200, 5).select("conv_id", "turn", "running_tokens")


@query("""SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 2""")
def memory_recent(spark, d):
    return M.recent_each(table(spark, d, "conversations"), "conv_id", "turn", 2).select("conv_id", "turn", "role")


@query("""SELECT conv_id, count(*) AS n_turns, count(DISTINCT role) AS n_roles, CAST(sum(length(text)) AS BIGINT) AS n_chars, arg_min(text, turn) AS first_text, arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id""")
def conversation_summary(spark, d):
    return M.conversation_summary(table(spark, d, "conversations"))


@query("""SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY""")
def retention_filter(spark, d):
    return M.retained(table(spark, d, "events"), "ts", "2024-01-30", 7).select("event_id")


@query("""SELECT """ + ", ".join(f"count(*) FILTER (ts > TIMESTAMP '2024-01-30' - INTERVAL {n} DAY AND ts <= TIMESTAMP '2024-01-30') AS items_{k}, count(DISTINCT user_id) FILTER (ts > TIMESTAMP '2024-01-30' - INTERVAL {n} DAY AND ts <= TIMESTAMP '2024-01-30') AS users_{k}" for k, n in (("day", 1), ("week", 7), ("month", 30))) + """ FROM events""")
def usage_stats(spark, d):
    return M.usage(table(spark, d, "events"), "ts", "2024-01-30", "user_id")


@query("""SELECT role AS value, count(*) AS n FROM conversations GROUP BY role""")
def memory_histogram(spark, d):
    return M.histogram(table(spark, d, "conversations"), "role")
