"""Rule-based extraction: mentions, relations, events, coreference, triplets."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Patterns of mentions by label, and their confidence.
PATTERNS = {
    "EMAIL": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", 0.75),
    "MONEY": (r"\$[0-9][0-9,]*(?:\.[0-9]+)?", 0.75),
    "PERCENT": (r"[0-9]+(?:\.[0-9]+)?%", 0.75),
    "DATE": (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", 0.7),
    "ORG": (r"[A-Z][A-Za-z]+ (?:Inc|Corp|Ltd|LLC|GmbH)", 0.7),
    "PERSON": (r"[A-Z][a-z]+ [A-Z][a-z]+", 0.7),
}
#: Verb phrases between two mentions, by relation.
RELATIONS = {
    "founded_by": r"(?:was )?founded by",
    "located_in": r"(?:is )?(?:located|based) in",
    "works_for": r"works (?:for|at)",
    "born_in": r"was born in",
    "acquired_by": r"was acquired by",
}
#: Words that tell an event, by kind.
EVENTS = {
    "acquisition": r"\b(?:acquired|acquires|acquisition|bought|merged)\b",
    "partnership": r"\b(?:partnered|partnership|collaborated|alliance)\b",
    "launch": r"\b(?:launched|launches|released|unveiled|announced)\b",
    "investment": r"\b(?:invested|investment|funding|raised)\b",
    "legal": r"\b(?:sued|lawsuit|litigation|settled|court)\b",
}


def mentions(docs: DataFrame, key: str, text: str, labels: list[str] | None = None) -> DataFrame:
    """(key, label, mention, n): distinct mentions by label with how often each stands, in built-in functions."""
    rows = None
    for label in labels or PATTERNS:
        found = docs.select(key, F.explode(F.regexp_extract_all(text, F.lit(f"({PATTERNS[label][0]})"), F.lit(1))).alias("mention"))
        part = found.select(key, F.lit(label).alias("label"), "mention")
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(key, "label", "mention").agg(F.count("*").alias("n"))


def mention_spans(docs: DataFrame, key: str, text: str, labels: list[str] | None = None) -> DataFrame:
    """(key, label, mention, start_char, end_char, confidence) of every place; of overlapping ones the earlier label in the list wins."""
    wanted = [(label, re.compile(PATTERNS[label][0]), PATTERNS[label][1]) for label in labels or PATTERNS]

    def run(batches):
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["k"], pdf["t"]):
                taken: list[tuple[int, int]] = []
                for label, pattern, confidence in wanted:
                    for m in pattern.finditer(t or ""):
                        if not any(a < m.end() and m.start() < b for a, b in taken):
                            taken.append(m.span())
                            rows.append((k, label, m[0], *m.span(), confidence))
            yield pd.DataFrame(rows, columns=[key, "label", "mention", "start_char", "end_char", "confidence"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, label string, mention string, start_char int, end_char int, confidence double")


def capitalised(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, mention, n): the first word of each sentence if it is capitalised and over two letters long."""
    first = F.explode(F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.regexp_extract(s, r"^([A-Z][a-z]{2,})", 1)))
    return docs.select(key, first.alias("mention")).filter("mention <> ''").groupBy(key, "mention").agg(F.count("*").alias("n"))


def vote(results: DataFrame, least: float = 0.5) -> DataFrame:
    """(key..., label, mention, confidence): mean confidence of several methods' results(doc_id, label, mention, confidence), those of `least` or more."""
    g = results.groupBy("doc_id", "label", F.lower("mention").alias("mention")).agg(F.avg("confidence").alias("confidence"))
    return g.filter(F.col("confidence") >= least)


def cooccurrences(spans: DataFrame, key: str, reach: int = 100) -> DataFrame:
    """Pairs of mentions (a before b) whose gap is under `reach` characters.

    Places are dealt into cells of `reach` characters and each meets its own and the next cells, so
    pairs far apart in a long text are never formed.
    """
    cell = F.floor(F.col("start_char") / reach).cast("int")
    x = spans.select(key, F.col("mention").alias("a"), F.col("start_char").alias("a_start"), F.col("end_char").alias("a_end"))
    last = F.floor((F.col("a_end") + reach) / reach).cast("int")
    x = x.withColumn("cell", F.explode(F.sequence(F.floor(F.col("a_start") / reach).cast("int"), last)))
    y = spans.select(key, F.col("mention").alias("b"), F.col("start_char").alias("b_start"), cell.alias("cell"))
    near = (F.col("a_start") < F.col("b_start")) & (F.abs(F.col("a_end") - F.col("b_start")) < reach)
    return x.join(y, [key, "cell"]).filter(near).select(key, "a", "a_start", "b", "b_start", F.lit("related_to").alias("relation"), F.lit(0.6).alias("confidence"))


def relations(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, subject, relation, object): capitalised names around a relation's verb phrase."""
    name = r"([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*)"
    rows = None
    for relation, verb in RELATIONS.items():
        found = F.regexp_extract_all(text, F.lit(rf"{name} {verb} {name}"), F.lit(0))
        part = docs.select(key, F.explode(found).alias("m")).select(key, F.regexp_extract("m", rf"^{name} {verb} ", 1).alias("subject"), F.lit(relation).alias("relation"), F.regexp_extract("m", rf" {verb} {name}$", 1).alias("object"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def events(docs: DataFrame, key: str, text: str, kinds: dict[str, str] = EVENTS) -> DataFrame:
    """(key, kind, n): how often each kind's words stand in a text."""
    counts = F.array(*(F.struct(F.lit(k).alias("kind"), F.size(F.regexp_extract_all(F.lower(text), F.lit(p), F.lit(0))).alias("n")) for k, p in kinds.items()))
    return docs.select(key, F.inline(counts)).filter("n > 0")


def event_pairs(participants: DataFrame, event: str, who: str) -> DataFrame:
    """(first, second, n): events that share participants, a < b; for participants of few events."""
    x, y = participants.select(F.col(event).alias("first"), who), participants.select(F.col(event).alias("second"), who)
    return x.join(y, who).filter("first < second").groupBy("first", "second").agg(F.count("*").alias("n"))


def coreferences(spans: DataFrame, key: str) -> DataFrame:
    """(key, mention, n): mentions that stand more than once in a text, letter case ignored."""
    return spans.groupBy(key, F.lower("mention").alias("mention")).agg(F.count("*").alias("n")).filter("n > 1")


def pronoun_antecedents(spans: DataFrame, key: str, is_pronoun: Column) -> DataFrame:
    """Pronouns with the nearest mention before them."""
    w = Window.partitionBy(key).orderBy("start_char").rowsBetween(Window.unboundedPreceding, -1)
    out = spans.withColumn("antecedent", F.last(F.when(~is_pronoun, F.col("mention")), ignorenulls=True).over(w))
    return out.filter(is_pronoun)


def roles(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, role, n): pronouns are agents, words after in, at, on, near and from are places."""
    agent = F.size(F.regexp_extract_all(F.lower(text), F.lit(r"\b(?:i|you|he|she|we|they)\b"), F.lit(0)))
    place = F.size(F.regexp_extract_all(text, F.lit(r"\b(?:in|at|on|near|from) ([A-Z]\w+)"), F.lit(1)))
    both = F.array(F.struct(F.lit("agent").alias("role"), agent.alias("n")), F.struct(F.lit("location").alias("role"), place.alias("n")))
    return docs.select(key, F.inline(both)).filter("n > 0")


def copula_triples(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, s, p, o) of sentences `X is|are|was|were Y`."""
    s = docs.select(key, F.explode(F.split(text, r"(?<=[.!?])\s+")).alias("sentence"))
    pattern = r"^(\S.*?) (is|are|was|were) (.+?)[.!?]?$"
    s = s.select(key, *(F.regexp_extract("sentence", pattern, i).alias(c) for i, c in ((1, "s"), (2, "p"), (3, "o"))))
    return s.filter("s <> ''")


def feature_hash_embedding(text: Column, dim: int = 32) -> Column:
    """A unit vector of hashed word counts: the stand-in where no model is given."""
    w = F.filter(F.split(F.lower(text), r"\s+"), lambda x: x != "")
    slot = lambda x: F.pmod(F.hash(x), F.lit(dim))
    sign = lambda x: F.when(F.pmod(F.xxhash64(x), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    pairs = F.transform(w, lambda x: F.struct(slot(x).alias("i"), sign(x).alias("v")))
    raw = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.aggregate(F.filter(pairs, lambda p: p["i"] == i), F.lit(0.0), lambda s, p: s + p["v"]))
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm == 0, raw).otherwise(F.transform(raw, lambda x: x / norm))
