"""Relations between mentions by what stands between them: contexts as word vectors, matched with prototypes of relations."""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frames import ship_package

_WORDS = r"[^\p{L}\p{N}]+"
_CAPITALISED = re.compile(r"(?<![^ ])([A-Z][a-z]{2,})[.,;:!?]*(?![^ ])")


def capitalised_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, mention, start_char, end_char) of every space-separated word that is a capital and two small letters or more, without marks at its end."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, mentions, starts, ends = [], [], [], []
            for i, t in enumerate(batch["_t"].to_pylist()):
                for m in _CAPITALISED.finditer(t or ""):
                    at.append(i)
                    mentions.append(m[1])
                    starts.append(m.start(1))
                    ends.append(m.end(1))
            columns = [batch["_k"].take(pa.array(at, pa.int64())), pa.array(mentions, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["_k", "mention", "start_char", "end_char"])

    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    return rows.mapInArrow(run, f"_k {dict(rows.dtypes)['_k']}, mention string, start_char int, end_char int").withColumnRenamed("_k", key)


def _pairs(reach: int):
    """Of each text the pairs of its spans that cooccurrences would give, once each, with what stands between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, (t, spans) in enumerate(zip(batch["_t"].to_pylist(), batch["spans"].to_pylist())):
                spans = sorted({(s["start_char"], s["end_char"], s["mention"]) for s in spans})
                starts, seen = [s[0] for s in spans], set()
                for a_start, a_end, a in spans:
                    end = a_start + len(a)
                    for b_start, _, b in spans[max(bisect_right(starts, a_start), bisect_right(starts, a_end - reach)) : bisect_left(starts, a_end + reach)]:
                        if (pair := (a, a_start, b, b_start)) not in seen:
                            seen.add(pair)
                            rows.append((i, *pair, None if t is None else t[end : max(end, b_start)]))
                if len(rows) > 20_000:
                    yield _table(batch, rows)
                    rows = []
            yield _table(batch, rows)

    return run


def _table(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string()]
    at, *rest = (pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds))
    return pa.RecordBatch.from_arrays([batch["_k"].take(at), *rest], ["_k", "a", "a_start", "b", "b_start", "between"])


def _prototype(phrases: list[str]) -> dict[str, float]:
    """The words of a relation's phrases with their shares of a vector of length one."""
    n = Counter(w for p in phrases for w in re.findall(r"\w+", p.lower()))
    length = math.sqrt(sum(x * x for x in n.values())) or 1.0
    return {w: x / length for w, x in n.items()}


def _best(prototypes: dict[str, list[str]], least: float):
    """Of rows (_k, a, a_start, b, b_start, words) those with a relation of at least `least`, with the best one."""
    kinds = [(r, [" ".join(re.findall(r"\w+", p.lower())) for p in prototypes[r]], _prototype(prototypes[r])) for r in sorted(prototypes)]
    telling = {w for _, _, prototype in kinds for w in prototype}

    def score(words: list[str]) -> tuple[float, str]:
        counts, padded, best = Counter(words), f" {' '.join(words)} ", (0.0, kinds[0][0])
        norm = math.sqrt(sum(float(n * n) for n in counts.values()))
        for i, (relation, phrases, prototype) in enumerate(kinds):
            held = any(p and f" {p} " in padded for p in phrases)
            value = 1.0 if held else sum((prototype.get(w, 0.0) for w in words), 0.0) / norm if words else 0.0
            if not i or value > best[0]:
                best = value, relation
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, relations, confidences = [], [], []
            for i, words in enumerate(batch["words"].to_pylist()):
                # with no word of any prototype all are 0
                if words is None or (least > 0 and telling.isdisjoint(words)) or not kinds:
                    continue
                value, relation = score(words)
                if value >= least:
                    at.append(i)
                    relations.append(relation)
                    confidences.append(value)
            kept = batch.drop_columns(["words"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(relations, pa.string()), pa.array(confidences, pa.float64())], [*kept.schema.names, "relation", "confidence"])

    return run


def relations_by_similarity(docs: DataFrame, spans: DataFrame, key: str, text: str, prototypes: dict[str, list[str]], reach: int = 100, least: float = 0.4) -> DataFrame:
    """(key, a, a_start, b, b_start, relation, confidence): of each two mentions under `reach` characters apart the relation whose prototype is most like the text between them.

    spans(key, mention, start_char, end_char) are places in the text; prototypes names phrases for each relation, a dictionary in the
    caller's hands. A text between that holds one of the phrases, word by word, has confidence 1; else it is the cosine of the words between with those of
    the phrases. Pairs below `least` have no row; of equal relations the alphabetically first counts. Each text meets its mentions once, which
    form their pairs there in time proportional to the text and its pairs.
    """
    ship_package(docs.sparkSession)
    place = lambda c: F.col(c).cast("int").alias(c)
    usable = spans.filter(" and ".join(f"{c} is not null" for c in ("mention", "start_char", "end_char")))
    by_text = usable.groupBy(F.col(key).alias("_k")).agg(F.collect_list(F.struct("mention", place("start_char"), place("end_char"))).alias("spans"))
    met = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(by_text.filter(F.size("spans") > 1), "_k")
    kind = dict(met.dtypes)["_k"]
    rows = met.mapInArrow(_pairs(reach), f"_k {kind}, a string, a_start int, b string, b_start int, between string")
    rows = rows.select("_k", "a", "a_start", "b", "b_start", F.array_remove(F.split(F.lower("between"), _WORDS), "").alias("words"))
    found = rows.mapInArrow(_best(prototypes, least), f"_k {kind}, a string, a_start int, b string, b_start int, relation string, confidence double")
    return found.withColumnRenamed("_k", key)
