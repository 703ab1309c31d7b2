"""Pipelines of named steps, templates, and the facade that builds a knowledge graph."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators import chunking, dedup, extract


@dataclass
class Step:
    name: str
    handler: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    retries: int = 1


@dataclass
class Pipeline:
    """Steps are functions of the DataFrames of the steps that they need (the input, if none). All stays lazy, and Catalyst plans across steps."""

    name: str
    steps: dict[str, Step] = field(default_factory=dict)

    def add(self, name: str, handler: Callable[..., DataFrame], needs: tuple[str, ...] | list[str] = (), retries: int = 1) -> Pipeline:
        self.steps[name] = Step(name, handler, tuple(needs), retries)
        return self

    def problems(self) -> list[str]:
        """Needs that don't exist, and cycles."""
        found = [f"{s.name} needs {n}, which isn't a step" for s in self.steps.values() for n in s.needs if n not in self.steps]
        try:
            self.order()
        except CycleError as e:
            found.append(f"cycle: {' -> '.join(e.args[1])}")
        return found

    def order(self) -> list[str]:
        return [n for n in TopologicalSorter({s.name: s.needs for s in self.steps.values()}).static_order() if n in self.steps]

    def levels(self) -> list[list[str]]:
        """Steps that could run side by side."""
        depth: dict[str, int] = {}
        for n in self.order():
            depth[n] = 1 + max((depth[x] for x in self.steps[n].needs), default=-1)
        return [[n for n in depth if depth[n] == d] for d in sorted(set(depth.values()))]

    def run(self, data: DataFrame) -> dict[str, DataFrame]:
        """The DataFrame of each step. A step that fails while it is planned is tried again, after a growing wait."""
        if found := self.problems():
            raise ValueError("; ".join(found))
        out: dict[str, DataFrame] = {}
        for name in self.order():
            step = self.steps[name]
            given = [out[n] for n in step.needs] or [data]
            for attempt in range(step.retries + 1):
                try:
                    out[name] = step.handler(*given)
                    break
                except Exception:
                    if attempt == step.retries:
                        raise
                    time.sleep(min(2**attempt * 0.1, 5))
        return out


@dataclass
class KnowledgeGraph:
    entities: DataFrame
    relationships: DataFrame

    def metadata(self) -> DataFrame:
        n = self.entities.agg(F.count("*").alias("num_entities"))
        return n.crossJoin(self.relationships.agg(F.count("*").alias("num_relationships")))


def build_knowledge_graph(docs: DataFrame, key: str = "doc_id", text: str = "text") -> KnowledgeGraph:
    """Entities and relations of texts: mention spans, merged by label and lower-cased name; co-occurrences as relationships."""
    spans = extract.mention_spans(docs, key, text)
    name = F.lower("mention")
    entities = spans.groupBy(F.concat_ws(":", "label", name).alias("id")).agg(F.min("mention").alias("name"), F.min("label").alias("type"), F.max("confidence").alias("confidence"), F.countDistinct(key).alias("n_sources"))
    pairs = extract.cooccurrences(spans.withColumn("mention", F.concat_ws(":", "label", name)), key)
    relationships = pairs.groupBy(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("relation").alias("type")).agg(F.max("confidence").alias("confidence"), F.count("*").alias("weight"))
    return KnowledgeGraph(entities, relationships)


def document_processing(key: str = "doc_id", text: str = "text") -> Pipeline:
    return Pipeline("document_processing").add("chunk", lambda d: chunking.recursive(d, key, text)).add("mentions", lambda c: extract.mentions(c, key, "text"), ["chunk"])


def kg_construction(key: str = "doc_id", text: str = "text") -> Pipeline:
    return (
        Pipeline("kg_construction")
        .add("spans", lambda d: extract.mention_spans(d, key, text))
        .add("relations", lambda s: extract.cooccurrences(s, key), ["spans"])
        .add("duplicates", lambda s: dedup.candidate_pairs(s.select(F.xxhash64("mention").alias("ord"), F.col("mention").alias("name")).distinct(), 0.9, lambda a, b: F.when(F.lower(a) == F.lower(b), 1.0).otherwise(0.0)), ["spans"])
    )


def rag_pipeline(key: str = "doc_id", text: str = "text", dim: int = 32) -> Pipeline:
    return Pipeline("rag_pipeline").add("chunk", lambda d: chunking.by_sentences(d, key, text)).add("embed", lambda c: c.withColumn("embedding", extract.feature_hash_embedding(F.col("text"), dim)), ["chunk"])


TEMPLATES = {"document_processing": document_processing, "kg_construction": kg_construction, "rag_pipeline": rag_pipeline}
