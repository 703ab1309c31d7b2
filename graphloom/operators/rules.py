"""Rules `IF A(?x, ?y) AND B(?y) THEN C(?x)` over facts(pred, args), to a fixed point by semi-naive joins."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frames import settled

_ATOM = re.compile(r"\s*([\w:]+)\s*\(([^()]*)\)\s*")


class Atom(NamedTuple):
    pred: str
    args: tuple[str, ...]


class Rule(NamedTuple):
    name: str
    body: tuple[Atom, ...]
    head: Atom
    priority: int = 0


def parse_atom(text: str) -> Atom:
    m = _ATOM.fullmatch(text)
    if not m:
        raise ValueError(f"not an atom: {text!r}")
    return Atom(m[1], tuple(a.strip() for a in m[2].split(",")))


def parse_rule(text: str, name: str | None = None, priority: int = 0) -> Rule:
    m = re.fullmatch(r"\s*IF\s+(.*?)\s+THEN\s+(.*?)\s*", text, re.I | re.S)
    if not m:
        raise ValueError(f"not a rule: {text!r}")
    body = tuple(parse_atom(a) for a in re.split(r"\s+AND\s+", m[1], flags=re.I))
    return Rule(name or text.strip(), body, parse_atom(m[2]), priority)


def fact_rows(texts: DataFrame, column: str = "fact") -> DataFrame:
    """facts from texts like Parent(John, Jane)."""
    inner = F.regexp_extract(column, r"^\s*[\w:]+\s*\((.*)\)\s*$", 1)
    return texts.select(F.regexp_extract(column, r"^\s*([\w:]+)", 1).alias("pred"), F.transform(F.split(inner, ","), lambda x: F.trim(x)).alias("args"))


def _matches(facts: DataFrame, atom: Atom) -> DataFrame:
    """The variables of an atom: constants filter, a repeated variable must match itself."""
    rows = facts.filter((F.col("pred") == atom.pred) & (F.size("args") == len(atom.args)))
    seen = {}
    for i, a in enumerate(atom.args):
        at = F.col("args")[i]
        if not a.startswith("?"):
            rows = rows.filter(at == a)
        elif a[1:] in seen:
            rows = rows.filter(at == F.col("args")[seen[a[1:]]])
        else:
            seen[a[1:]] = i
    return rows.select(*(F.col("args")[i].alias(v) for v, i in seen.items()))


def _fired(rule: Rule, facts: DataFrame, delta: DataFrame | None) -> DataFrame:
    """Conclusions of one rule; with delta, at least one premise is new."""
    out = None
    for new in range(len(rule.body)) if delta is not None else [None]:
        parts = [_matches(delta if i == new else facts, atom) for i, atom in enumerate(rule.body)]
        rows = parts.pop(new or 0)  # the few new facts first
        while parts:
            i = next((i for i, p in enumerate(parts) if set(p.columns) & set(rows.columns)), None)
            if i is None:
                raise ValueError(f"premises without a shared variable would be a cross product: {rule.name}")
            part = parts.pop(i)
            rows = rows.join(part, [c for c in rows.columns if c in part.columns])
        args = F.array(*(F.col(a[1:]) if a.startswith("?") else F.lit(a) for a in rule.head.args))
        rows = rows.select(F.lit(rule.head.pred).alias("pred"), args.alias("args"), F.lit(rule.name).alias("rule"), F.lit(len(rule.body)).alias("premises"))
        out = rows if out is None else out.unionByName(rows)
    return out


def forward_chain(facts: DataFrame, rules: list[Rule], rounds: int = 1000) -> DataFrame:
    """(pred, args, rule, premises, round) of all facts that follow and aren't given.

    Each round joins only what the last one found with what is known. A fact found by several rules gets the
    first by priority, then name. An error if facts still follow after so many rounds.
    """
    order = {r.name: i for i, r in enumerate(sorted(rules, key=lambda r: (-r.priority, r.name)))}
    known = settled(facts.select("pred", "args").distinct())
    delta, found = None, None
    for n in range(1, rounds + 1):
        new = None
        for rule in rules:
            part = _fired(rule, known, delta).withColumn("at", F.lit(order[rule.name]))
            new = part if new is None else new.unionByName(part)
        new = new.groupBy("pred", "args").agg(F.min_by(F.struct("rule", "premises"), "at").alias("by"))
        new = settled(new.join(known, ["pred", "args"], "left_anti").select("pred", "args", "by.rule", "by.premises", F.lit(n).alias("round")))
        if not new.take(1):
            break
        found = new if found is None else found.unionByName(new)
        delta = new.select("pred", "args")
        known = settled(known.unionByName(delta))
    else:
        raise ValueError(f"facts still follow after {rounds} rounds")
    empty = known.limit(0).select("pred", "args", F.lit("").alias("rule"), F.lit(0).alias("premises"), F.lit(0).alias("round"))
    return found if found is not None else empty


def prove(facts: DataFrame, rules: list[Rule], goal: str) -> DataFrame:
    """The given or inferred facts that match a goal, with the rule that gave them (null: given)."""
    atom = parse_atom(goal)
    given = facts.select("pred", "args").distinct().withColumns({"rule": F.lit(None).cast("string"), "premises": F.lit(0), "round": F.lit(0)})
    rows = given.unionByName(forward_chain(facts, rules)).filter((F.col("pred") == atom.pred) & (F.size("args") == len(atom.args)))
    for i, a in enumerate(atom.args):
        rows = rows if a.startswith("?") else rows.filter(F.col("args")[i] == a)
    return rows


def explanations(inferred: DataFrame) -> DataFrame:
    text = F.concat(F.col("pred"), F.lit("("), F.array_join("args", ", "), F.lit(") by "), F.col("rule"))
    return inferred.select("pred", "args", text.alias("explanation"))


def hypotheses(observations: DataFrame, rules: list[Rule], top: int = 3) -> DataFrame:
    """For each observation(pred, args) the rules whose head fits it: score 0.4 * 0.8 + 0.3 * 0.5 + 0.3 / (1 + conditions), best first."""
    spark = observations.sparkSession
    table = spark.createDataFrame([(r.name, r.head.pred, len(r.head.args), len(r.body)) for r in rules], "rule string, pred string, n int, conditions int")
    score = F.lit(0.4) * 0.8 + F.lit(0.3) * 0.5 + F.lit(0.3) / (1 + F.col("conditions"))
    hit = observations.join(F.broadcast(table), "pred").filter(F.size("args") == F.col("n"))
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("pred", "args").orderBy(F.desc("score"), "rule"))
    return hit.withColumn("score", score).withColumn("rank", rank).filter(F.col("rank") <= top).select("pred", "args", "rule", "score", "rank")
