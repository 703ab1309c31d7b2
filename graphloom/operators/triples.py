"""Triples (s, p, o): minting, patterns, basic graph patterns, closure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.frames import settled

TYPE, SUBCLASS, LABEL = "rdf:type", "rdfs:subClassOf", "rdfs:label"


def mint(kind: str, c: Column) -> Column:
    """urn:kind:name, with everything but letters, digits, - and _ as _."""
    return F.concat(F.lit(f"urn:{kind}:"), F.regexp_replace(c.cast("string"), "[^A-Za-z0-9_-]", "_"))


def entity_triples(df: DataFrame, key: str, kind: str, properties: list[str]) -> DataFrame:
    """Type and property triples of rows, from one pass."""
    s = mint("entity", F.concat(F.lit(kind + "_"), F.col(key).cast("string")))
    rows = [F.struct(F.lit(TYPE).alias("p"), F.lit(f"urn:class:{kind}").alias("o"))]
    rows += [F.struct(F.lit(f"urn:property:{p}").alias("p"), F.col(p).cast("string").alias("o")) for p in properties]
    return df.select(s.alias("s"), F.explode(F.array(*rows)).alias("t")).select("s", "t.p", "t.o").filter("o is not null")


def edge_triples(df: DataFrame, src: Column, predicate: str, dst: Column) -> DataFrame:
    return df.select(src.alias("s"), F.lit(f"urn:property:{predicate}").alias("p"), dst.alias("o")).filter("s is not null and o is not null")


def pattern(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """Triples that fit; None is unbound."""
    bound = {"s": s, "p": p, "o": o}
    return triples.filter(reduce(lambda a, b: a & b, (F.col(k) == v for k, v in bound.items() if v is not None), F.lit(True)))


def _bindings(triples: DataFrame, terms: tuple[str, str, str]) -> DataFrame:
    """The variables (?x) of one pattern; a variable that stands twice must match itself."""
    out, names = triples, {}
    for column, term in zip(("s", "p", "o"), terms):
        if not term.startswith("?"):
            out = out.filter(F.col(column) == term)
        elif term[1:] in names:
            out = out.filter(F.col(column) == F.col(names[term[1:]]))
        else:
            names[term[1:]] = column
    return out.select(*(F.col(c).alias(n) for n, c in names.items()))


def _joined(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    if shared:
        return a.join(b, shared, how)
    if how in ("inner", "left"):
        raise ValueError("patterns without a shared variable would be a cross product")
    return a.join(F.broadcast(b.limit(1).select(F.lit(1).alias("_any"))), F.lit(True), how)  # it matters only whether there is a row


def query(
    triples: DataFrame,
    where: list[tuple[str, str, str]],
    optional: list[list[tuple[str, str, str]]] = (),
    exists: list[list[tuple[str, str, str]]] = (),
    not_exists: list[list[tuple[str, str, str]]] = (),
    keep: Column | None = None,
    select: list[str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """A basic graph pattern as joins: OPTIONAL left, EXISTS left semi, NOT EXISTS left anti.

    Patterns join in an order in which each shares a variable with those before; Catalyst picks the join strategy.
    """

    def bgp(patterns: list[tuple[str, str, str]]) -> DataFrame:
        rest = [_bindings(triples, t) for t in patterns]
        out = rest.pop(0)
        while rest:
            i = next((i for i, b in enumerate(rest) if set(b.columns) & set(out.columns)), 0)
            out = _joined(out, rest.pop(i), "inner")
        return out

    out = bgp(where)
    for group in optional:
        out = _joined(out, bgp(group), "left")
    for group in exists:
        out = _joined(out, bgp(group), "left_semi")
    for group in not_exists:
        out = _joined(out, bgp(group), "left_anti")
    out = out.filter(keep) if keep is not None else out
    out = out.select(*select) if select else out
    return out.distinct() if distinct else out


def union_query(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def closure(triples: DataFrame, predicate: str, most: int = 64) -> DataFrame:
    """(s, o) of the transitive closure of a predicate, by doubling: every round joins paths with paths, so rounds grow with the logarithm of the depth."""
    paths = settled(pattern(triples, p=predicate).select("s", "o").distinct())
    for _ in range(most):
        x, y = paths.alias("x"), paths.alias("y")
        longer = x.join(y, F.expr("x.o = y.s")).select(F.col("x.s").alias("s"), F.col("y.o").alias("o")).distinct()
        fresh = settled(longer.join(paths, ["s", "o"], "left_anti"))
        if not fresh.take(1):
            break
        paths = settled(paths.unionByName(fresh))
    return paths


def infer_types(triples: DataFrame) -> DataFrame:
    """(s, class): stated types and those by subclass."""
    stated = pattern(triples, p=TYPE).select("s", F.col("o").alias("class"))
    up = closure(triples, SUBCLASS).select(F.col("s").alias("class"), F.col("o").alias("above"))
    return stated.unionByName(stated.join(up, "class").select("s", F.col("above").alias("class"))).distinct()


def delete(triples: DataFrame, gone: DataFrame) -> DataFrame:
    return triples.join(gone.select("s", "p", "o"), ["s", "p", "o"], "left_anti")


def update(triples: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    return delete(triples, old).unionByName(new)


def load_report(triples: DataFrame) -> DataFrame:
    """One row: rows, empty parts, subjects that are no URI, low confidence."""
    uri = r"^[a-z][a-z0-9+.-]*:"
    return triples.agg(F.count("*").alias("n"), F.count_if(F.expr("s is null or s = '' or p is null or p = '' or o is null or o = ''")).alias("empty"), F.count_if(~F.col("s").rlike(uri)).alias("no_uri"))
