"""Exports: tables, N-Triples, Turtle, Cypher, GraphML, DOT, JSON-LD, reports. Lines are built by expressions, so writing is distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The canonical columns as text; maps and structs as JSON, missing ones empty."""
    kinds = dict(df.dtypes)
    text = lambda c: F.lit("") if c not in kinds else F.coalesce(F.to_json(c) if kinds[c][:3] in ("map", "str") and kinds[c] != "string" else F.col(c).cast("string"), F.lit(""))
    return df.select(*(text(c).alias(c) for c in columns))


ENTITY_COLUMNS = ["id", "text", "type", "confidence", "start", "end", "metadata"]
RELATIONSHIP_COLUMNS = ["id", "source_id", "target_id", "type", "confidence", "metadata"]


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    csv_rows(df, columns or df.columns).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, by: list[str] = ()) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def escaped(c: Column) -> Column:
    c = F.regexp_replace(c, r"\\", r"\\\\")
    c = F.regexp_replace(c, '"', r'\\"')
    return F.regexp_replace(F.regexp_replace(c, "\n", r"\\n"), "\r", r"\\r")


def xml_text(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _term(c: Column) -> Column:
    return F.when(c.rlike(r"^[a-z][a-z0-9+.-]*:\S+$"), F.concat(F.lit("<"), c, F.lit(">"))).otherwise(F.concat(F.lit('"'), escaped(c), F.lit('"')))


def ntriples(triples: DataFrame) -> DataFrame:
    """A line (value) for each triple: URIs in angle brackets, other objects as literals."""
    return triples.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), _term(F.col("o")), F.lit(" .")).alias("value"))


def turtle(triples: DataFrame) -> DataFrame:
    """A block (value) for each subject, its predicates sorted."""
    pair = F.concat(F.lit("<"), F.col("p"), F.lit("> "), _term(F.col("o")))
    g = triples.groupBy("s").agg(F.sort_array(F.collect_list(pair)).alias("po"))
    return g.select(F.concat(F.lit("<"), F.col("s"), F.lit("> "), F.array_join("po", " ;\n    "), F.lit(" .")).alias("value"))


def jsonld(triples: DataFrame) -> DataFrame:
    """A JSON object (value) for each subject."""
    g = triples.groupBy("s", "p").agg(F.sort_array(F.collect_list("o")).alias("o")).groupBy("s").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p", "o")))).alias("m"))
    return g.select(F.concat(F.lit('{"@id":"'), escaped(F.col("s")), F.lit('",'), F.expr("substring(to_json(m), 2)")).alias("value"))


def cypher_nodes(nodes: DataFrame, label: str, key: str, properties: list[str]) -> DataFrame:
    """A MERGE statement (value) for each node."""
    props = F.concat_ws(", ", *(F.concat(F.lit(f'n.{p} = "'), escaped(F.col(p).cast("string")), F.lit('"')) for p in properties))
    return nodes.select(F.concat(F.lit(f'MERGE (n:{label} {{id: "'), escaped(F.col(key).cast("string")), F.lit('"}) SET '), props, F.lit(";")).alias("value"))


def cypher_edges(edges: DataFrame, kind: str) -> DataFrame:
    return edges.select(F.concat(F.lit('MATCH (a {id: "'), escaped(F.col("src").cast("string")), F.lit('"}), (b {id: "'), escaped(F.col("dst").cast("string")), F.lit(f'"}}) MERGE (a)-[:{kind}]->(b);')).alias("value"))


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines (part, value), part 0 head, 1 nodes, 2 edges, 3 foot, to be written in order of part."""
    spark = nodes.sparkSession
    ends = spark.createDataFrame([(0, '<?xml version="1.0" encoding="UTF-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns"><graph edgedefault="directed">'), (3, "</graph></graphml>")], "part int, value string")
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit('<node id="'), xml_text(F.col("node").cast("string")), F.lit('"/>')).alias("value"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit('<edge source="'), xml_text(F.col("src").cast("string")), F.lit('" target="'), xml_text(F.col("dst").cast("string")), F.lit('"/>')).alias("value"))
    return ends.unionByName(n).unionByName(e)


def dot(edges: DataFrame) -> DataFrame:
    return edges.select(F.concat(F.lit('"'), escaped(F.col("src").cast("string")), F.lit('" -> "'), escaped(F.col("dst").cast("string")), F.lit('";')).alias("value"))


def owl_classes(classes: DataFrame) -> DataFrame:
    """Turtle lines of (class, parent)."""
    return classes.select(F.concat(F.lit(":"), F.regexp_replace("class", " ", "_"), F.lit(" a owl:Class ; rdfs:subClassOf :"), F.regexp_replace("parent", " ", "_"), F.lit(" .")).alias("value"))


def yaml_rows(df: DataFrame) -> DataFrame:
    """A list item (value) for each row, fields in order."""
    fields = [F.concat(F.lit(f"{c}: "), F.coalesce(F.to_json(F.array(F.col(c).cast("string"))), F.lit("[null]"))) for c in df.columns]
    return df.select(F.concat(F.lit("- "), F.regexp_replace(F.concat_ws("\n  ", *fields), r'\["?|"?\]', '"')).alias("value"))


def report(counts: DataFrame, title: str, form: str = "markdown", most: int = 100_000) -> str:
    """A small table as text; for aggregates, as it is collected, so one of over `most` rows is an error."""
    rows, head = [[str(x) for x in r] for r in counts.limit(most + 1).collect()], counts.columns
    if len(rows) > most:
        raise ValueError(f"a report takes at most {most} rows")
    if form == "html":
        cells = "".join("<tr>" + "".join(f"<td>{x}</td>" for x in r) + "</tr>" for r in rows)
        return f"<h1>{title}</h1><table><tr>{''.join(f'<th>{h}</th>' for h in head)}</tr>{cells}</table>"
    lines = [f"# {title}", "", "| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    return "\n".join(lines + ["| " + " | ".join(r) + " |" for r in rows])
