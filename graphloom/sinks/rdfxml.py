"""RDF/XML: every part file is a whole document, written from sorted partitions row by row and read back in descriptions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.frames import ship_package

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
#: The prefixes that triples here write short (rdf:type), and what they stand for.
PREFIXES = {"rdf": RDF, "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "owl": "http://www.w3.org/2002/07/owl#", "xsd": "http://www.w3.org/2001/XMLSchema#"}
END = "</rdf:Description>"
#: Properties of one description; a subject with more has several, so that none is long.
LONGEST = 1000

_NAME = re.compile(r"[^\W\d][\w.-]*$")
_RESOURCE = re.compile(r"[a-z][a-z0-9+.-]*:\S+")
_BLANK = re.compile(r"_:([^\W\d][\w.-]*)")
_NOT_XML = re.compile("[^\t\n\r\x20-퟿-�\U00010000-\U0010ffff]")


def _long(term: str) -> str:
    prefix, colon, name = term.partition(":")
    return PREFIXES[prefix] + name if colon and prefix in PREFIXES else term


def _short(term: str) -> str:
    for prefix, space in PREFIXES.items():
        if term.startswith(space) and len(term) > len(space):
            return f"{prefix}:{term[len(space):]}"
    return term


def _attribute(text: str) -> str:
    return quoteattr(_NOT_XML.sub("�", text), {"\n": "&#10;", "\t": "&#9;", "\r": "&#13;"})


def _element(p: str, o: str, prefixes: dict[str, str]) -> str:
    full = _long(p)
    name = _NAME.search(full)
    if not name or not name.start():
        raise ValueError(f"RDF/XML can't name the property {p!r}: it must end in a name after its namespace")
    space, local = full[: name.start()], name.group()
    prefix, declared = (prefixes[space], "") if space in prefixes else ("n", f" xmlns:n={_attribute(space)}")
    if blank := _BLANK.fullmatch(o):
        return f"<{prefix}:{local}{declared} rdf:nodeID={_attribute(blank.group(1))}/>"
    if _RESOURCE.fullmatch(o):
        return f"<{prefix}:{local}{declared} rdf:resource={_attribute(_long(o))}/>"
    return f"<{prefix}:{local}{declared}>{escape(_NOT_XML.sub("�", o), {"\r": '&#13;'})}</{prefix}:{local}>"


def rdfxml(triples: DataFrame, namespaces: dict[str, str] | None = None) -> DataFrame:
    """Lines (value) of triples (s, p, o); each partition with rows is a document of its own, so it must be written as it is dealt.

    Triples are range-sorted, so a subject with very many of them spans partitions and descriptions, which mean the same in
    RDF, and no task holds a subject whole. `namespaces` (prefix to address) stand in each document's head; others are declared
    where they occur. Objects of the form scheme:rest are resources, _:name blank nodes, others literals. Characters that XML
    can't hold become U+FFFD. Rows with a null are left out, equal rows are written once. A property that doesn't end in a name is an error.
    """
    ship_package(triples.sparkSession)
    prefixes = {a: p for p, a in (PREFIXES | (namespaces or {})).items()}
    head = "".join(f"\n  xmlns:{p}={_attribute(a)}" for a, p in prefixes.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        subject, n, begun = None, 0, False
        for pdf in batches:
            lines = [] if begun or not len(pdf) else ['<?xml version="1.0" encoding="UTF-8"?>', f"<rdf:RDF{head}>"]
            begun = begun or bool(len(pdf))
            for s, p, o in zip(pdf["s"], pdf["p"], pdf["o"]):
                if s != subject or n >= LONGEST:
                    blank = _BLANK.fullmatch(s)
                    about = f"rdf:nodeID={_attribute(blank.group(1))}" if blank else f"rdf:about={_attribute(_long(s))}"
                    lines += ([END] if subject is not None else []) + [f"<rdf:Description {about}>"]
                    subject, n = s, 0
                lines.append(_element(p, o, prefixes))
                n += 1
            yield pd.DataFrame({"value": lines}, dtype=object)
        if begun:
            yield pd.DataFrame({"value": [END, "</rdf:RDF>"]})

    rows = triples.select(*(F.col(c).cast("string").alias(c) for c in ("s", "p", "o"))).na.drop().distinct()
    return rows.repartitionByRange("s", "p", "o").sortWithinPartitions("s", "p", "o").mapInPandas(run, "value string")


def write_rdfxml(triples: DataFrame, path: str, namespaces: dict[str, str] | None = None) -> None:
    rdfxml(triples, namespaces).write.mode("overwrite").text(path)


def _triples_of(record: str, head: str) -> list[tuple[str, str, str]]:
    begin = record.rfind("<rdf:Description")
    if begin < 0:
        return []
    node = ElementTree.fromstring(f"<rdf:RDF{head}>{record[begin:]}{END}</rdf:RDF>")[0]
    about = node.get(f"{{{RDF}}}about")
    s = _short(about) if about is not None else f"_:{node.get(f'{{{RDF}}}nodeID')}"
    rows = []
    for child in node:
        space, _, local = child.tag[1:].partition("}")
        to, blank = child.get(f"{{{RDF}}}resource"), child.get(f"{{{RDF}}}nodeID")
        rows.append((s, _short(space + local), _short(to) if to is not None else f"_:{blank}" if blank is not None else child.text or ""))
    return rows


def read_rdfxml(spark: SparkSession, path: str, namespaces: dict[str, str] | None = None) -> DataFrame:
    """(s, p, o) of RDF/XML whose statements stand in rdf:Description elements, one below the other, not nested.

    Files are cut at the ends of descriptions, so a large one is read by many tasks; prefixes that only a file's head
    declares must be given in `namespaces`. Names of the four common vocabularies come back short (rdf:type). A description that isn't XML is an error.
    """
    ship_package(spark)
    head = "".join(f" xmlns:{p}={_attribute(a)}" for p, a in (PREFIXES | (namespaces or {})).items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([t for record in pdf["value"] for t in _triples_of(record, head)], columns=["s", "p", "o"], dtype=object)

    return spark.read.option("lineSep", END).text(path).select("value").mapInPandas(run, "s string, p string, o string")
