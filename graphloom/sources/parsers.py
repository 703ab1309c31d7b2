"""Parsers of structured texts into rows: JSON paths, XML, HTML tables, documents with their errors, conversions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _leaves(value: object, path: str, sep: str) -> Iterator[tuple[str, str | None]]:
    if isinstance(value, dict) and value:
        for k, v in value.items():
            yield from _leaves(v, f"{path}{sep}{k}" if path else str(k), sep)
    elif isinstance(value, list) and value:
        for i, v in enumerate(value):
            yield from _leaves(v, f"{path}{sep}{i}" if path else str(i), sep)
    else:
        yield path, None if value is None else value if isinstance(value, str) else json.dumps(value)


def json_paths(df: DataFrame, key: str, text: str, sep: str = ".") -> DataFrame:
    """(key, path, value) of every leaf, objects and lists alike; texts that aren't JSON give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["k"], pdf["t"]):
                try:
                    rows += [(k, p, v) for p, v in _leaves(json.loads(t), "", sep)] if t else []
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=[key, "path", "value"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, path string, value string")


def json_schema(text: Column) -> Column:
    """The kind of a JSON text: object, array, string, number, boolean or null."""
    v = F.schema_of_variant(F.try_parse_json(text))
    return F.when(v.startswith("OBJECT"), "object").when(v.startswith("ARRAY"), "array").when(v == "STRING", "string").when(v == "BOOLEAN", "boolean").when(v == "VOID", "null").when(v.isNotNull(), "number")


def xml_values(text: Column, path: str) -> Column:
    """The texts at an XPath."""
    return F.xpath(text, F.lit(path))


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, row_no, cells) of all tables."""
    tables = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<table[^>]*>(.*?)</table>"), F.lit(1))).alias("table_no", "t"))
    rows = tables.select(key, "table_no", F.posexplode(F.regexp_extract_all("t", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_no", "r"))
    cells = F.regexp_extract_all("r", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    return rows.select(key, "table_no", "row_no", F.transform(cells, lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", ""))).alias("cells"))


def html_images(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"(?i)<img[^>]*\ssrc=[\"']([^\"']*)[\"']"), F.lit(1))


def converted(df: DataFrame, form: str) -> DataFrame:
    """Rows as text in column value: json, csv or xml."""
    row = F.struct(*df.columns)
    return df.select({"json": F.to_json, "csv": F.to_csv, "xml": F.to_xml}[form](row).alias("value"))


def parse_documents(files: DataFrame, parsers: dict[str, Callable[[bytes], str]]) -> DataFrame:
    """(path, ok, text, error) of files(path, kind, content): each by its kind's parser, errors as rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, kind, content in zip(pdf["path"], pdf["kind"], pdf["content"]):
                try:
                    rows.append((path, True, parsers[kind](bytes(content)), None))
                except KeyError:
                    rows.append((path, False, None, f"no parser for {kind}"))
                except Exception as e:  # a bad file is a row, not the end of the job
                    rows.append((path, False, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "ok", "text", "error"])

    return files.select("path", "kind", "content").mapInPandas(run, "path string, ok boolean, text string, error string")


PLAIN = {"text": lambda b: b.decode("utf-8"), "json": lambda b: json.dumps(json.loads(b)), "csv": lambda b: b.decode("utf-8"), "html": lambda b: b.decode("utf-8", "replace")}


def tool_payloads(messages: DataFrame, body: str) -> DataFrame:
    """(kind, text) of JSON-RPC tool output: its text parts, else the body as it is."""
    parts = F.from_json(F.get_json_object(body, "$.result.content"), "array<struct<type:string,text:string>>")
    texts = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), "\n")
    return messages.select(F.when(parts.isNotNull(), "tool").otherwise("text").alias("kind"), F.coalesce(texts, F.col(body)).alias("text"))


def mails_by_day(mails: DataFrame) -> DataFrame:
    return mails.groupBy(F.substring("date", 1, 10).alias("day")).agg(F.count("*").alias("n"))


def reply_edges(mails: DataFrame) -> DataFrame:
    return mails.filter("in_reply_to is not null").select(F.col("message_id").alias("src"), F.col("in_reply_to").alias("dst"))


def comments(code: DataFrame) -> DataFrame:
    """(path, comment) of line comments by language."""
    mark = F.when(F.col("language").isin("python", "ruby"), F.regexp_extract_all("text", F.lit(r"(?m)#[ \t]*(.*)$"), F.lit(1))).otherwise(F.regexp_extract_all("text", F.lit(r"(?m)//[ \t]*(.*)$"), F.lit(1)))
    return code.select("path", F.explode(mark).alias("comment"))
