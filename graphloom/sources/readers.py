"""Sources: files, databases, feeds, mail, code, and a dispatcher. Lazy readers wherever Spark has one."""

from __future__ import annotations

import ast
import email
import email.policy
import json
import re
from collections.abc import Callable, Iterator
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: File kinds by extension, and by their first bytes in hex.
EXTENSIONS = {"pdf": "pdf", "docx": "docx", "xlsx": "xlsx", "pptx": "pptx", "html": "html", "htm": "html", "json": "json", "csv": "csv", "xml": "xml", "txt": "text", "md": "text", "png": "png", "jpg": "jpeg", "jpeg": "jpeg", "zip": "zip", "parquet": "parquet"}
MAGIC = {"25504446": "pdf", "504B0304": "zip", "89504E47": "png", "FFD8FF": "jpeg", "47494638": "gif", "50415231": "parquet"}
#: Languages of code by extension.
LANGUAGES = {"py": "python", "js": "javascript", "ts": "typescript", "java": "java", "go": "go", "rs": "rust", "c": "c", "cpp": "cpp", "rb": "ruby", "scala": "scala"}


def read_files(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None, modified_after: str | None = None, largest: int | None = None) -> DataFrame:
    """(path, name, kind, size, modified, content) of files of any store that Hadoop reaches."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    reader = reader.option("modifiedAfter", modified_after) if modified_after else reader
    df = reader.load(path)
    df = df.filter(F.col("length") <= largest) if largest else df
    return df.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), file_kind(F.col("path"), F.col("content")).alias("kind"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def file_kind(path: Column, content: Column | None = None) -> Column:
    """By extension, else by the first bytes."""
    kinds = F.create_map(*(F.lit(x) for kv in EXTENSIONS.items() for x in kv))
    kind = kinds[F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))]
    if content is not None:
        head = F.hex(F.substring(content, 1, 8))
        for magic, name in MAGIC.items():
            kind = F.coalesce(kind, F.when(head.startswith(magic), name))
    return F.coalesce(kind, F.lit("unknown"))


def _cut(df: DataFrame, where: str | None, limit: int | None) -> DataFrame:
    df = df.where(where) if where else df
    return df.limit(limit) if limit is not None else df


def read_csv(spark: SparkSession, path: str, where: str | None = None, limit: int | None = None, schema: str | None = None, sep: str = ",") -> DataFrame:
    reader = spark.read.option("header", True).option("sep", sep)
    return _cut((reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path), where, limit)


def read_parquet(spark: SparkSession, path: str, where: str | None = None, limit: int | None = None) -> DataFrame:
    return _cut(spark.read.parquet(path), where, limit)


def read_json(spark: SparkSession, path: str, where: str | None = None, limit: int | None = None, multi_line: bool = False) -> DataFrame:
    return _cut(spark.read.option("multiLine", multi_line).json(path), where, limit)


def read_xml(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0, where: str | None = None, limit: int | None = None) -> DataFrame:
    """A sheet, read on the driver by pandas (which needs an Excel engine)."""
    return _cut(spark.createDataFrame(pd.read_excel(path, sheet_name=sheet)), where, limit)


def read_table(spark: SparkSession, url: str, table: str, where: str | None = None, order_by: list[str] | None = None, limit: int | None = None, offset: int | None = None, **options: str) -> DataFrame:
    """A table over JDBC; with partitionColumn, lowerBound, upperBound and numPartitions it is read in parallel."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    df = df.where(where) if where else df
    df = df.orderBy(*order_by) if order_by else df
    df = df.offset(offset) if offset else df
    return df.limit(limit) if limit is not None else df


def read_database(spark: SparkSession, url: str, tables: list[str], exclude: list[str] = (), most_rows: int | None = None, **options: str) -> dict[str, DataFrame]:
    return {t: read_table(spark, url, t, limit=most_rows, **options) for t in tables if t not in exclude}


def run_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """SQL text over named tables: the whole relational surface."""
    return spark.sql(sql, **tables) if tables else spark.sql(sql)


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*(F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def table_schema(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema], "name string, kind string, nullable boolean")


def read_seed(spark: SparkSession, path: str, entity_type: str | None = None, relationship_type: str | None = None, source: str | None = None, sep: str = ",") -> DataFrame:
    """Seed rows of a CSV (values stay strings) or JSON file, stamped."""
    df = spark.read.json(path, multiLine=True) if path.endswith("json") else spark.read.option("header", True).option("sep", sep).csv(path)
    stamps = {"entity_type": entity_type, "relationship_type": relationship_type, "source": source}
    return df.withColumns({k: F.lit(v) for k, v in stamps.items() if v is not None})


def foundation_graph(parts: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(entities, relationships) of seed tables, told apart by whether they have source_id and target_id."""
    edges = [p for p in parts if {"source_id", "target_id"} <= set(p.columns)]
    nodes = [p for p in parts if not {"source_id", "target_id"} <= set(p.columns)]
    join = lambda dfs: None if not dfs else dfs[0] if len(dfs) == 1 else dfs[0].unionByName(join(dfs[1:]), allowMissingColumns=True)
    return join(nodes), join(edges)


def parse_json(text: Column, schema: str) -> Column:
    return F.from_json(text, schema)


def json_value(text: Column, path: str) -> Column:
    """The value at a dotted path."""
    return F.get_json_object(text, "$." + path)


def json_kind(text: Column) -> Column:
    """DDL of a JSON text's own shape."""
    return F.schema_of_variant(F.try_parse_json(text))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields as columns, nested ones too; lists stay."""
    fields = []
    for f in df.schema:
        if f.dataType.typeName() == "struct":
            fields += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{sep}{g.name}") for g in f.dataType]
        else:
            fields.append(F.col(f"`{f.name}`"))
    out = df.select(*fields)
    return flatten(out, sep) if any(f.dataType.typeName() == "struct" for f in out.schema) else out


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o) of N-Triples lines; comments and malformed lines are left out."""
    pattern = r'^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"\S*|(_:\S+))\s*\.\s*$'
    g = lambda i: F.regexp_extract("value", pattern, i)
    rows = spark.read.text(path).filter(F.col("value").rlike(pattern))
    return rows.select(F.concat(g(1), g(2)).alias("s"), g(3).alias("p"), F.concat(g(4), g(5), g(6)).alias("o"))


# -- feeds, sitemaps, mail, code -------------------------------------------------------------


def feed_items(feeds: DataFrame, xml: str) -> DataFrame:
    """RSS items (title, link, guid, published) of feed texts."""
    at = lambda tag: F.xpath(xml, F.lit(f"//item/{tag}/text()"))
    rows = feeds.select(F.explode(F.arrays_zip(at("title").alias("title"), at("link").alias("link"), at("guid").alias("guid"), at("pubDate").alias("published"))).alias("i"))
    return rows.select("i.*")


def new_items(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Items whose guid, or else link, wasn't in the previous fetch."""
    key = F.coalesce("guid", "link")
    return current.withColumn("_k", key).join(previous.select(key.alias("_k")), "_k", "left_anti").drop("_k")


def sitemap_urls(sitemaps: DataFrame, xml: str) -> DataFrame:
    return sitemaps.select(F.explode(F.xpath(xml, F.lit("//*[local-name()='loc']/text()"))).alias("url"))


def url_filter(urls: DataFrame, url: str, pattern: str | None = None, domains: list[str] | None = None) -> DataFrame:
    rows = urls.filter(F.col(url).rlike(pattern)) if pattern else urls
    return rows.filter(F.regexp_extract(url, r"://([^/?#:]+)", 1).isin(*domains)) if domains else rows


def parse_mail(files: DataFrame) -> DataFrame:
    """(path, message_id, in_reply_to, sender, recipients, subject, date, body, n_attachments) of binary .eml files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                m = email.message_from_bytes(content, policy=email.policy.default)
                body = m.get_body(("plain", "html"))
                people = [a.strip() for h in ("to", "cc") for a in (m[h] or "").split(",") if a.strip()]
                rows.append((path, m["message-id"], m["in-reply-to"], m["from"], people, m["subject"], m["date"], body.get_content() if body else "", len(list(m.iter_attachments()))))
            yield pd.DataFrame(rows, columns=["path", "message_id", "in_reply_to", "sender", "recipients", "subject", "date", "body", "n_attachments"])

    return files.select("path", "content").mapInPandas(run, "path string, message_id string, in_reply_to string, sender string, recipients array<string>, subject string, date string, body string, n_attachments long")


def mail_threads(mails: DataFrame) -> DataFrame:
    """(thread, subject, participants, n_messages): a reply belongs to the message that it answers."""
    key = F.coalesce("in_reply_to", "message_id")
    people = F.array_union(F.array("sender"), "recipients")
    g = mails.select(key.alias("thread"), "message_id", "subject", people.alias("p"))
    first = g.groupBy("thread").agg(F.min_by("subject", "message_id").alias("subject"), F.count("*").alias("n_messages"))
    who = g.select("thread", F.explode("p").alias("p")).distinct().groupBy("thread").agg(F.sort_array(F.collect_list("p")).alias("participants"))
    return first.join(who, "thread")


def code_files(files: DataFrame) -> DataFrame:
    """(path, language, n_lines, text) of source files of known languages."""
    langs = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    text = F.decode("content", "UTF-8")
    rows = files.select("path", langs[F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))].alias("language"), text.alias("text"))
    return rows.filter("language is not null").select("path", "language", F.size(F.split("text", "\n")).alias("n_lines"), "text")


def code_metrics(code: DataFrame) -> DataFrame:
    return code.groupBy("language").agg(F.count("*").alias("n_files"), F.sum("n_lines").alias("n_lines"))


def python_symbols(code: DataFrame) -> DataFrame:
    """(path, kind, name, line) of functions, classes and imports of Python files; files that don't parse have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"]):
                try:
                    tree = ast.parse(text)
                except (SyntaxError, ValueError):
                    continue
                for node in ast.walk(tree):
                    if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                        rows.append((path, "function", node.name, node.lineno))
                    elif isinstance(node, ast.ClassDef):
                        rows.append((path, "class", node.name, node.lineno))
                    elif isinstance(node, ast.Import):
                        rows += [(path, "import", a.name, node.lineno) for a in node.names]
                    elif isinstance(node, ast.ImportFrom):
                        rows.append((path, "import", node.module or ".", node.lineno))
            yield pd.DataFrame(rows, columns=["path", "kind", "name", "line"])

    return code.filter("language = 'python'").select("path", "text").mapInPandas(run, "path string, kind string, name string, line int")


def detect_charset(content: Column) -> Column:
    """By byte-order mark, else UTF-8 if it is valid, else ISO-8859-1."""
    head = F.hex(F.substring(content, 1, 3))
    return F.when(head == "EFBBBF", "UTF-8").when(head.startswith("FFFE"), "UTF-16LE").when(head.startswith("FEFF"), "UTF-16BE").when(F.is_valid_utf8(content.cast("string")), "UTF-8").otherwise("ISO-8859-1")


# -- REST ----------------------------------------------------------------------------------------


class RestSource(DataSource):
    """JSON rows of a paged endpoint: options url (with {page}), first, last, items (the key of the list). A partition for each page."""

    @classmethod
    def name(cls) -> str:
        return "graphloom_rest"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _RestReader(dict(self.options))


class _RestReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in range(int(self.options.get("first", 1)), int(self.options.get("last", 1)) + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url = self.options["url"].replace("{page}", str(partition.value))
        with urlopen(Request(url, headers={"Accept": "application/json"}), timeout=60) as reply:
            data = json.load(reply)
        for item in data.get(self.options.get("items", "items"), []) if isinstance(data, dict) else data:
            yield partition.value, json.dumps(item)


def external(spark: SparkSession, form: str, **options: str) -> DataFrame:
    """Stores that need a connector on the class path: mongodb, elasticsearch, neo4j and the like."""
    return spark.read.format(form).options(**options).load()


READERS: dict[str, Callable[..., DataFrame]] = {"file": read_files, "csv": read_csv, "parquet": read_parquet, "json": read_json, "xml": read_xml, "excel": read_excel, "db": read_table, "seed": read_seed, "ntriples": read_ntriples, "mongo": lambda s, **o: external(s, "mongodb", **o), "elastic": lambda s, **o: external(s, "es", **o), "neo4j": lambda s, **o: external(s, "org.neo4j.spark.DataSource", **o)}


def ingest(spark: SparkSession, source: str, kind: str | None = None, **options) -> DataFrame:
    """A source by its kind, or by its form: jdbc: URLs, extensions, else files."""
    found = re.search(r"\.(csv|parquet|json|xlsx|nt)$", source)
    kind = kind or ("db" if source.startswith("jdbc:") else {"xlsx": "excel", "nt": "ntriples"}.get(found[1], found[1]) if found else "file")
    return READERS[kind](spark, source, **options)
