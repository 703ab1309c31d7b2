"""Splitting texts into chunks; offsets count characters from 0."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _steps(n: Column, size: int, overlap: int) -> Column:
    """Starts of windows that stop once the end is reached."""
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be less than size")
    last = F.greatest(F.ceil((n - overlap) / F.lit(step)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: i * step)


def by_characters(docs: DataFrame, key: str, text: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    """(key, chunk_index, start, end, text)."""
    n = F.length(text)
    rows = docs.filter(n > 0).select(key, text, n.alias("_n"), F.posexplode(_steps(n, size, overlap)).alias("chunk_index", "start"))
    return rows.select(key, "chunk_index", "start", F.least(F.col("start") + size, "_n").alias("end"), F.substr(F.col(text), F.col("start") + 1, F.lit(size)).alias("text"))


def sliding(docs: DataFrame, key: str, text: str, size: int = 1000, stride: int = 800) -> DataFrame:
    return by_characters(docs, key, text, size, size - stride)


def by_words(docs: DataFrame, key: str, text: str, size: int = 200, overlap: int = 40) -> DataFrame:
    """(key, chunk_index, n_words, text): words joined by spaces."""
    rows = docs.select(key, F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "").alias("_w")).filter(F.size("_w") > 0)
    rows = rows.select(key, "_w", F.posexplode(_steps(F.size("_w"), size, overlap)).alias("chunk_index", "_s"))
    part = F.slice("_w", F.col("_s") + 1, F.lit(size))
    return rows.select(key, "chunk_index", F.size(part).alias("n_words"), F.array_join(part, " ").alias("text"))


def by_tokens(docs: DataFrame, key: str, text: str, size: int = 512, overlap: int = 50, tokenizer: str | None = None) -> DataFrame:
    """(key, chunk_index, n_tokens, text): windows of a tokenizer file's tokens, cut from the text; without a file, of words."""
    if tokenizer is None:
        return by_words(docs, key, text, size, overlap).withColumnRenamed("n_words", "n_tokens")
    if size <= overlap:
        raise ValueError("overlap must be less than size")

    def run(batches):
        from tokenizers import Tokenizer

        encode = Tokenizer.from_file(tokenizer).encode
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["k"], pdf["t"]):
                spans = encode(t, add_special_tokens=False).offsets if t else []
                for i, lo in enumerate(range(0, max(1, len(spans) - overlap), size - overlap) if spans else ()):
                    part = spans[lo : lo + size]
                    rows.append((k, i, len(part), t[part[0][0] : part[-1][1]]))
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "n_tokens", "text"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, chunk_index int, n_tokens int, text string")


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: s != "")


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda x: F.trim(x)), lambda s: s != "")


def _pack_rows(docs: DataFrame, key: str, parts: Column, size: int, glue: str, most: int | None) -> DataFrame:
    """Greedy packing: a part joins the last chunk while lengths and glue stay within size (and most parts). A running state for each text, so in Arrow batches."""

    def run(batches):
        for pdf in batches:
            keys, index, counts, texts = [], [], [], []
            for k, items in zip(pdf["k"], pdf["parts"]):
                chunks: list[tuple[list[str], int]] = []
                for part in items:
                    if chunks and chunks[-1][1] + len(glue) + len(part) <= size and (most is None or len(chunks[-1][0]) < most):
                        chunks[-1] = ([*chunks[-1][0], part], chunks[-1][1] + len(glue) + len(part))
                    else:
                        chunks.append(([part], len(part)))
                for i, (group, _) in enumerate(chunks):
                    keys.append(k)
                    index.append(i)
                    counts.append(len(group))
                    texts.append(glue.join(group))
            yield pd.DataFrame({key: keys, "chunk_index": index, "n_parts": counts, "text": texts})

    rows = docs.select(F.col(key).alias("k"), parts.alias("parts")).filter(F.size("parts") > 0)
    return rows.mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, chunk_index int, n_parts int, text string")


def by_sentences(docs: DataFrame, key: str, text: str, size: int = 1000, most: int | None = None) -> DataFrame:
    """(key, chunk_index, n_parts, text): sentences packed greedily."""
    return _pack_rows(docs, key, sentences(F.col(text)), size, " ", most)


def by_paragraphs(docs: DataFrame, key: str, text: str, size: int = 2000) -> DataFrame:
    return _pack_rows(docs, key, paragraphs(F.col(text)), size, "\n\n", None)


def sentence_groups(docs: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    """(key, chunk_index, text) of every n sentences."""
    s = docs.select(key, sentences(F.col(text)).alias("_s")).filter(F.size("_s") > 0)
    steps = F.sequence(F.lit(0), F.ceil(F.size("_s") / n).cast("int") - 1)
    return s.select(key, "_s", F.explode(steps).alias("chunk_index")).select(key, "chunk_index", F.array_join(F.slice("_s", F.col("chunk_index") * n + 1, F.lit(n)), " ").alias("text"))


#: Where the recursive splitter likes to cut, best first.
SEPARATORS = ["\n\n", "\n", ". ", " "]


def recursive_spans(text: str, size: int, overlap: int, separators: list[str] = SEPARATORS) -> list[tuple[int, int]]:
    """(start, end) spans: cut after the last best separator in the second half of the window."""
    spans, start = [], 0
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text):
            for s in separators:
                at = text.rfind(s, start + size // 2, end)
                if at >= 0:
                    end = at + len(s)
                    break
        spans.append((start, end))
        if end >= len(text):
            break
        start = max(start + 1, end - overlap)
    return spans


def recursive(docs: DataFrame, key: str, text: str, size: int = 1000, overlap: int = 200, separators: list[str] = SEPARATORS) -> DataFrame:
    """(key, chunk_index, start, end, text)."""

    def run(batches):
        for pdf in batches:
            rows = [(k, i, a, b, t[a:b]) for k, t in zip(pdf["k"], pdf["t"]) if t for i, (a, b) in enumerate(recursive_spans(t, size, overlap, separators))]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "start", "end", "text"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, chunk_index int, start int, end int, text string")


def structural(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section, kind, n_lines, text): lines as heading, list, code or paragraph; a heading begins a section."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    t = F.trim("line")
    kind = F.when(t.rlike(r"^#{1,6}\s"), "heading").when(t.rlike(r"^([-*+]|\d+\.)\s"), "list").when(t.startswith("```"), "code").when(t == "", "blank").otherwise("paragraph")
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("kind", kind).withColumn("section", F.sum((F.col("kind") == "heading").cast("int")).over(w))
    g = lines.filter("kind <> 'blank'").groupBy(key, "section", "kind")
    return g.agg(F.count("*").alias("n_lines"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n").alias("text"))


def hierarchical(docs: DataFrame, key: str, text: str, sizes: tuple[int, int] = (1000, 500)) -> DataFrame:
    """(key, level, chunk_index, n_parts, text): paragraphs packed to the first size and sentences to the second."""
    a = _pack_rows(docs, key, paragraphs(F.col(text)), sizes[0], "\n\n", None).withColumn("level", F.lit("paragraph"))
    b = _pack_rows(docs, key, sentences(F.col(text)), sizes[1], " ", None).withColumn("level", F.lit("sentence"))
    return a.unionByName(b).select(key, "level", "chunk_index", "n_parts", "text")


def entity_aware(docs: DataFrame, key: str, text: str, pattern: str, size: int = 1000) -> DataFrame:
    """Sentences packed to size, but never cut between two sentences that hold the same match of pattern."""
    regex = re.compile(pattern)

    def run(batches):
        for pdf in batches:
            rows = []
            for k, items in zip(pdf["k"], pdf["parts"]):
                chunks: list[list[str]] = []
                names: set[str] = set()
                for s in items:
                    mine = set(regex.findall(s))
                    if chunks and (sum(map(len, chunks[-1])) + len(chunks[-1]) + len(s) <= size or mine & names):
                        chunks[-1].append(s)
                    else:
                        chunks.append([s])
                    names = mine
                rows += [(k, i, len(c), " ".join(c)) for i, c in enumerate(chunks)]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "n_parts", "text"])

    rows = docs.select(F.col(key).alias("k"), sentences(F.col(text)).alias("parts")).filter(F.size("parts") > 0)
    return rows.mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, chunk_index int, n_parts int, text string")


def semantic(docs: DataFrame, key: str, text: str, threshold: float = 0.2) -> DataFrame:
    """(key, chunk_index, n_parts, text): a new chunk begins where the word Jaccard of adjacent sentences is below threshold."""
    from graphloom.functions.similarity import word_jaccard

    s = docs.select(key, F.posexplode(sentences(F.col(text))).alias("at", "sentence"))
    w = Window.partitionBy(key).orderBy("at")
    s = s.withColumn("before", F.lag("sentence").over(w))
    cut = F.when(F.col("before").isNull(), 0).otherwise((word_jaccard(F.col("before"), F.col("sentence")) < threshold).cast("int"))
    s = s.withColumn("cut", cut).withColumn("chunk_index", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = s.groupBy(key, "chunk_index").agg(F.count("*").alias("n_parts"), F.sort_array(F.collect_list(F.struct("at", "sentence"))).alias("l"))
    return g.select(key, "chunk_index", "n_parts", F.array_join(F.transform("l", lambda x: x["sentence"]), " ").alias("text"))


def table_rows(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with chunk_index: every `size` rows in order. Ranks come from per-partition counts after a range sort, not from one task."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    ranged = ranged.withColumn("_i", F.monotonically_increasing_id())
    n = Window.partitionBy("_p").orderBy("_i")
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_c"))
    base = counts.withColumn("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranged = ranged.withColumn("_n", F.row_number().over(n)).join(F.broadcast(base), "_p")
    return ranged.withColumn("chunk_index", F.floor((F.col("_n") + F.col("_b") - 1) / size)).drop("_p", "_i", "_n", "_c", "_b")


def table_text(df: DataFrame, columns: list[str]) -> Column:
    return F.concat_ws(" | ", *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns))


METHODS = {"character": by_characters, "word": by_words, "token": by_tokens, "sentence": by_sentences, "paragraph": by_paragraphs, "recursive": recursive, "sliding": sliding, "hierarchical": hierarchical, "structural": structural, "entity_aware": entity_aware, "semantic": semantic}


def split(docs: DataFrame, key: str, text: str, method: str = "recursive", **options) -> DataFrame:
    return METHODS[method](docs, key, text, **options)
