"""Similarity of strings, sets and vectors."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _clean(c: Column) -> Column:
    return F.lower(F.trim(c))


def levenshtein(a: Column, b: Column) -> Column:
    """1 - distance / longer length; equal strings 1, an empty one 0."""
    x, y = _clean(a), _clean(b)
    return F.when(x == y, 1.0).when((x == "") | (y == ""), 0.0).otherwise(1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)))


def _jaccard(x: Column, y: Column) -> Column:
    """Of arrays without repeats; two empty ones 0."""
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def bigrams(c: Column) -> Column:
    n = F.greatest(F.length(c) - 1, F.lit(0))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(c, i, F.lit(2)))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def bigram_jaccard(a: Column, b: Column) -> Column:
    x, y = _clean(a), _clean(b)
    return F.when(x == y, 1.0).otherwise(_jaccard(bigrams(x), bigrams(y)))


def word_set(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


def word_jaccard(a: Column, b: Column, lower: bool = True) -> Column:
    return _jaccard(*(word_set(F.lower(c) if lower else c) for c in (a, b)))


def character_jaccard(a: Column, b: Column) -> Column:
    """Of the sets of characters, letter case ignored."""
    return _jaccard(*(F.array_distinct(F.filter(F.split(F.lower(c), ""), lambda x: x != "")) for c in (a, b)))


def record_field(a: Column, b: Column) -> Column:
    """1 for equal, 0.95 for equal but for letter case, else character_jaccard."""
    return F.when(a == b, 1.0).when(F.lower(a) == F.lower(b), 0.95).otherwise(character_jaccard(a, b))


def term_cosine(a: Column, b: Column) -> Column:
    """Cosine of term frequencies."""
    wa, wb = (F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "") for c in (a, b))
    count = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    shared = F.array_intersect(F.array_distinct(wa), F.array_distinct(wb))
    dot = F.aggregate(shared, F.lit(0.0), lambda s, w: s + count(wa, w) * count(wb, w))
    square = lambda words: F.aggregate(F.array_distinct(words), F.lit(0.0), lambda s, w: s + F.pow(count(words, w), 2))
    norm = F.sqrt(square(wa)) * F.sqrt(square(wb))
    return F.when(norm == 0, 0.0).otherwise(dot / norm)


def jaro(s: str, t: str) -> float:
    """Matches within half the longer length less one; half the matches out of order count against."""
    if not s or not t:
        return 0.0
    reach = max(0, max(len(s), len(t)) // 2 - 1)
    taken, matched = [False] * len(t), []
    for i, c in enumerate(s):
        for j in range(max(0, i - reach), min(len(t), i + reach + 1)):
            if not taken[j] and t[j] == c:
                taken[j] = True
                matched.append(c)
                break
    if not matched:
        return 0.0
    m = len(matched)
    moved = sum(a != b for a, b in zip(matched, (c for c, used in zip(t, taken) if used))) / 2
    return (m / len(s) + m / len(t) + (m - moved) / m) / 3


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(s: str | None, t: str | None) -> float | None:
        if s is None or t is None:
            return None
        score, prefix = jaro(s, t), 0
        while prefix < min(4, len(s), len(t)) and s[prefix] == t[prefix]:
            prefix += 1
        return score + prefix * 0.1 * (1 - score)

    return pd.Series([one(s, t) for s, t in zip(a, b)], dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler with the prefix bonus at any score; an Arrow UDF, so give it distinct pairs."""
    x, y = _clean(a), _clean(b)
    return F.when(x == y, 1.0).when((x == "") | (y == ""), 0.0).otherwise(_jaro_winkler(x, y))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio of matching blocks."""
    return pd.Series([None if s is None or t is None else difflib.SequenceMatcher(None, s, t).ratio() for s, t in zip(a, b)], dtype="float64")


def string_similarity(a: Column, b: Column, method: str = "jaro_winkler") -> Column:
    return {"jaro_winkler": jaro_winkler, "cosine": bigram_jaccard, "levenshtein": levenshtein}.get(method, levenshtein)(a, b)


def property_similarity(a: Column, b: Column) -> Column:
    """Of two string maps: the mean over all keys of 0.5 for a missing one, else the string similarity; both empty 1."""
    a, b = F.coalesce(a, F.create_map().cast("map<string,string>")), F.coalesce(b, F.create_map().cast("map<string,string>"))
    scores = F.map_values(F.map_zip_with(a, b, lambda _, x, y: F.when(x.isNull() | y.isNull(), 0.5).otherwise(levenshtein(x, y))))
    return F.when(F.size(scores) == 0, 1.0).otherwise(F.aggregate(scores, F.lit(0.0), lambda s, x: s + x) / F.size(scores))


def relation_similarity(a: Column, b: Column) -> Column:
    """Jaccard of relation sets; both empty 0.5, one empty 0."""
    empty = F.size(a) + F.size(b)
    return F.when(empty == 0, 0.5).otherwise(_jaccard(F.array_distinct(a), F.array_distinct(b)))


# -- vectors ---------------------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 for a zero vector or vectors of unequal length."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) != F.size(b)) | (n == 0), 0.0).otherwise(dot(a, b) / n)


def embedding_similarity(a: Column, b: Column) -> Column:
    """Cosine moved to 0..1; 0 for zero or unequal vectors."""
    n = norm(a) * norm(b)
    return F.when((F.size(a) != F.size(b)) | (n == 0), 0.0).otherwise((dot(a, b) / n + 1) / 2)


def euclidean_distance(a: Column, b: Column) -> Column:
    d = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))


def euclidean_similarity(a: Column, b: Column) -> Column:
    """1 - distance / sum of norms, within 0..1."""
    n = norm(a) + norm(b)
    return F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - euclidean_distance(a, b) / n)))


def l2_normalized(a: Column) -> Column:
    """Divided by its norm; a zero vector stays."""
    n = norm(a)
    return F.when(n == 0, a.cast("array<double>")).otherwise(F.transform(a, lambda x: x.cast("double") / n))


def multifactor(string: Column, properties: Column, relations: Column, embedding: Column | None = None, weights: tuple[float, float, float, float] = (0.6, 0.2, 0.2, 0.0)) -> Column:
    """Weighted mean of the components that are there (not null)."""
    parts = list(zip((string, properties, relations, embedding if embedding is not None else F.lit(None).cast("double")), weights))
    top = sum((F.coalesce(c, F.lit(0.0)) * w for c, w in parts), F.lit(0.0))
    total = sum((F.when(c.isNull(), 0.0).otherwise(w) for c, w in parts), F.lit(0.0))
    return F.when(total == 0, 0.0).otherwise(top / total)
