"""Entity dedup: blocked pair scoring, groups, clusters, merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions import similarity as S
from graphloom.operators import graph
from graphloom.operators.frames import settled, superseded
from graphloom.operators.linkage import linkage_clusters


def block_key(name: Column) -> Column:
    """The first character of the trimmed, lower-cased name."""
    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return F.when(n == "", "___empty___").otherwise(F.substring(n, 1, 1))


def candidate_pairs(entities: DataFrame, threshold: float, score: Callable[[Column, Column], Column], block: Callable[[Column], Column] = block_key) -> DataFrame:
    """(a, b, score) of entities(ord, name) in one block whose names score `threshold` or more, a < b.

    Equal names are scored once: pairs of distinct names are formed and scored, then joined back. The default
    block is the first character, as names are compared by convention here; for large vocabularies give a finer one.
    """
    names = entities.select("name").distinct().withColumn("block", block(F.col("name")))
    x, y = names.alias("x"), names.alias("y")
    scored = x.join(y, F.expr("x.block = y.block and x.name <= y.name")).select(F.col("x.name").alias("m"), F.col("y.name").alias("n"), score(F.col("x.name"), F.col("y.name")).alias("score"))
    scored = scored.filter(F.col("score") >= threshold)
    a, b = entities.select(F.col("ord").alias("p"), F.col("name").alias("m")), entities.select(F.col("ord").alias("q"), F.col("name").alias("n"))
    rows = scored.join(a, "m").join(b, "n").filter("p <> q and (m <> n or p < q)")
    return rows.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "score").distinct()


def incremental_pairs(new: DataFrame, existing: DataFrame, threshold: float, score: Callable[[Column, Column], Column]) -> DataFrame:
    """(new, old, score) of names that score `threshold` or more, within blocks."""
    n = new.select(F.col("ord").alias("new_ord"), F.col("name").alias("m")).withColumn("block", block_key(F.col("m")))
    o = existing.select(F.col("ord").alias("old_ord"), F.col("name").alias("n")).withColumn("block", block_key(F.col("n")))
    pairs = n.select("m", "block").distinct().join(o.select("n", "block").distinct(), "block").withColumn("score", score(F.col("m"), F.col("n"))).filter(F.col("score") >= threshold)
    return pairs.select("m", "n", "score").join(n.drop("block"), "m").join(o.drop("block"), "n").select("new_ord", "old_ord", "score")


def pair_confidence(score: Column, same_name: Column, equal_properties: Column, same_type: Column) -> Column:
    extra = F.when(same_name, 0.1).otherwise(0.0) + equal_properties * 0.05 + F.when(same_type, 0.05).otherwise(0.0)
    return F.least(F.lit(1.0), score + extra)


def duplicate_groups(pairs: DataFrame) -> DataFrame:
    """(id, component) of all ids in pairs(a, b)."""
    return graph.connected_components(pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))).select(F.col("node").alias("id"), "component")


def group_confidence(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each component: size, mean pair score, and that times 0.8 + 0.2 * min(1, size / 5)."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    mean = pairs.join(groups.withColumnRenamed("id", "a"), "a").groupBy("component").agg(F.avg("score").alias("mean_score"))
    return sizes.join(mean, "component").withColumn("confidence", F.col("mean_score") * (0.8 + 0.2 * F.least(F.lit(1.0), F.col("size") / 5)))


def clusters(groups: DataFrame, smallest: int = 2, largest: int = 100) -> DataFrame:
    """groups with size and whether it lies within the bounds; others are unclustered."""
    size = groups.groupBy("component").agg(F.count("*").alias("size"))
    return groups.join(size, "component").withColumn("clustered", F.col("size").between(smallest, largest))


# -- merging -----------------------------------------------------------------------------------


def representative(records: DataFrame, weight: Column) -> DataFrame:
    """(component, ord) of the record with the greatest weight, the first on ties."""
    return records.groupBy("component").agg(F.max_by("ord", F.struct(weight, -F.col("ord"))).alias("ord"))


def base_order(strategy: str, filled: Column | None = None) -> Column:
    """What the base record of a group has most of; records carry ord and confidence."""
    first = -F.col("ord")
    return {
        "keep_first": F.struct(first),
        "keep_last": F.struct(F.col("ord")),
        "keep_most_complete": F.struct(filled if filled is not None else F.lit(0), first),
        "keep_highest_confidence": F.struct(F.coalesce(F.col("confidence"), F.lit(0.0)) if filled is None else F.col("confidence"), first),
    }.get(strategy, F.struct(first))


def merge_groups(records: DataFrame, strategy: str, fields: list[str]) -> DataFrame:
    """One record for each component(component, ord, fields...): the base's fields, nulls filled from the others.

    keep_last fills from the last record back, other strategies from the first on; merge_all gives
    each field's distinct values, sorted. Rows: component, base_ord, n_merged, fields.
    """
    filled = sum((F.when(F.col(f).isNotNull(), 1).otherwise(0) for f in fields), F.lit(0))
    if strategy == "merge_all":
        return records.groupBy("component").agg(F.min("ord").alias("base_ord"), F.count("*").alias("n_merged"), *(F.sort_array(F.collect_set(F.col(f).cast("string"))).alias(f) for f in fields))
    key = base_order(strategy, filled if strategy == "keep_most_complete" else (F.lit(0) if strategy == "keep_highest_confidence" else None))
    then = F.col("ord") if strategy == "keep_last" else -F.col("ord")
    base = F.max_by("ord", key)
    rank = F.struct(key, then)
    return records.groupBy("component").agg(base.alias("base_ord"), F.count("*").alias("n_merged"), *(F.max_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields))


def resolved_entities(merged: DataFrame, entities: DataFrame, groups: DataFrame, fields: list[str]) -> DataFrame:
    """Merged groups and the entities that are in none."""
    alone = entities.join(groups.select(F.col("id").alias("ord")), "ord", "left_anti")
    return merged.select(F.col("base_ord").alias("ord"), *fields).unionByName(alone.select("ord", *fields))


def greedy_matches(pairs: DataFrame) -> DataFrame:
    """One-to-one matches of (new_ord, old_ord, score): the best pair of all, then the best of what is left, and so on.

    A pair that is the best of both its rows is always among them, so each round takes all of these and
    drops the other pairs of their rows. Ties go to the smaller new_ord, then old_ord. Each round is written to the shared folder.
    """
    left, found = settled(pairs.select("new_ord", "old_ord", "score")), None
    while left.take(1):
        order = F.struct(F.col("score"), -F.col("new_ord"), -F.col("old_ord"))
        best_of = lambda c: left.groupBy(c).agg(F.max(order).alias(f"best_{c}"))
        own = F.struct(F.col("score"), -F.col("new_ord"), -F.col("old_ord"))
        both = left.join(best_of("new_ord"), "new_ord").join(best_of("old_ord"), "old_ord")
        some = settled(both.filter((F.col("best_new_ord") == own) & (F.col("best_old_ord") == own)).select("new_ord", "old_ord", "score").distinct())
        found = some if found is None else found.unionByName(some)
        rest = left.join(some.select("new_ord"), "new_ord", "left_anti").join(some.select("old_ord"), "old_ord", "left_anti")
        rest = settled(rest.select("new_ord", "old_ord", "score"))
        superseded(left)
        left = rest
    return left if found is None else found


def seed_first(seed: DataFrame, extracted: DataFrame, key: list[str]) -> DataFrame:
    """All seed rows, and the extracted ones with other keys."""
    return seed.unionByName(extracted.join(seed.select(*key), key, "left_anti"), allowMissingColumns=True)


def extracted_first(seed: DataFrame, extracted: DataFrame, key: list[str]) -> DataFrame:
    return seed_first(extracted, seed, key)


def seed_merge(seed: DataFrame, extracted: DataFrame, key: list[str]) -> DataFrame:
    """By key, seed's fields over extracted ones."""
    fields = [c for c in extracted.columns if c not in key]
    s = seed.select(*key, *(F.col(c).alias(f"_s_{c}") for c in fields if c in seed.columns))
    joined = s.join(extracted, key, "full_outer")
    return joined.select(*key, *(F.coalesce(f"_s_{c}", c).alias(c) if c in seed.columns else F.col(c) for c in fields))


def leader_clusters(df: DataFrame, block: str, text: str, order: str, threshold: float) -> DataFrame:
    """Greedy leader clustering in `order` within each block: a text joins the first leader with a word Jaccard of threshold or more.

    (order, leader). A block is handled in one task, so blocks must be small by design.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        leaders, out = [], []
        for o, t in pdf.sort_values("o")[["o", "t"]].itertuples(index=False):
            mine = set((t or "").lower().split())
            for lead, theirs in leaders:
                both = len(mine | theirs)
                if both and len(mine & theirs) / both >= threshold:
                    out.append((o, lead))
                    break
            else:
                leaders.append((o, mine))
                out.append((o, o))
        return pd.DataFrame(out, columns=["id", "leader"])

    return df.select(F.col(block).alias("b"), F.col(text).alias("t"), F.col(order).cast("long").alias("o")).groupBy("b").applyInPandas(run, "id long, leader long")


def word_overlap_pairs(df: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """(a, b, similarity) of rows whose word sets have a Jaccard of threshold or more, through an inverted index.

    Only words that can be among the prefix of a set, the rarest first, are joined.
    """
    w = df.select(F.col(key).alias("k"), F.explode(S.word_set(F.lower(F.col(text)))).alias("w"))
    w = w.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    seen = w.groupBy("w").agg(F.count("*").alias("f"))
    place = F.row_number().over(Window.partitionBy("k").orderBy("f", "w"))
    prefix = w.join(seen, "w").withColumn("at", place).filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
    x, y = prefix.alias("x"), prefix.alias("y")
    pairs = x.join(y, F.expr("x.w = y.w and x.k < y.k")).filter((F.col("x.n") >= F.col("y.n") * threshold) & (F.col("y.n") >= F.col("x.n") * threshold))
    pairs = pairs.select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
    texts = df.select(F.col(key).alias("k"), S.word_set(F.lower(F.col(text))).alias("s"))
    both = pairs.join(texts.select(F.col("k").alias("a"), F.col("s").alias("p")), "a").join(texts.select(F.col("k").alias("b"), F.col("s").alias("q")), "b")
    return both.withColumn("similarity", S._jaccard(F.col("p"), F.col("q"))).filter(F.col("similarity") >= threshold).select("a", "b", "similarity")


def agglomerative(df: DataFrame, block: str | None, text: str, order: str, threshold: float, floor: float | None = None) -> DataFrame:
    """(id, cluster) by average-linkage clustering by word Jaccard, within each block if there are any, until the best pair is below threshold.

    Texts less alike than `floor` (half the threshold by default) count as 0 alike, so that only pairs above it are looked for.
    """
    rows = df.select(F.col(order).cast("long").alias("id"), F.col(text).alias("t"), *([F.col(block).alias("b")] if block else []))
    pairs = word_overlap_pairs(rows, "id", "t", threshold / 2 if floor is None else floor)
    if block:
        for end in ("a", "b"):
            pairs = pairs.join(rows.select(F.col("id").alias(end), F.col("b").alias(f"block_{end}")), end)
        pairs = pairs.filter("block_a = block_b")
    return linkage_clusters(pairs.select("a", "b", "similarity"), rows, threshold)
