"""Conflicts between sources: detection, resolution, analysis.

All work on observations(entity_id, property, value, source, confidence, ts, ord), the long form of
records, so each detector is one group-by with map-side combining. ord is the order of the
records, on which ties depend.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Properties whose conflicts are critical.
CRITICAL = ["id", "name", "type", "founded_year", "revenue"]
#: Pairs of types that exclude each other, in order.
INCOMPATIBLE = [("Person", "Organization"), ("Person", "Company"), ("Person", "Institution"), ("Organization", "Person"), ("Company", "Person"), ("Location", "Person"), ("Location", "Organization")]
#: Properties that hold dates.
DATE_PROPERTIES = ["date", "founded_year", "birth_date", "death_date", "start_date", "end_date", "created_at", "updated_at"]


def observations(df: DataFrame, entity: str, properties: list[str], source: Column, confidence: Column, ts: Column, order: Column) -> DataFrame:
    """Wide records as observations: a row for each property."""
    pairs = F.explode(F.array(*(F.struct(F.lit(p).alias("property"), F.col(p).cast("string").alias("value")) for p in properties))).alias("pv")
    rows = df.select(F.col(entity).cast("string").alias("entity_id"), pairs, source.cast("string").alias("source"), confidence.cast("double").alias("confidence"), ts.alias("ts"), order.cast("long").alias("ord"))
    return rows.select("entity_id", "pv.property", "pv.value", "source", "confidence", "ts", "ord")


def severity(property_name: Column, spread: Column) -> Column:
    """critical for some properties, high where numbers lie over 1000 apart, else medium."""
    return F.when(property_name.isin(*CRITICAL), "critical").when(spread > 1000, "high").otherwise("medium")


def value_conflicts(obs: DataFrame) -> DataFrame:
    """(entity_id, property) with two or more records and more than one distinct value that isn't null.

    confidence is min(1, mean source confidence * (1 + distinct / records)); spread is the range
    of the values if all are numbers.
    """
    number = F.col("value").try_cast("double")
    g = obs.groupBy("entity_id", "property").agg(
        F.count("*").alias("n_records"),
        F.countDistinct("value").alias("n_values"),
        F.avg("confidence").alias("_mean"),
        F.when(F.count(number) == F.count("*"), F.max(number) - F.min(number)).alias("spread"),
        F.countDistinct("source").alias("n_sources"),
    )
    g = g.filter("n_records >= 2 and n_values > 1")
    confidence = F.least(F.lit(1.0), F.coalesce("_mean", F.lit(0.5)) * (1 + F.col("n_values") / F.col("n_records")))
    return g.select("entity_id", "property", "n_records", "n_values", "n_sources", confidence.alias("confidence"), severity(F.col("property"), F.col("spread")).alias("severity"), F.when(F.col("n_values") == 2, "compare both sources").otherwise("review all sources").alias("action"))


def type_conflicts(obs: DataFrame) -> DataFrame:
    return value_conflicts(obs.filter("property = 'type'"))


def temporal_conflicts(obs: DataFrame, properties: list[str] = DATE_PROPERTIES) -> DataFrame:
    """Date-like properties whose values name different years."""
    year = F.regexp_extract("value", r"\b(19\d{2}|20\d{2})\b", 1)
    rows = obs.filter(F.col("property").isin(*properties)).withColumn("value", F.when(year != "", year).otherwise(F.col("value")))
    return value_conflicts(rows)


def logical_conflicts(obs: DataFrame, pairs: list[tuple[str, str]] = INCOMPATIBLE) -> DataFrame:
    """Entities with two types that exclude each other; the pair table is a fixed value, so it is broadcast."""
    spark = obs.sparkSession
    types = obs.filter("property = 'type'").select("entity_id", "value").distinct()
    table = F.broadcast(spark.createDataFrame(pairs, "first string, second string"))
    hit = types.join(table, F.col("value") == F.col("first")).select("entity_id", "first", F.col("second").alias("value"))
    return hit.join(types, ["entity_id", "value"]).select("entity_id", "first", F.col("value").alias("second"), F.lit("critical").alias("severity"))


def relationship_conflicts(rels: DataFrame) -> DataFrame:
    """Relationships with one key (rel_id, or src_dst_type) that differ in type or confidence."""
    key = F.coalesce(F.col("rel_id"), F.concat_ws("_", "src", "dst", "type"))
    g = rels.withColumn("rel_key", key).groupBy("rel_key").agg(F.count("*").alias("n_records"), F.countDistinct("type").alias("n_types"), F.countDistinct("confidence").alias("n_confidences"))
    fields = F.array_compact(F.array(F.when(F.col("n_types") > 1, "type"), F.when(F.col("n_confidences") > 1, "confidence")))
    return g.select("rel_key", "n_records", F.explode(fields).alias("field"), F.lit(0.8).alias("confidence"), F.lit("medium").alias("severity"))


def all_conflicts(obs: DataFrame) -> DataFrame:
    """Value, type, temporal and logical conflicts in one table."""
    cut = lambda df, kind: df.select(F.lit(kind).alias("kind"), "entity_id", "property", "severity")
    logical = logical_conflicts(obs).select(F.lit("logical").alias("kind"), "entity_id", F.lit("type").alias("property"), "severity").distinct()
    return cut(value_conflicts(obs), "value").unionByName(cut(type_conflicts(obs), "type")).unionByName(cut(temporal_conflicts(obs), "temporal")).unionByName(logical)


# -- resolution ------------------------------------------------------------------------------


def _first_by(rows: DataFrame, *order: Column) -> DataFrame:
    w = Window.partitionBy("entity_id", "property").orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def resolve_voting(obs: DataFrame) -> DataFrame:
    """The commonest value, the first met on ties; confidence is its share."""
    votes = obs.groupBy("entity_id", "property", "value").agg(F.count("*").alias("votes"), F.min("ord").alias("ord"))
    total = votes.withColumn("total", F.sum("votes").over(Window.partitionBy("entity_id", "property")))
    best = _first_by(total, F.desc("votes"), F.asc("ord"))
    return best.select("entity_id", "property", "value", (F.col("votes") / F.col("total")).alias("confidence"))


def resolve_credibility(obs: DataFrame, credibility: DataFrame | None = None, default: float = 0.5) -> DataFrame:
    """The value with the most confidence times credibility(source, weight); confidence is its share."""
    rows = obs.withColumn("_w", F.lit(default)) if credibility is None else obs.join(credibility.select("source", F.col("weight").alias("_w")), "source", "left").withColumn("_w", F.coalesce("_w", F.lit(default)))
    score = rows.groupBy("entity_id", "property", "value").agg(F.sum(F.coalesce("confidence", F.lit(1.0)) * F.col("_w")).alias("score"), F.min("ord").alias("ord"))
    score = score.withColumn("total", F.sum("score").over(Window.partitionBy("entity_id", "property")))
    best = _first_by(score, F.desc(F.round("score", 9)), F.asc("ord"))
    return best.select("entity_id", "property", "value", (F.col("score") / F.col("total")).alias("confidence"))


def _picked(obs: DataFrame, key: Column, confidence: Column) -> DataFrame:
    """By max_by alone, so map-side combining leaves one row a task and group."""
    g = obs.groupBy("entity_id", "property").agg(F.max_by(F.struct("value", "confidence"), key).alias("b"))
    return g.select("entity_id", "property", F.col("b.value").alias("value"), confidence.alias("confidence"))


def resolve_most_recent(obs: DataFrame) -> DataFrame:
    """The value with the latest ts, the first met on ties and where no ts is known."""
    return _picked(obs, F.struct(F.coalesce("ts", F.lit("0001-01-01").cast("timestamp")), -F.col("ord")), F.lit(0.8))


def resolve_first_seen(obs: DataFrame) -> DataFrame:
    return _picked(obs, -F.col("ord"), F.lit(0.7))


def resolve_highest_confidence(obs: DataFrame) -> DataFrame:
    return _picked(obs, F.struct(F.coalesce("confidence", F.lit(-1.0)), -F.col("ord")), F.col("b.confidence"))


def flag_for_review(conflicts: DataFrame, kind: str = "manual") -> DataFrame:
    return conflicts.withColumns({"resolved": F.lit(False), "review": F.lit(kind)})


RESOLVERS = {"voting": resolve_voting, "credibility_weighted": resolve_credibility, "most_recent": resolve_most_recent, "first_seen": resolve_first_seen, "highest_confidence": resolve_highest_confidence}


def resolve(obs: DataFrame, strategy: str = "voting", rules: dict[str, str] = {}) -> DataFrame:
    """Every (entity, property) by the rule of its property, else by the strategy; adds the strategy's name."""
    parts = None
    for name in sorted({strategy, *rules.values()}):
        mine = [p for p, s in rules.items() if s == name]
        chosen = F.col("property").isin(*mine) if mine else F.lit(False)
        if name == strategy:
            others = [p for p, s in rules.items() if s != name]
            chosen = ~F.col("property").isin(*others) if others else F.lit(True)
        part = RESOLVERS[name](obs.filter(chosen)).withColumn("strategy", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    return parts


# -- analysis ----------------------------------------------------------------------------------


def conflict_report(conflicts: DataFrame) -> DataFrame:
    """Counts by kind and severity, with subtotals (nulls) and the total."""
    return conflicts.cube("kind", "severity").agg(F.count("*").alias("n"))


def conflicts_by_source(obs: DataFrame, top: int = 10) -> DataFrame:
    """The sources that take part in most value conflicts."""
    hit = obs.join(value_conflicts(obs).select("entity_id", "property"), ["entity_id", "property"])
    n = hit.groupBy("source").agg(F.countDistinct("entity_id", "property").alias("n"))
    return n.orderBy(F.desc("n"), "source").limit(top)


def conflict_patterns(obs: DataFrame, entities: int = 3, source_conflicts: int = 5) -> DataFrame:
    """Properties in conflict for more than so many entities, and sources in more than so many conflicts."""
    found = value_conflicts(obs)
    by_property = found.groupBy("property").agg(F.countDistinct("entity_id").alias("n")).filter(F.col("n") > entities)
    hit = obs.join(found.select("entity_id", "property"), ["entity_id", "property"])
    by_source = hit.groupBy("source").agg(F.countDistinct("entity_id", "property").alias("n")).filter(F.col("n") > source_conflicts)
    return by_property.select(F.lit("property").alias("pattern"), F.col("property").alias("name"), "n").unionByName(by_source.select(F.lit("source").alias("pattern"), F.col("source").alias("name"), "n"))


def trends(rows: DataFrame, ts: str) -> DataFrame:
    """Rows a month, and whether that is over 10 % more or less than in the month before."""
    n = rows.groupBy(F.date_format(ts, "yyyy-MM").alias("period")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.orderBy("period"))
    return n.withColumn("previous", before).withColumn("trend", F.when(F.col("previous").isNull(), "first").when(F.col("n") > F.col("previous") * 1.1, "increasing").when(F.col("n") < F.col("previous") * 0.9, "decreasing").otherwise("stable"))


def source_disagreements(obs: DataFrame) -> DataFrame:
    """How many distinct pairs of sources give different values for a property of an entity.

    Counted from the sources of each value, without forming the pairs: pairs of sources, less those within a value.
    """
    per_value = obs.select("entity_id", "property", "value", "source").distinct().groupBy("entity_id", "property", "value").agg(F.count("*").alias("c"))
    g = per_value.groupBy("entity_id", "property").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    return g.select("entity_id", "property", ((F.col("s") * F.col("s") - F.col("q")) / 2).cast("long").alias("n_pairs")).filter("n_pairs > 0")


def provenance(obs: DataFrame) -> DataFrame:
    """Of each entity and property: number of sources, first and last seen, latest value."""
    return obs.groupBy("entity_id", "property").agg(F.countDistinct("source").alias("n_sources"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_updated"), F.max_by("value", F.struct("ts", "ord")).alias("latest"))


def traceability(obs: DataFrame, entity_id: str, property_name: str | None = None) -> DataFrame:
    rows = obs.filter(F.col("entity_id") == entity_id)
    rows = rows.filter(F.col("property") == property_name) if property_name else rows
    return rows.orderBy("ts", "ord")
