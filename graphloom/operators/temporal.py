"""Temporal queries over edges with valid_from and valid_until (null: open)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ts(x: str | Column) -> Column:
    return F.lit(x).cast("timestamp") if isinstance(x, str) else x


def valid_at(at: str | Column) -> Column:
    """Closed on both ends."""
    t = _ts(at)
    return (F.col("valid_from").isNull() | (F.col("valid_from") <= t)) & (F.col("valid_until").isNull() | (F.col("valid_until") >= t))


def overlaps(start: str | Column, end: str | Column) -> Column:
    return (F.col("valid_from").isNull() | (F.col("valid_from") <= _ts(end))) & (F.col("valid_until").isNull() | (F.col("valid_until") >= _ts(start)))


def contains(start: str | Column, end: str | Column) -> Column:
    """Valid throughout; a null valid_from is minus infinity."""
    return (F.col("valid_from").isNull() | (F.col("valid_from") <= _ts(start))) & (F.col("valid_until").isNull() | (F.col("valid_until") >= _ts(end)))


def at_time(edges: DataFrame, at: str) -> DataFrame:
    return edges.filter(valid_at(at))


def in_range(edges: DataFrame, start: str, end: str, mode: str = "union") -> DataFrame:
    """union: edges that meet the range; intersection: edges valid throughout."""
    return edges.filter(overlaps(start, end) if mode == "union" else contains(start, end))


def evolution(edges: DataFrame, start: str, end: str, step: str = "month") -> DataFrame:
    """(period, n_edges) of the edges valid in each period from start to end.

    Each edge goes to the periods that it meets, so no join is needed and the work is linear in the result.
    """
    lo, hi = F.date_trunc(step, F.greatest(F.coalesce("valid_from", _ts(start)), _ts(start))), F.date_trunc(step, F.least(F.coalesce("valid_until", _ts(end)), _ts(end)))
    periods = F.when(lo <= hi, F.sequence(lo, hi, F.expr(f"interval 1 {step}")))  # null for an edge that ends before it begins
    hit = edges.filter(overlaps(start, end)).select(F.explode(periods).alias("period"))
    return hit.groupBy("period").agg(F.count("*").alias("n_edges"))


def evolution_summary(edges: DataFrame) -> DataFrame:
    """Of each type: edges, and their mean duration in days."""
    days = F.date_diff(F.col("valid_until"), F.col("valid_from"))
    return edges.groupBy("type").agg(F.count("*").alias("n_edges"), F.avg(days).alias("stability_days"))


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """(key..., change): added, removed, or modified where another field differs."""
    rest = [c for c in before.columns if c not in key]
    a = before.select(*key, F.struct(*rest).alias("_a"), F.lit(True).alias("_in_a"))
    b = after.select(*key, F.struct(*rest).alias("_b"), F.lit(True).alias("_in_b"))
    change = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "modified")
    return a.join(b, key, "full_outer").select(*key, change.alias("change")).filter("change is not null")


def sequences(events: DataFrame, entity: str, kind: str, order: list[str], least: int = 2) -> DataFrame:
    """(first, second, n): kinds that follow one another directly within an entity at least so often."""
    nxt = F.lead(kind).over(Window.partitionBy(entity).orderBy(*order))
    pairs = events.select(F.col(kind).alias("first"), nxt.alias("second")).filter("second is not null")
    return pairs.groupBy("first", "second").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def cycles(events: DataFrame, entity: str, kind: str, order: list[str], least: int = 2) -> DataFrame:
    """(first, second, n): A, B, A directly after one another within an entity."""
    w = Window.partitionBy(entity).orderBy(*order)
    rows = events.select(F.col(kind).alias("first"), F.lead(kind).over(w).alias("second"), F.lead(kind, 2).over(w).alias("third"))
    return rows.filter("first = third and first <> second").groupBy("first", "second").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def nearest_preceding(rows: DataFrame, entity: str, order: list[str], wanted: Column, value: str) -> DataFrame:
    """rows with `preceding`: the value of the nearest earlier row of the entity for which `wanted` holds. A window, not a join."""
    w = Window.partitionBy(entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("preceding", F.last(F.when(wanted, F.col(value)), ignorenulls=True).over(w))


def _carried(rows: DataFrame, key: str, cell: Column, value: Column, order: list[str]) -> DataFrame:
    """(key, _cell, _carry): for each cell of a key the last non-null value of the cells before it; a row for each cell, not for each row of rows."""
    ends = rows.groupBy(key, cell.alias("_cell")).agg(F.max_by(F.struct(value.alias("v")), F.when(value.isNotNull(), F.struct(*order))).alias("_e"))
    w = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(key, "_cell", F.last("_e.v", ignorenulls=True).over(w).alias("_carry"))


def previous_in_cells(rows: DataFrame, key: str, ts: str, value: str, name: str, cell: str = "day") -> DataFrame:
    """rows with `name`: the value of the key's row before, by time, or null. A key's (key, ts) should be unique, and its values not null.

    Time is cut into cells (a unit of date_trunc), and only each cell's last value goes on to the next, so that a key with
    very many rows is as many tasks as it has cells.
    """
    rows = rows.withColumn("_cell", F.date_trunc(cell, ts))
    carried = _carried(rows, key, F.col("_cell"), F.col(value), [ts])
    inside = F.lag(value).over(Window.partitionBy(key, "_cell").orderBy(ts))
    out = rows.withColumn("_in", inside).join(carried, [key, "_cell"], "left")
    return out.withColumn(name, F.coalesce("_in", "_carry")).drop("_in", "_carry", "_cell")


def as_of_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, value: str, cell: str = "day") -> DataFrame:
    """left with the value of the latest right row at or before its time whose value isn't null.

    Both sides stand in one window, so nothing is multiplied. Time is cut into cells (a unit of date_trunc), and a small table of
    each cell's last right value carries over what came before it, so that a key with very many rows isn't one task. Rows without
    a key or a time get null.
    """
    a = left.select(F.col(on).alias("_on"), F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("_row"), F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.select(F.col(on).alias("_on"), F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v")).filter("_on is not null and _t is not null and _v is not null")
    at = F.date_trunc(cell, "_t")
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_cell", at)
    known = both.filter("_on is not null and _t is not null")
    w = Window.partitionBy("_on", "_cell").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    inside = known.withColumn("_in", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").select("_on", "_cell", "_row", "_in")
    spots = known.select("_on", "_cell", "_t", "_v")
    out = inside.join(_carried(spots, "_on", F.col("_cell"), F.col("_v"), ["_t"]), ["_on", "_cell"], "left")
    out = out.select("_row", F.coalesce("_in", "_carry").alias("as_of"))
    rest = both.filter("_side = 1 and (_on is null or _t is null)").select("_row", F.col("_v").alias("as_of"))
    return out.unionByName(rest).select("_row.*", "as_of")
