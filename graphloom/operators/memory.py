"""Memory of agents and conversations: items (conv_id, turn, role, text) or (content, ts, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """A rough count: a token for four characters."""
    return F.floor(F.length(text) / 4)


def token_window(items: DataFrame, group: str, order: str, text: str, most_tokens: int, most_items: int) -> DataFrame:
    """The newest items of each group that fit the token and item limits together."""
    w = Window.partitionBy(group).orderBy(F.desc(order))
    total = F.sum(tokens(F.col(text))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = items.withColumns({"n": F.row_number().over(w), "running_tokens": total})
    return rows.filter((F.col("n") <= most_items) & (F.col("running_tokens") <= most_tokens))


def recent(items: DataFrame, order: list[Column], k: int) -> DataFrame:
    return items.orderBy(*order).limit(k)


def recent_each(items: DataFrame, group: str, order: str, k: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.desc(order))
    return items.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k)


def conversation_summary(items: DataFrame) -> DataFrame:
    """Of each conversation: turns, roles, characters, first and last text."""
    return items.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.countDistinct("role").alias("n_roles"), F.sum(F.length("text")).alias("n_chars"), F.min_by("text", "turn").alias("first_text"), F.max_by("text", "turn").alias("last_text"))


def histogram(items: DataFrame, field: str) -> DataFrame:
    return items.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"))


def retained(items: DataFrame, ts: str, now: str, days: int) -> DataFrame:
    return items.filter(F.col(ts) >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days"))


def usage(items: DataFrame, ts: str, now: str, user: str) -> DataFrame:
    """One row: items and users of the last day, week and month before now."""
    at = F.lit(now).cast("timestamp")
    spans = {"day": 1, "week": 7, "month": 30}
    inside = {n: (F.col(ts) > at - F.expr(f"interval {d} days")) & (F.col(ts) <= at) for n, d in spans.items()}
    return items.agg(*(F.count_if(c).alias(f"items_{n}") for n, c in inside.items()), *(F.countDistinct(F.when(c, F.col(user))).alias(f"users_{n}") for n, c in inside.items()))


def mentioning(items: DataFrame, field: str, value: str) -> DataFrame:
    return items.filter(F.array_contains(field, value))


def page(items: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    return items.orderBy(*order).offset(offset).limit(limit)
