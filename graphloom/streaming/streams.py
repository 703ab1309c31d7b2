"""Streams of messages: decoding with dead letters, dedup, windows, sessions, latest state, retention."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_files(spark: SparkSession, path: str, schema: str, form: str = "parquet", per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(form).schema(schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """(key, value, topic, partition, offset, timestamp); the Kafka connector must be on the class path."""
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic} | options).load()


def read_broker(spark: SparkSession, form: str, **options: str) -> DataFrame:
    """Other brokers (kinesis, pulsar, rabbitmq) through their connectors."""
    return spark.readStream.format(form).options(**options).load()


def decoded(messages: DataFrame, value: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, dead letters): messages that are JSON of the schema, and those that aren't."""
    parsed = messages.withColumn("_m", F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"}))
    bad = F.col("_m").isNull() | F.forall(F.array(*(F.col(f"_m.{c}").isNull() for c in parsed.select("_m.*").columns)), lambda x: x)
    return parsed.filter(~bad).select(*messages.columns, "_m.*"), parsed.filter(bad).drop("_m")


def process(rows: DataFrame, transform: Callable[[DataFrame], DataFrame] | None = None, valid: Column | None = None) -> DataFrame:
    """transform, keep what is valid, stamp processed_at."""
    out = transform(rows) if transform else rows
    out = out.filter(valid) if valid is not None else out
    return out.withColumn("processed_at", F.current_timestamp())


def _marked(rows: DataFrame, ts: str, late: str) -> DataFrame:
    """A stream with its watermark, which needs a timestamp with time zone; a batch as it is."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late) if rows.isStreaming else rows


def tumbling(rows: DataFrame, ts: str, size: str, keys: list[str], late: str = "1 hour", **aggregates: Column) -> DataFrame:
    return sliding(rows, ts, size, size, keys, late, **aggregates)


def sliding(rows: DataFrame, ts: str, size: str, step: str, keys: list[str], late: str = "1 hour", **aggregates: Column) -> DataFrame:
    """(window_start, window_end, keys..., aggregates...); rows later than `late` are dropped from a stream."""
    rows = _marked(rows, ts, late)
    g = rows.groupBy(F.window(ts, size, step).alias("w"), *keys).agg(*(c.alias(n) for n, c in aggregates.items()))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggregates)


def sessions(rows: DataFrame, ts: str, gap: str, keys: list[str], late: str = "1 hour", **aggregates: Column) -> DataFrame:
    rows = _marked(rows, ts, late)
    g = rows.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(*(c.alias(n) for n, c in aggregates.items()))
    return g.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, *aggregates)


def deduplicated(rows: DataFrame, keys: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; in batch once at all."""
    return _marked(rows, ts, late).dropDuplicatesWithinWatermark(keys) if rows.isStreaming else rows.dropDuplicates(keys)


def latest_state(rows: DataFrame, key: str, ts: str, value: str, order: str) -> DataFrame:
    """(key, value, ts) of the latest row of each key."""
    g = rows.groupBy(key).agg(F.max_by(F.struct(value, ts), F.struct(ts, order)).alias("s"), F.count("*").alias("n_seen"))
    return g.select(key, f"s.{value}", f"s.{ts}", "n_seen")


def running_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, total) after each batch, by state that Spark keeps for each key."""

    def update(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in batches:
            n, total = n + len(pdf), total + float(pdf["v"].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = dict(rows.dtypes)[key]
    grouped = rows.select(key, F.col(value).cast("double").alias("v")).groupBy(key)
    return grouped.applyInPandasWithState(update, f"{key} {kind}, n long, total double", "n long, total double", "update", "NoTimeout")


def run_available(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that is there, batch by batch, then ends; the checkpoint makes a rerun go on where this ended."""
    q = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(handle).start()
    q.awaitTermination()
    return q


def start(df: DataFrame, form: str, checkpoint: str, path: str | None = None, every: str = "10 seconds", mode: str = "append") -> StreamingQuery:
    w = df.writeStream.format(form).outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    return w.start(path) if path else w.start()


def health(query: StreamingQuery, errors: int, processed: int) -> dict:
    """error rate below 0.1 and running is healthy."""
    rate = errors / (errors + processed) if errors + processed else 0.0
    status = "unhealthy" if not query.isActive else "healthy" if rate < 0.1 else "degraded"
    return {"status": status, "error_rate": rate, "progress": json.loads(query.lastProgress.json) if query.lastProgress else None, "at": time.time()}
