"""Queries of the streaming operators, over the events table as a batch; tests run the same as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.queries.registry import query, table
from graphloom.streaming import streams as ST


def _counted():
    return {"n": F.count("*"), "total": F.round(F.sum("value"), 4)}


def _plain(df):
    return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))


@query("""SELECT event_id FROM events WHERE event_id % 10 = 0""")
def stream_dead_letter(spark, d):
    m = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "not json").otherwise(F.to_json(F.struct(F.col("event_id").alias("k")))).alias("body"))
    return ST.decoded(m, "body", "k long")[1].select("event_id")


@query("""SELECT event_id, event_id * 2 AS k FROM events WHERE event_id % 10 <> 0""")
def stream_decoded(spark, d):
    m = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "not json").otherwise(F.to_json(F.struct((F.col("event_id") * 2).alias("k")))).alias("body"))
    return ST.decoded(m, "body", "k long")[0].select("event_id", "k")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def stream_tumbling(spark, d):
    return _plain(ST.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], **_counted()))


@query("""WITH w AS (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY ALL""")
def stream_sliding(spark, d):
    return _plain(ST.sliding(table(spark, d, "events"), "ts", "1 hour", "30 minutes", ["event_type"], **_counted()))


@query("""WITH g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM g) SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, s""")
def stream_session(spark, d):
    return _plain(ST.sessions(table(spark, d, "events"), "ts", "30 minutes", ["user_id"], **_counted()))


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def stream_dedup(spark, d):
    return ST.deduplicated(table(spark, d, "events"), ["user_id", "event_type"], "ts").select("user_id", "event_type")


@query("""SELECT user_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts, count(*) AS n_seen FROM events GROUP BY user_id""")
def stream_latest_state(spark, d):
    return _plain(ST.latest_state(table(spark, d, "events"), "user_id", "ts", "value", "event_id"))
