"""Relational parity: what SQL text over the tables gives."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from graphloom.queries.registry import query, table
from graphloom.sources.readers import run_sql


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_discount FROM lineitem GROUP BY ALL""")
def pricing_summary(spark, d):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("sum_qty"), F.round(F.sum(revenue), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_discount"))


@query("""SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)""")
def join_semi(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").filter("o_totalprice > 200000"), F.expr("o_custkey = c_custkey"), "left_semi").select("c_custkey", "c_name")


@query("""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def join_anti(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").filter("o_totalprice > 400000"), F.expr("o_custkey = c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def join_star(spark, d):
    sql = "SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {o} JOIN {c} ON o_custkey = c_custkey JOIN {n} ON c_nationkey = n_nationkey JOIN {r} ON n_regionkey = r_regionkey GROUP BY ALL"
    return run_sql(spark, sql, o=table(spark, d, "orders"), c=table(spark, d, "customer"), n=table(spark, d, "nation"), r=table(spark, d, "region"))


@query("""SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 10 MINUTE""")
def join_range(spark, d):
    """Events within ten minutes: a time cell joins its own and the next one, so no user's events meet all others."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.floor(F.unix_timestamp("ts") / 600).alias("cell"))
    x = e.select(F.col("event_id").alias("a"), "user_id", F.col("ts").alias("t"), F.explode(F.array("cell", F.col("cell") + 1)).alias("cell"))
    y = e.select(F.col("event_id").alias("b"), "user_id", "ts", "cell")
    return x.join(y, ["user_id", "cell"]).filter("a <> b and ts > t and ts <= t + interval 10 minutes").select("a", "b")


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube_sales(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_sales(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), ())""")
def grouping_sets(spark, d):
    return run_sql(spark, "SELECT p_brand, p_type, count(*) AS n FROM {p} GROUP BY GROUPING SETS ((p_brand), (p_type), ())", p=table(spark, d, "part"))


@query("""SELECT o_custkey, o_orderkey, CAST(r AS INTEGER) AS r FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) e WHERE r <= 3""")
def window_rank(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("r")).filter("r <= 3")


@query("""SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS running FROM events""")
def window_frame_sum(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    return table(spark, d, "events").select("event_id", F.round(F.sum("value").over(w), 6).alias("running"))


@query("""SELECT n_nationkey AS k FROM nation INTERSECT SELECT s_nationkey FROM supplier""")
def set_intersect(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("""SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def set_except(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey"))


@query("""SELECT c_nationkey AS k, 'customer' AS side FROM customer UNION SELECT s_nationkey, 'supplier' FROM supplier""")
def set_union(spark, d):
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("side"))
    return a.union(table(spark, d, "supplier").select("s_nationkey", F.lit("supplier"))).distinct()


@query()
def approx_distinct(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey").alias("orders"), F.percentile_approx("l_extendedprice", 0.5).alias("median_price"))


@query("""SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY ALL""")
def exact_distinct(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"))


@query("""SELECT p_brand, count(*) FILTER (p_size % 3 = 0) AS n0, count(*) FILTER (p_size % 3 = 1) AS n1, count(*) FILTER (p_size % 3 = 2) AS n2 FROM part GROUP BY ALL""")
def pivot_counts(spark, d):
    p = table(spark, d, "part").withColumn("m", F.concat(F.lit("n"), (F.col("p_size") % 3).cast("string")))
    return p.groupBy("p_brand").pivot("m", ["n0", "n1", "n2"]).count().fillna(0)


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5""")
def table_page(spark, d):
    return table(spark, d, "orders").filter("o_orderstatus = 'F'").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(20).select("o_orderkey", "o_totalprice")
